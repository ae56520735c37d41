from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlet.operators.keys import ROW_PLACE, lay_out, number_rows
from martlet.sources.store import Store


def test_keys_are_dense_and_ordered_over_many_partitions(spark):
    df = spark.range(0, 20000, 1, 16).select((F.hash("id") % 5000).alias("a"), "id")
    rows = number_rows(df, "k", ["a", "id"], Store(spark), "t", 5).collect()
    ordered = sorted(rows, key=lambda r: (r["a"], r["id"]))
    assert [r["k"] for r in ordered] == list(range(5, 20005))


def test_one_hot_leading_value_is_spread(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, 60000, 1, 8).select(hot.alias("a"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = lay_out(df, ["a", "id"], Store(spark), "t")
        per_task = stored.filter("a = 'hot'").groupBy(F.shiftright(ROW_PLACE, 33)).count()
        assert per_task.count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = number_rows(df, "k", ["a", "id"], Store(spark), "t2").agg(
        F.min("k"), F.max("k"), F.count_distinct("k")
    ).first()
    assert tuple(keys) == (1, 60000, 60000)


def test_empty_table(spark):
    assert number_rows(spark.range(0).withColumn("a", F.lit(1)), "k", ["a"], Store(spark), "t").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.text("ab", max_size=2))), min_size=1, max_size=30))
def test_any_rows_get_keys_in_order(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    got = number_rows(df, "k", ["a", "b"], Store(spark), "t").collect()
    by_key = [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["k"])]
    assert by_key == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert sorted(r["k"] for r in got) == list(range(1, len(rows) + 1))


def test_input_of_the_range_split_runs_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            rows.add(len(part))
            yield part

    df = spark.range(1000).mapInPandas(count, "id bigint")
    lay_out(df, ["id"], Store(spark), "once")
    assert rows.value == 1000
