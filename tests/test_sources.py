import json
import random

import pytest
from pyspark.sql import functions as F

from martlet.operators.dimensions import dim_date
from martlet.schemas import STAGING, STAR
from martlet.settings import Settings
from martlet.sources import audit, files
from martlet.sources.prepared import prepare_sources
from martlet.sources.store import Store, shared_folder

FEED = [
    {"date": "2016-01-01", "localName": "Confraternização Universal", "name": "New Year's Day", "countryCode": "BR",
     "fixed": False, "global": True, "counties": None, "launchYear": None, "types": ["Public"]},
    {"date": "2016-07-09", "localName": "Revolução", "name": "Constitutionalist Revolution", "countryCode": "BR",
     "fixed": True, "global": False, "counties": ["BR-SP"], "launchYear": None, "types": ["Public", "Bank"]},
]


def test_csv_with_newline_quotes_and_blank(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2017-01-01 00:00:00,2017-01-02 10:11:12\n'
        "r2,o2,1,ruim,não,2017-01-01 00:00:00,\n", encoding="utf-8")
    rows = files.read_csv(spark, str(path), STAGING["reviews"], multi_line=True).orderBy("review_id").collect()
    assert rows[0]["review_comment_message"] == 'two\nlines, "quoted"'
    assert rows[0]["review_comment_title"] is None and rows[1]["review_answer_timestamp"] is None
    assert rows[1]["review_comment_message"] == "não" and rows[0]["review_score"] == 5


def test_latin1_file_is_detected(spark, tmp_path):
    text = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,são josé,SP\n"
    (tmp_path / "latin.csv").write_bytes(text.encode("latin1"))
    (tmp_path / "utf8.csv").write_bytes(text.encode("utf-8"))
    for name, broken in (("latin.csv", True), ("utf8.csv", False)):
        path = str(tmp_path / name)
        assert [r["valid"] for r in files.file_kinds(files._lines(spark, path)).collect()] == [not broken]
        assert files.read_csv(spark, path, STAGING["sellers"]).first()["seller_city"] == "são josé"


def _free_texts(n, seed, breaks="\n"):
    """CSV text of reviews whose messages hold line breaks, quotes, commas and blank lines, some over many lines."""
    rng = random.Random(seed)
    lines = ["review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"]
    for k in range(n):
        words = [rng.choice(["bom", "ruim", "não", "\n", "\n\n", '"', ",", '""', " "]) for _ in range(rng.choice([0, 1, 5, 300]))]
        message = "".join(words).replace("\n", breaks).replace('"', '""')
        lines.append(f'r{k},o{k},{k % 5 + 1},,"{message}",2017-01-01 00:00:00,')
    return breaks.join(lines) + breaks


@pytest.mark.parametrize("breaks", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding", ["utf-8", "latin1"])
def test_free_text_is_read_in_splits(spark, tmp_path, breaks, encoding):
    path = tmp_path / "reviews.csv"
    path.write_bytes(_free_texts(600, 1, breaks).encode(encoding))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8" if encoding == "utf-8" else "ISO-8859-1").csv(str(path))
    want = sorted((r[0], r[1], int(r[2]), r[4]) for r in whole.collect())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
        rows = files.read_csv(spark, str(path), STAGING["reviews"], multi_line=True)
        got = sorted((r["review_id"], r["order_id"], r["review_score"], r["review_comment_message"]) for r in rows.collect())
        lines = files._lines(spark, str(path))
        splits, tasks = lines.select("split").distinct().count(), lines.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert got == want and len(got) == 600
    assert splits > 10 and tasks > 10


def test_describing_files_sorts_no_lines(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b\n" + "1,2\n" * 50)
    kinds = files.file_kinds(files._lines(spark, str(tmp_path)))
    text = kinds._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and [r["header"] for r in kinds.collect()] == ["a,b"]


def test_free_text_lines_are_not_shuffled(spark, tmp_path):
    """Only lines of records that cross lines are put together; the others stay in the tasks that read them."""
    path = tmp_path / "reviews.csv"
    path.write_text(_free_texts(400, 4))
    rows = files.read_csv(spark, str(path), STAGING["reviews"], multi_line=True)
    assert rows.count() == 400
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("size", [512, 2048, 1 << 20])
def test_free_text_does_not_depend_on_splits(spark, tmp_path, size):
    """Records over several splits, a record that is never closed, and splits that change after the call."""
    path = tmp_path / "reviews.csv"
    path.write_text(_free_texts(200, 5) + 'open,o,1,,"never\n\nclosed')
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = files.read_csv(spark, str(path), STAGING["reviews"], multi_line=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
        got = sorted(tuple(r) for r in rows.select("review_id", "review_comment_message").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(str(path))
    want = sorted((r[0], r[4]) for r in whole.collect() if r[0] != "open")
    assert [r for r in got if r[0] != "open"] == want and len(got) == 201


def test_free_text_files_of_several_layouts(spark, tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    first = _free_texts(30, 2)
    (folder / "a.csv").write_bytes(first.encode("utf-8"))
    (folder / "b.csv").write_bytes(_free_texts(30, 3).encode("latin1"))
    (folder / "c.csv").write_text('order_id,review_id,extra,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
                                  'o1,c1,"x\ny",4,t,"p\nq",2017-01-01 00:00:00,\n')
    (folder / "empty.csv").write_text("")
    rows = files.read_csv(spark, str(folder), STAGING["reviews"], multi_line=True).collect()
    assert len(rows) == 61
    other = next(r for r in rows if r["review_id"] == "c1")
    assert (other["order_id"], other["review_score"], other["review_comment_message"]) == ("o1", 4, "p\nq")
    assert sum("não" in (r["review_comment_message"] or "") for r in rows) > 20


def test_registry_of_csv_sources(spark, tmp_path):
    (tmp_path / "s.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\n")
    frames = files.read_staging(spark, {"sellers": str(tmp_path / "s.csv")})
    assert frames["sellers"].schema == STAGING["sellers"] and spark.table("sellers").count() == 1


def test_holiday_feed(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps(FEED, indent=2, ensure_ascii=False), encoding="utf-8")
    feed = files.read_holidays(spark, str(tmp_path / "h.json"))
    assert feed.count() == 2 and feed.filter("counties is null").count() == 1
    staged = files.holidays_staging(feed)
    assert [str(r["holiday_date"]) for r in staged.collect()] == ["2016-01-01", "2016-07-09"]
    every = dim_date(spark, staged, Settings()).filter("IsHoliday = 1").count()
    national = dim_date(spark, staged, Settings(national_holidays_only=True)).filter("IsHoliday = 1").count()
    assert (every, national) == (2, 1)
    flat = {r["date"]: r for r in files.flatten_arrays(feed).collect()}
    assert flat["2016-07-09"]["types"] == '["Public","Bank"]' and flat["2016-01-01"]["counties"] is None
    files.write_json_array(feed, str(tmp_path / "array"), "date")
    (part,) = (tmp_path / "array").glob("part-*.txt")
    document = part.read_text(encoding="utf-8")
    assert json.loads(document) == FEED and "Confraternização" in document
    files.write_json(feed.coalesce(1), str(tmp_path / "lines"))
    for path in ("array", "lines"):
        assert files.read_holidays(spark, str(tmp_path / path)).count() == 2


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_state,extra,seller_id,seller_zip_code_prefix,seller_city\nSP,?,s1,1,x\n")
    (tmp_path / "b.csv").write_text("\ufeffseller_id,seller_zip_code_prefix,seller_city,seller_state\ns2,no number,y,RJ\n", encoding="utf-8")
    (tmp_path / "c.csv").write_bytes("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns3,3,são,MG\n".encode("latin1"))
    (tmp_path / "d.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns4,4,são,MG\n", encoding="utf-8")
    rows = sorted(map(tuple, files.read_csv(spark, str(tmp_path), STAGING["sellers"]).collect()))
    assert rows == [("s1", 1, "x", "SP"), ("s2", None, "y", "RJ"), ("s3", 3, "são", "MG"), ("s4", 4, "são", "MG")]
    (tmp_path / "e.csv").write_text("seller_id,seller_city\ns5,z\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix, seller_state"):
        files.read_csv(spark, str(tmp_path), STAGING["sellers"])


def test_prepare_sources(spark, tmp_path):
    from fixture_shop import staging

    feed = spark.createDataFrame([], files.HOLIDAY_FEED)
    tables = staging(spark)
    placed = prepare_sources(tables, feed, str(tmp_path))
    back = files.read_csv(spark, placed["order_items"], STAGING["order_items"])
    assert sorted(map(str, back.collect())) == sorted(map(str, tables["order_items"].collect()))
    back = files.read_category_xml(spark, placed["category_translation_xml"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tables["category_translation"].collect()))
    assert spark.read.parquet(placed["customers"]).count() == 3


def test_sources_to_star_end_to_end(spark, tmp_path):
    """Sources out in their formats, read back, landed and built: the same star."""
    from fixture_shop import staging

    from martlet.operators.warehouse import build_warehouse

    direct = staging(spark)
    feed = direct["holidays"].select(
        F.col("holiday_date").cast("string").alias("date"), F.col("local_name").alias("localName"),
        F.col("english_name").alias("name"), F.col("country_code").alias("countryCode"),
        *[F.lit(None).cast(files.HOLIDAY_FEED[c].dataType).alias(c)
          for c in ("fixed", "global", "counties", "launchYear", "types")])
    placed = prepare_sources(direct, feed, str(tmp_path))
    read = files.read_staging(spark, {n: placed[n] for n in ("orders", "order_items", "payments", "reviews")})
    for name in ("customers", "products", "sellers", "geolocation"):
        read[name] = spark.read.schema(STAGING[name]).parquet(placed[name])
    read["category_translation"] = files.read_category_xml(spark, placed["category_translation_xml"])
    read["holidays"] = files.holidays_staging(files.read_holidays(spark, placed["holidays"]))
    landed = files.land_all(read, Store(spark))
    assert all(landed[n].schema == STAGING[n] for n in STAGING)
    one, two = build_warehouse(spark, direct), build_warehouse(spark, landed)
    for table, df in one.tables().items():
        other = two.tables()[table]
        if table == "FactSales":  # CSV cannot tell a blank text from a missing one
            df, other = df.drop("PaymentTypeKey"), other.drop("PaymentTypeKey")
        if table in ("DimPaymentType", "FactPayment"):
            continue
        assert sorted(map(str, df.collect())) == sorted(map(str, other.collect())), table


def test_bad_values_in_a_csv_file_become_null(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-01-01 10:00:00,never,,2017-02-30 00:00:00,2017-01-05 00:00:00\n")
    row = files.read_csv(spark, str(tmp_path / "o.csv"), STAGING["orders"]).first()
    assert row["order_id"] == "o1" and row["order_approved_at"] is None
    assert row["order_delivered_customer_date"] is None
    assert str(row["order_purchase_timestamp"]) == "2017-01-01 10:00:00"
    assert str(row["order_estimated_delivery_date"]) == "2017-01-05 00:00:00"


def test_master_tables_and_inserts(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert files.replace_table(df, "master_t").count() == 1
    assert files.replace_table(df.union(df), "master_t").count() == 2
    files.insert_columns(spark.createDataFrame([(7,)], "id int"), "master_t")
    rows = spark.table("master_t").filter("id = 7").collect()
    assert rows[0]["name"] is None and spark.table("master_t").count() == 3
    spark.sql("DROP TABLE master_t")


def test_star_in_the_catalog(spark, small):
    spark.sql("CREATE DATABASE gold")
    tables = files.save_star(small.dims, "gold")
    assert {t: df.count() for t, df in tables.items()} == {t: df.count() for t, df in small.dims.items()}
    files.save_star({"DimSeller": small.dims["DimSeller"]}, "gold")  # replaced, not appended
    assert spark.table("gold.DimSeller").count() == small.dims["DimSeller"].count()
    spark.sql("DROP DATABASE gold CASCADE")


def test_landing_casts_bad_text_to_null(spark):
    raw = spark.createDataFrame([("1", "x", "c", "s")], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    assert files.land(raw, "sellers").first()["seller_zip_code_prefix"] is None


def test_gold_round_trip(spark, small, tmp_path):
    star = {k: v for k, v in small.tables().items() if k in ("DimDate", "DimProduct", "FactPayment")}
    files.write_gold(star, str(tmp_path))
    back = files.read_gold(spark, str(tmp_path), star)
    for table, df in star.items():
        assert back[table].schema == STAR[table]
        assert sorted(map(str, back[table].collect())) == sorted(map(str, df.collect()))


def test_load_log(spark, tmp_path):
    log = audit.LoadLog(spark, "load")
    log.write(spark.range(5), "five", str(tmp_path / "five"))
    with pytest.raises(Exception):
        log.write(spark.range(1).select(F.raise_error(F.lit("boom")).alias("x")), "bad", str(tmp_path / "bad"))
    log.append_to(str(tmp_path / "log"))
    log.append_to(str(tmp_path / "log"))
    got = spark.read.parquet(str(tmp_path / "log"))
    assert got.count() == 4
    assert {(r["TaskName"], r["Status"], r["RowsAffected"]) for r in got.collect()} == {
        ("five", "SUCCESS", 5), ("bad", "FAILED", None)}


def test_store_uses_the_shared_folder(spark):
    assert Store(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
