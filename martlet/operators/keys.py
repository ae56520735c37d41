"""Dense surrogate keys without a single-partition window.

The rows are laid out in key order by one range shuffle and written once with
their (partition, position) pair.  Only the row count of each partition reaches
the driver, one number per partition, and the key is then plain arithmetic on
the stored pair: readers that do not need the key never pay for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.sources.store import Store

ROW_PLACE = "_row_place"
FIRST_NUMBER = "_first_number"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
_STEP = 4096  # rows of a key that are counted out by one array


def lay_out(
    df: DataFrame,
    order_by: Sequence[str],
    store: Store,
    table: str,
    partition_by: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    stored: bool = False,
) -> DataFrame:
    """Globally sort ``df`` and store it with each row's place in the order.

    All of ``order_by`` takes part in the range split, so rows sharing the
    leading column can still be spread over many partitions.  ``finish`` may add
    columns once the places are fixed.  A range split samples its input before it
    moves it: ``df`` is stored first, so that the sample is a scan of one column set
    and not a second run of the joins that made it.  With ``stored`` it already is.
    """
    unsorted = f"{table}_unsorted"
    if not stored:
        df = store.put(df, unsorted)
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(ROW_PLACE, F.monotonically_increasing_id())
    )
    out = store.put(finish(ordered), table, partition_by)
    if not stored:
        store.drop(unsorted)
    return out


def dense_key(stored: DataFrame, start: int = 1, places: Column | None = None) -> Column:
    """Consecutive numbers from ``start`` in the stored order, as a Column.

    ``places`` counts the places that rows take, one each if it is not given.
    """
    partition = F.shiftright(ROW_PLACE, _POSITION_BITS)
    taken = F.count("*") if places is None else places
    counts = {
        row["part"]: row["n"]
        for row in stored.groupBy(partition.alias("part")).agg(taken.alias("n")).collect()
    }
    last = max(counts, default=0)
    offsets = accumulate((counts.get(p, 0) for p in range(last)), initial=start)
    table = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    position = F.col(ROW_PLACE).bitwiseAND((1 << _POSITION_BITS) - 1)
    return table[partition.cast("int")] + position


def number_rows(
    df: DataFrame, key: str, order_by: Sequence[str], store: Store, table: str, start: int = 1, stored: bool = False
) -> DataFrame:
    """``df`` with the dense key as its first column."""
    placed = lay_out(df, order_by, store, table, stored=stored)
    return placed.select(dense_key(placed, start).alias(key), *df.columns)


def first_numbers(counts: DataFrame, key: str, rows: str, store: Store, table: str, start: int = 1) -> DataFrame:
    """``counts`` and the number that the first row of each key has when all rows are numbered by key.

    ``rows`` holds how many rows a key has, at least one.  Only ``counts`` is sorted: each task counts
    the rows of its keys out, a few thousand at a time, and keeps the place of the first.
    """
    ordered = counts.repartitionByRange(key).sortWithinPartitions(key)
    last, zero = F.col(rows).cast("bigint") - 1, F.lit(0).cast("bigint")
    steps = F.explode(F.sequence(zero, last, F.lit(_STEP).cast("bigint")))
    each = ordered.select("*", steps.alias("_from"))
    each = each.select("*", F.explode(F.sequence("_from", F.least(F.col("_from") + (_STEP - 1), last))).alias("_nth"))
    placed = each.withColumn(ROW_PLACE, F.monotonically_increasing_id()).filter(F.col("_nth") == 0)
    stored = store.put(placed.select(*counts.columns, ROW_PLACE), table)
    return stored.select(*counts.columns, dense_key(stored, start, F.sum(rows)).alias(FIRST_NUMBER))
