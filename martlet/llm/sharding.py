"""Shards of near-equal size by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that stays together.  Groups enter the bins from the largest to the
smallest, each into the bin with the least remaining capacity that still holds it, found in a balanced
search tree.  Groups of equal size class are interchangeable and a bin that just took one is still the
tightest, so a class is placed run by run: the packing needs only the number of groups in each class.
A class is a size rounded up to ten significant bits, so there are at most 512 classes for each doubling
of size, whatever the number of rows; that histogram is all that reaches the driver.  The runs go back as
a table and every group finds its run by its rank in its class.

With a number of shards the capacity is the smallest one for which best fit needs no more of them.  A
single row larger than the equal share has a shard to itself.  A group larger than the equal share can
not fit any shard of that size: it is cut into the fewest pieces that do (the only groups that are cut,
at most as many as there are shards), since otherwise the sizes could not be near equal.

Defined cases: a null text equals an empty one and has no bytes.  Ties and repeated rows are numbered in
any order within their group.  Null ids are rows like others.  An empty table gives an empty one.  Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import attach_unique, clean_text, documents, keep
from martlet.operators.keys import number_rows
from martlet.sources.store import Store

SHARDS = 40
ROW_OVERHEAD = 16
CLASS_BITS = 10


# ------------------------------------------------------------------ bins


class BinTree:
    """Bins by remaining capacity in a treap; priorities come from a fixed linear generator."""

    def __init__(self) -> None:
        self._root = None
        self._state = 1

    def _split(self, node, key):
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high

    def add(self, remaining: int, name: int) -> None:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        low, high = self._split(self._root, (remaining, name))
        self._root = self._merge(self._merge(low, [(remaining, name), self._state, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of at least ``size``."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        first = high
        while first[2] is not None:
            first = first[2]
        rest_low, rest = self._split(high, (first[0][0], first[0][1] + 1))
        assert rest_low is first
        self._root = self._merge(low, rest)
        return first[0]


@dataclass
class Run:
    """``count`` groups of class ``size``, from rank ``first`` on, go into ``shard``."""

    size: int
    first: int
    count: int
    shard: int


def best_fit_decreasing(histogram: dict[int, int], capacity: int, first_shard: int = 0) -> tuple[list[Run], int]:
    """Runs and the number of shards opened; no size may exceed ``capacity``."""
    bins, runs, opened = BinTree(), [], 0
    for size in sorted(histogram, reverse=True):
        placed = 0
        while placed < histogram[size]:
            found = bins.take_tightest(size)
            if found is None:
                found = (capacity, opened)
                opened += 1
            remaining, name = found
            n = min(histogram[size] - placed, remaining // size)
            runs.append(Run(size, placed, n, first_shard + name))
            placed += n
            if remaining > n * size:
                bins.add(remaining - n * size, name)
    return runs, opened


def pack_into(histogram: dict[int, int], shards: int) -> list[Run]:
    """Best fit decreasing into at most ``shards`` shards of the smallest capacity that allows it."""
    left, runs, used = dict(histogram), [], 0
    while left and used < shards:
        size, total = max(left), sum(s * n for s, n in left.items())
        if size * (shards - used) <= total or used == shards - 1:
            break
        runs.append(Run(size, histogram[size] - left[size], 1, used))  # larger than an equal share
        used += 1
        left[size] -= 1
        if not left[size]:
            del left[size]
    if not left:
        return runs
    room = shards - used
    total = sum(s * n for s, n in left.items())
    low, high = max(max(left), -(-total // room)), total
    while low < high:
        middle = (low + high) // 2 if high < total else min(low + low // 64 + 1, (low + high) // 2)
        if best_fit_decreasing(left, middle)[1] <= room:
            high = middle
        else:
            low = middle + 1
    rest, _ = best_fit_decreasing(left, low, used)
    before = {s: histogram[s] - n for s, n in left.items()}
    return runs + [Run(r.size, r.first + before[r.size], r.count, r.shard) for r in rest]


# ------------------------------------------------------------------ on Spark


def size_class(size: Column) -> Column:
    """``size`` rounded up to ten significant bits."""
    digits = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    step = F.pow(F.lit(2), digits).cast("bigint")
    return ((size + step - 1) - F.pmod(size + step - 1, step)).cast("bigint")


class Shards:
    """Best-fit-decreasing shards of one table."""

    def __init__(self, docs: DataFrame, shards: int = SHARDS):
        self.spark, self.shards = docs.sparkSession, shards
        text = clean_text()
        self.rows = keep(
            docs.select(
                F.col("doc_id"),
                (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
                F.crc32(text.cast("binary")).alias("text_crc32"),
                F.unhex(F.sha2(text, 256)).alias("_group"),
            ),
            "shard-rows",
        )

    def placed(self) -> DataFrame:
        """Every row with its shard."""
        rows, store = self.rows, Store(self.spark, "llm-sharding")
        total_bytes, total_rows = rows.agg(F.sum("size"), F.count("*")).first()
        if not total_rows:
            return rows.withColumn("shard", F.lit(0))
        share = -(-total_bytes // self.shards)
        groups = store.put(
            rows.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"), F.max("size").alias("_each")),
            "groups",
        )
        whole = groups.filter((F.col("_bytes") <= share) | (F.col("_rows") == 1))
        large = groups.filter((F.col("_bytes") > share) & (F.col("_rows") > 1))  # fewer than ``shards`` of them
        take = F.greatest(F.lit(1), F.floor(F.lit(share) / F.col("_each"))).cast("bigint")
        large = store.put(large.withColumn("_take", take), "large-groups")
        pieces = large.select(
            "_group", "_rows", "_each", "_take", F.explode(F.expr("sequence(0, (_rows - 1) div _take)")).alias("_piece")
        ).withColumn("_held", F.least(F.col("_take"), F.col("_rows") - F.col("_piece") * F.col("_take")))
        units = whole.select("_group", F.lit(0).cast("bigint").alias("_piece"), "_bytes", "_rows").unionByName(
            pieces.select("_group", "_piece", (F.col("_held") * F.col("_each")).alias("_bytes"), F.col("_held").alias("_rows"))
        )
        units = units.withColumn("_class", size_class(F.col("_bytes")))
        units = number_rows(units, "_rank", ["_class", "_group", "_piece"], store, "units", start=0)
        histogram = {r["_class"]: r["n"] for r in units.groupBy("_class").agg(F.count("*").alias("n")).collect()}
        runs = pack_into(histogram, self.shards)
        starts, at = {}, 0
        for size in sorted(histogram):
            starts[size], at = at, at + histogram[size]
        table = self.spark.createDataFrame(
            [(r.size, starts[r.size] + r.first, starts[r.size] + r.first + r.count, r.shard) for r in runs],
            "_run_class bigint, _from bigint, _to bigint, shard int",
        )
        # the runs are bounded by classes and shards
        inside = (F.col("_class") == F.col("_run_class")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
        units = store.put(units.join(F.broadcast(table), inside).select("_group", "_piece", "_rows", "shard"), "unit-shards")

        cut = F.broadcast(large.select("_group", "_take"))
        plain = units.join(cut.select("_group"), "_group", "left_anti")
        out = attach_unique(rows.join(cut.select("_group"), "_group", "left_anti"), plain.drop("_piece"), "_group", F.col("_rows"), total_rows)
        out = out.select(*rows.columns, "shard")
        if large.isEmpty():
            return out
        # rows of cut groups: their number within the group says which piece they belong to
        hot = number_rows(rows.join(cut, "_group"), "_number", ["_group", "doc_id"], store, "cut-rows", start=0)
        first = hot.groupBy("_group").agg(F.min("_number").alias("_first"))
        hot = hot.join(F.broadcast(first), "_group").withColumn("_piece", F.expr("(_number - _first) div _take"))
        hot = hot.join(F.broadcast(units.join(cut.select("_group"), "_group", "left_semi")), ["_group", "_piece"])
        return out.unionByName(hot.select(*rows.columns, "shard"))

    def numbered(self) -> DataFrame:
        """Every row with its shard and its slot there, gapless from 0."""
        store = Store(self.spark, "llm-slots")
        placed = store.put(self.placed(), "placed")
        ordered = number_rows(placed, "_number", ["shard", "_group", "doc_id"], store, "slots", start=0, stored=True)
        first = placed.groupBy("shard").agg(F.count("*").alias("n")).collect()  # one row for each shard
        starts, at = [], 0
        for row in sorted(first, key=lambda r: r["shard"]):
            starts += [F.lit(row["shard"]), F.lit(at)]
            at += row["n"]
        if not starts:
            return ordered.withColumn("slot", F.col("_number"))
        return ordered.withColumn("slot", F.col("_number") - F.create_map(*starts)[F.col("shard")])


def op6_best_fit_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return Shards(documents(spark, folder)).numbered().select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
