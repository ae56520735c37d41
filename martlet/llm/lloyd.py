"""Vector codes by product quantisation, its codebooks made by a member-resident Lloyd iteration.

Vectors become whole numbers (``floor(256 * x)``) and are cut into equal consecutive parts.  Every part is
a member of one codebook entry and is stored with the other members of that entry, partitioned by
(position, entry, salt).  A round has two steps:

1. Owners update: every owner of a (position, entry, salt) sums its resident members; the sums of the
   owners of one entry are added and divided, rounding down.  No member moves for it.
2. Members choose their nearest entry of the new codebook where they lie.  Those that keep their entry are
   written back in place; only those that change it are dealt to their new owner by the next shuffle.

The salt splits the members of an entry among owners of about ``OWNER_ROWS`` members at most, so an entry
that draws a third of all vectors is spread like any other.  A codebook (positions x entries x components)
is the only thing that reaches the driver; its size does not depend on the number of rows.

Defined cases: vectors that are null, empty or hold a null or non-finite component are dropped, and so are
those whose length differs from the table's.  The table's length is that of the smallest vec_id among
vectors whose length the number of positions divides.  Scaled components are held between -2^b and 2^b,
with b the largest that lets every error fit a long (27 for 64 components, so up to 524,288 before
scaling).  First entries are the parts of the smallest distinct vec_ids, a null id last; of rows that share
an id the smallest vector is taken.  With fewer ids the codebook has as many entries.  Equal distances go to
the entry with the lower index, unused entries stay.  Repeated rows are rows like any others.  Null labels
are one label; an error sum that leaves the range of a long is null.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import attach_unique
from martlet.sources.store import Store

SCALE = 256
POSITIONS = 16
ENTRIES = 64  # at most 256: an index is written as two hexadecimal digits
ROUNDS = 2
OWNER_ROWS = 65_536
_BLOCK = 8192

MEMBER = "_row bigint, position int, entry int, salt bigint, part array<bigint>"


# ------------------------------------------------------------------ whole-number vectors


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_vectors(rows: DataFrame, positions: int = POSITIONS, scale: int = SCALE) -> DataFrame | None:
    """``_row`` (a number of the row), vec_id, label and ``_q``, of the rows that are kept; None if there are none."""
    vector = F.col("embedding").cast("array<double>")
    good = rows.select("vec_id", "label", vector.alias("_v")).filter(_finite(F.col("_v")))
    sized = good.select("vec_id", F.size("_v").alias("_dim")).filter((F.col("_dim") > 0) & (F.col("_dim") % positions == 0))
    first = sized.agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "_dim"))["_dim"].alias("dim")).first()
    if first["dim"] is None:
        return None
    dim = first["dim"]
    bound = float(1 << ((62 - (dim - 1).bit_length()) // 2 - 1))
    whole = F.transform("_v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(bound)), F.lit(-bound))))
    kept = good.filter(F.size("_v") == dim).select("vec_id", "label", whole.alias("_q"))
    return kept.select(F.monotonically_increasing_id().alias("_row"), "*")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (the lower of equal ones) and the squared distance to it."""
    entry, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), _BLOCK):
        own = parts[at : at + _BLOCK]
        far = np.zeros((len(own), len(book)), np.int64)
        for axis in range(book.shape[1]):
            far += (own[:, axis, None] - book[None, :, axis]) ** 2
        entry[at : at + _BLOCK] = far.argmin(axis=1)
        error[at : at + _BLOCK] = far.min(axis=1)
    return entry, error


def _choose(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and error of each member of a batch of one or several positions."""
    position, parts = batch.column("position").to_numpy(), _matrix(batch.column("part"))
    entry, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for p in np.unique(position):
        own = position == p
        entry[own], error[own] = nearest(parts[own], books[p])
    return entry, error


# ------------------------------------------------------------------ the iteration


@dataclass
class Moves:
    """How many members there are, and how many of them moved before each update but the first."""

    members: int
    moved: list[int]


class ResidentLloyd:
    """Codebooks of one table and the members of their entries, stored with their owners."""

    def __init__(
        self,
        kept: DataFrame,
        positions: int = POSITIONS,
        entries: int = ENTRIES,
        rounds: int = ROUNDS,
        owner_rows: int = OWNER_ROWS,
    ):
        self.positions = positions
        self.store = Store(kept.sparkSession, "llm-lloyd")
        self.kept = self.store.put(kept, "vectors")
        total = self.kept.count()
        self.salts = max(-(-total // owner_rows), 1)
        self.books = self._first(entries)
        self.moves = Moves(total * positions, [])
        members = self._settle(self._dealt(), "members-1")
        for turn in range(1, rounds + 1):
            if turn > 1:
                members = self._moved(members, turn)
            self.books = self._updated(members)
        self.members = members

    def _first(self, entries: int) -> np.ndarray:
        ids = [r[0] for r in self.kept.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
        named = F.col("vec_id").isin([i for i in ids if i is not None])
        named = named | F.col("vec_id").isNull() if None in ids else named
        own = self.kept.filter(named).groupBy("vec_id").agg(F.min("_q").alias("_q"))
        rows = own.orderBy(F.asc_nulls_last("vec_id")).collect()  # one row for each entry
        held = np.array([r["_q"] for r in rows], np.int64).reshape(len(rows), self.positions, -1)
        return held.transpose(1, 0, 2)

    def _dealt(self) -> DataFrame:
        """Every part with its nearest first entry."""
        books, positions, salts = self.books, self.positions, self.salts

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, whole = batch.column("_row").to_numpy(), _matrix(batch.column("_q"))
                for p, parts in enumerate(np.split(whole, positions, axis=1)):
                    entry, _ = nearest(parts, books[p])
                    columns = [rows, np.full(len(rows), p, np.int32), entry.astype(np.int32), (rows ^ (rows >> 33)) % salts]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, columns), _lists(parts)], names=["_row", "position", "entry", "salt", "part"]
                    )

        return self.kept.select("_row", "_q").mapInArrow(work, MEMBER)

    def _settle(self, members: DataFrame, name: str) -> DataFrame:
        """Deal members to their owners and store them there."""
        return self.store.put(members.repartition("position", "entry", "salt"), name)

    def _updated(self, members: DataFrame) -> np.ndarray:
        """New codebooks from the sums that owners make of their residents."""
        books = self.books
        _, entries, width = books.shape

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((books.shape[0] * entries, width + 1), np.int64)  # the last column counts
            for batch in batches:
                slot = batch.column("position").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
                np.add.at(sums[:, :width], slot, _matrix(batch.column("part")))
                sums[:, width] += np.bincount(slot, minlength=len(sums))
            used = np.flatnonzero(sums[:, width])
            cells = (used[:, None] * (width + 1) + np.arange(width + 1)).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[used].reshape(-1))], names=["cell", "n"])

        sums = np.zeros((books.shape[0] * entries, width + 1), np.int64)
        found = members.select("position", "entry", "part").mapInArrow(work, "cell bigint, n bigint")
        for cell, n in found.groupBy("cell").agg(F.sum("n")).collect():  # one row for each component of the codebooks
            sums[divmod(cell, width + 1)] = n
        sums = sums.reshape(books.shape[0], entries, width + 1)
        used = sums[:, :, width:] > 0
        return np.where(used, sums[:, :, :width] // np.maximum(sums[:, :, width:], 1), books)

    def _moved(self, members: DataFrame, turn: int) -> DataFrame:
        """Members at the entries of the new codebooks; only those that change theirs are shuffled."""
        books = self.books

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                entry, _ = _choose(batch, books)
                moved = pa.array(entry != batch.column("entry").to_numpy())
                batch = batch.set_column(2, "entry", pa.array(entry.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, moved], names=[*batch.schema.names, "moved"])

        chosen = self.store.put(members.mapInArrow(work, f"{MEMBER}, moved boolean"), f"chosen-{turn}", ["moved"])
        stay = chosen.filter(~F.col("moved")).drop("moved")
        go = chosen.filter("moved").drop("moved")
        self.moves.moved.append(go.count())
        return stay.unionByName(self._settle(go, f"members-{turn}"))

    def codes(self) -> DataFrame:
        """``_row``, code and error of every kept row under the final codebooks."""
        books = self.books

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                entry, error = _choose(batch, books)
                columns = [batch.column("_row"), batch.column("position"), pa.array(entry.astype(np.int32)), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "position", "entry", "error"])

        chosen = self.members.mapInArrow(work, "_row bigint, position int, entry int, error bigint")
        digits = F.lower(F.lpad(F.hex("entry"), 2, "0"))
        by_row = chosen.groupBy("_row").agg(
            F.array_sort(F.collect_list(F.struct("position", digits.alias("digits")))).alias("_at"),  # one for each position
            F.sum("error").alias("error"),
        )
        return by_row.select("_row", F.array_join("_at.digits", "").alias("code"), "error")

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over all rows of the same label."""
    named = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = coded.withColumn("_label", named)
    sums = rows.groupBy("_label").agg(F.count("*").alias("_rows"), F.try_sum("error").alias("label_error"))
    return attach_unique(rows, sums, "_label", F.col("_rows"), coded.count()).drop("_label", "_rows")


def compress(rows: DataFrame, **options: int) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept row."""
    kept = whole_vectors(rows, options.get("positions", POSITIONS))
    if kept is None:
        none = {"code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
        return rows.select("vec_id", "label", *[F.lit(None).cast(t).alias(c) for c, t in none.items()]).limit(0)
    model = ResidentLloyd(kept, **options)
    named = model.kept.select("_row", "vec_id", "label")
    coded = model.store.put(named.join(model.codes(), "_row").drop("_row"), "codes")
    return label_errors(coded).withColumn("codebooks_sha256", F.lit(model.codebooks_sha256()))


def op11_resident_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


# One assignment of all parts to a codebook, and the codebook that follows from it (whole division rounds towards zero).
_ASSIGN_SQL = """
a{turn} AS MATERIALIZED (
    SELECT rid, pos, min_by(entry, far * 64 + entry) AS entry, min(far) AS far
    FROM (
        SELECT rid, pos, entry, list_sum(list_transform(list_zip(part, center), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
        FROM parts JOIN book{last} USING (pos)
    ) GROUP BY rid, pos
)"""
_UPDATE_SQL = """
book{turn} AS MATERIALIZED (
    SELECT pos, entry, coalesce(moved.center, book{last}.center) AS center
    FROM book{last} LEFT JOIN (
        SELECT pos, entry, list(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END ORDER BY i) AS center
        FROM (
            SELECT pos, entry, i, CAST(sum(part[i]) AS BIGINT) AS s, count(*) AS n
            FROM a{turn} JOIN parts USING (rid, pos), range(1, 5) AS r(i) GROUP BY pos, entry, i
        ) GROUP BY pos, entry
    ) moved USING (pos, entry)
)"""

OP11_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (SELECT rid, pos, q[pos * 4 + 1 : pos * 4 + 4] AS part FROM kept, range(16) AS r(pos)),
book0 AS MATERIALIZED (
    SELECT pos, entry, q[pos * 4 + 1 : pos * 4 + 4] AS center
    FROM (SELECT q, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64), range(16) AS r(pos)
),
{_ASSIGN_SQL.format(turn=1, last=0)},
{_UPDATE_SQL.format(turn=1, last=0)},
{_ASSIGN_SQL.format(turn=2, last=1)},
{_UPDATE_SQL.format(turn=2, last=1)},
{_ASSIGN_SQL.format(turn=3, last=2)},
coded AS (
    SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY pos) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM a3 GROUP BY rid
),
books AS (
    SELECT sha256(string_agg(array_to_string(center, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""
