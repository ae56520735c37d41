"""What the operators of this subpackage share: reading, storing, hot keys and bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.sources.store import Store

# A key that holds more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them,
# which bounds whatever is broadcast for them.
HOT_SHARE = 1 / 4096
# Code points of text that one step of a Python worker holds at once (a single longer text is held whole).
SLICE_CHARS = 4_000_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def clean_text(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], inside: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches so that the Python texts of one step stay small; a null text comes as empty.

    The texts are in the column ``text``, or in the field of that name of the struct column ``inside``.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(inside or "text"))
        if inside:
            column = pc.struct_field(column, "text")
        sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > SLICE_CHARS:
                yield _slice(batch, column, start, row)
                start, held = row, 0
            held += int(size)
        if len(sizes) > start:
            yield _slice(batch, column, start, len(sizes))


def _slice(batch, column, start, stop):
    return batch.slice(start, stop - start), [t or "" for t in column.slice(start, stop - start).to_pylist()]


def attach_unique(
    left: DataFrame, right: DataFrame, key: str, rows: Column, total: int, share: float = HOT_SHARE
) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row for each ``key``.

    ``rows`` (a column of ``right``) says how many rows of ``left`` hold the key.  The keys that hold
    more than ``share`` of all rows are at most ``1 / share`` in number: their rows meet a broadcast
    and are never shuffled.  All other keys are small enough for an ordinary shuffled join.
    """
    hot = right.filter(rows > int(total * share))
    light = right.filter(rows <= int(total * share))
    hot_keys = F.broadcast(hot.select(key))
    return left.join(hot_keys, key, "left_anti").join(light, key).unionByName(left.join(F.broadcast(hot), key))


def sample_by_hash(df: DataFrame, key: str, rows: int, label: str | None = None, spread: int = 3) -> DataFrame:
    """At most ``rows`` rows (of each value of ``label``, if given), the same ones in every run.

    The rows with the smallest hashes of ``key`` are taken.  A threshold that lets about ``spread``
    times as many rows through is set from counts, so no task sees more than the sample.
    """
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    marked = df.withColumn("_place", place)
    if label is None:
        total = df.count()
        limit = (1 << 40) if total <= rows * spread else (1 << 40) * rows * spread // total
        return marked.filter(F.col("_place") < limit).orderBy("_place", key).limit(rows).drop("_place")
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    parts = []
    for value, total in sorted(counts.items(), key=lambda item: str(item[0])):
        limit = (1 << 40) if total <= rows * spread else (1 << 40) * rows * spread // total
        own = marked.filter(F.col(label).eqNullSafe(F.lit(value)) & (F.col("_place") < limit))
        parts.append(own.orderBy("_place", key).limit(rows).drop("_place"))
    if not parts:
        return df.limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sampled_texts(docs: DataFrame, rows: int, *labels: str, by: str | None = None) -> DataFrame:
    """``doc_id``, ``labels`` and ``text`` of a bounded sample of ``docs`` (of each value of ``by``, if given).

    Ids are chosen before any text is read, and the texts are then fetched in parallel.  An id that
    occurs in several rows gives the smallest of their texts.
    """
    keys = ["doc_id", *labels]
    named = docs.select(*keys).filter(F.col("doc_id").isNotNull()).distinct()
    ids = F.broadcast(sample_by_hash(named, "doc_id", rows, by))  # bounded by the sample
    return docs.select(*keys, "text").join(ids, keys).groupBy(*keys).agg(F.min("text").alias("text"))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder that all executors share and read it back."""
    return Store(df.sparkSession, f"llm-{name}").put(df, name)
