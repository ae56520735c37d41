"""How filters interact: what every order of them keeps and removes, from a Gray-code walk over their subsets.

1. Every document gets a mask of the filters it fails.  Documents of one part (a source) and one mask are a
   cell of counts; a part has at most 2^5 cells, however many documents it holds.
2. For each part a walk in Gray code visits the 32 subsets of filters, turning one filter on or off at a time.
   A cell's counter says how many of the filters that are on fail it.  Turning a filter on takes the cells
   whose counter leaves zero off the running survivors, turning it off gives back those that return to zero.
   The survivors of each of the 32 subsets are stored.
3. Step k of an order leads from the subset of its first k - 1 filters to that of its first k, so whatever a
   step removes is a difference of two stored states, and so are the failures of a filter alone.

Cells are summed before their shuffle, and parts are walked many at a time with array operations.

Defined cases: a null text is empty, a null source is the part of the empty name.  A document fails E if some
row with a smaller ``doc_id`` has an identical text; a null id is neither smaller nor greater than any, and
rows that share id and text do not fail E for each other.  Repeated rows count as often as they occur.  An id
labelled several times counts as good (toxic) if any of its labels says so; labels of absent ids are ignored, and a null id
has no label.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import attach_unique, clean_text, documents, keep

LETTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"
MEASURES = ("n", "good", "toxic")
STEP_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


# ------------------------------------------------------------------ one walk


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of each subset of filters.

    ``cells`` holds counts by (part, mask, measure); the result holds them by (subset, part, measure).
    """
    masks = cells.shape[1]
    failing = np.zeros(masks, np.int64)  # for each cell, how many of the filters that are on it fails
    survivors = cells.sum(axis=1)
    states = np.empty((masks, *survivors.shape), cells.dtype)
    states[0] = survivors
    subset = 0
    for turn in range(1, masks):
        bit = turn & -turn  # the filter that Gray code toggles
        met = np.flatnonzero(np.arange(masks) & bit)
        subset ^= bit
        if subset & bit:
            survivors = survivors - cells[:, met[failing[met] == 0]].sum(axis=1)
            failing[met] += 1
        else:
            failing[met] -= 1
            survivors = survivors + cells[:, met[failing[met] == 0]].sum(axis=1)
        states[subset] = survivors
    return states


def step_table(letters: str) -> tuple[list[str], np.ndarray]:
    """Every order, and for each of its steps in turn: order, step, filter, subset before and subset after."""
    orders = list(permutations(range(len(letters))))
    rows = []
    for k, order in enumerate(orders):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append((k, step, f, before, before | 1 << f))
            before |= 1 << f
    return ["".join(letters[f] for f in order) for order in orders], np.array(rows)


def steps_of(states: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The measures of ``STEP_COLUMNS`` by (part, row of ``table``, measure), each a difference of states."""
    filters = table[:, 2].max() + 1
    _, _, f, before, after = table.T
    everything = (1 << filters) - 1
    bit = 1 << np.arange(filters)
    failed = (states[0] - states[bit])[:, :, 0]  # by filter and part
    alone = (states[everything ^ bit] - states[everything])[:, :, 0]
    lost = states[before] - states[after]
    shapley = np.zeros_like(failed)
    np.add.at(shapley, f, lost[:, :, 0])
    columns = [states[after][:, :, 0], lost[:, :, 0], failed[f] - lost[:, :, 0], alone[f], lost[:, :, 1], lost[:, :, 2], shapley[f]]
    return np.stack(columns, axis=2).transpose(1, 0, 2)


# ------------------------------------------------------------------ on Spark


def text_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of one text."""
    words = F.array_remove(F.split(text, WHITE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * capitals.cast("bigint") > 5 * F.length(text).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part and ``_mask`` of every document; bit k is set if it fails filter k."""
    text = F.col("_text")
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_filters(text))]
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), clean_text().alias("_text"))
    rows = keep(
        rows.select("doc_id", "part", F.unhex(F.sha2(text, 256)).alias("_digest"), sum(bits[1:], bits[0]).alias("_mask")), "filter-masks"
    )
    first = rows.groupBy("_digest").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_rows"))
    seen = attach_unique(rows, first, "_digest", F.col("_rows"), rows.count())
    copy = F.when(F.col("doc_id") > F.col("_least"), 1 << len(bits)).otherwise(0)
    return seen.select("doc_id", "part", (F.col("_mask") + copy).alias("_mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part and its cells: an array of (mask, n, good, toxic)."""
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    counted = masks.join(marks, "doc_id", "left").groupBy("part", "_mask").agg(
        F.count("*").alias("n"), F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_toxic") == 1).alias("toxic")
    )
    return counted.groupBy("part").agg(F.collect_list(F.struct("_mask", *MEASURES)).alias("cells"))  # 32 at most


def audit(parts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order and step of every part, from the cells of ``cells``."""
    orders, table = step_table(letters)
    names = ["part", "filter_order", "step", *STEP_COLUMNS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                yield from _audited(batch.slice(at, 100))

    def _audited(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column("cells")
        owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
        inside = lists.flatten()
        held = np.zeros((len(batch), 1 << len(letters), len(MEASURES)), np.int64)
        held[owner, inside.field("_mask").to_numpy()] = np.column_stack([inside.field(m).to_numpy() for m in MEASURES])
        found = steps_of(walk(held), table)
        n = len(batch)
        columns = [
            batch.column("part").take(pa.array(np.repeat(np.arange(n), len(table)))),
            pa.array(np.array(orders, object)[np.tile(table[:, 0], n)], pa.string()),
            pa.array(np.tile(table[:, 1], n).astype(np.int32)),
            *[pa.array(np.ascontiguousarray(found[:, :, k]).reshape(-1)) for k in range(len(STEP_COLUMNS))],
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    measures = ", ".join(f"{c} bigint" for c in STEP_COLUMNS)
    return parts.mapInArrow(work, f"part string, filter_order string, step int, {measures}")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return audit(cells(masked(documents(spark, folder)), labels))


OP13_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
fails AS (
    SELECT d.doc_id, part,
           [len(words) < 50,
            100 * len(list_distinct(words)) < 65 * len(words),
            100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 5 * length(body),
            regexp_matches(body, '[#$%&*|]'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS f
    FROM docs d
),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, f
),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (
    SELECT [a.k, b.k, c.k, d.k, e.k] AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
),
steps AS (
    SELECT array_to_string(list_transform(o, lambda k: 'ABCDE'[k]), '') AS filter_order, step, o[step] AS own, o[1:step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
met AS (
    SELECT part, filter_order, step, own, n, good, toxic, f[own] AS failed,
           len(list_filter(before, lambda k: f[k])) > 0 AS gone,
           len(list_filter(f, lambda x: x)) = 1 AS single
    FROM cells, steps
),
counted AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failed), 0) AS kept,
           coalesce(sum(n) FILTER (WHERE NOT gone AND failed), 0) AS removed,
           coalesce(sum(n) FILTER (WHERE gone AND failed), 0) AS redundant,
           coalesce(sum(n) FILTER (WHERE failed AND single), 0) AS unique_fails,
           coalesce(sum(good) FILTER (WHERE NOT gone AND failed), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE NOT gone AND failed), 0) AS toxic_lost
    FROM met GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
