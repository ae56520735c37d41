"""Best-fit packing of token sequences by a configuration linear program.

Every text becomes ids plus an end id; texts longer than a sequence are cut.  Pieces of equal length are
interchangeable, so the packing is decided on the length histogram (at most one count for each possible
length) and not on the pieces:

1. Multiplicative weights solve the covering program over configurations.  Each round prices the length
   classes, finds the most valuable configuration by a knapsack dynamic program, uses it, and lowers the
   weight of what it covers.
2. Rounding turns configurations into bundles of sequences with concrete lengths, as often as the counts
   allow, topping up each sequence with the largest length that fits.  What the program leaves over is
   packed by the same best fit, largest first.
3. A bundle takes consecutive ranks of each length.  The pieces are ranked within their length by one
   range sort, and an interval look-up gives sequence and offset.

Only the histogram reaches the driver, and only the intervals (bounded by the number of lengths and
rounds) go to the tasks.  Null texts are empty; an empty text is the end id alone.  Repeated rows are
packed as often as they occur.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martlet.llm.common import documents, keep, slices
from martlet.llm.tokens import END, word_tokens
from martlet.operators.keys import number_rows
from martlet.sources.store import Store

CAPACITY = 4096
ROUNDS = 800
CLASS_WIDTH = 8
LEARNING_RATE = 0.5

PIECES_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ the program on the histogram


def best_configuration(values: np.ndarray, units: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: how often to take each class so that the value is greatest."""
    best = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    order = np.argsort(units, kind="stable")
    sizes, worth = units[order], values[order]
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            total = best[room - sizes[: fits[room]]] + worth[: fits[room]]
            top = int(total.argmax())
            if total[top] > best[room]:
                best[room], chosen[room] = total[top], top
    taken: dict[int, int] = {}
    room = capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
            continue
        k = int(order[chosen[room]])
        taken[k] = taken.get(k, 0) + 1
        room -= int(units[k])
    return taken


def solve_program(
    counts: np.ndarray, capacity: int, width: int = CLASS_WIDTH, rounds: int = ROUNDS
) -> list[tuple[dict[int, int], float]]:
    """Configurations {length class: copies} with their fractional use.

    ``counts[l]`` is the number of pieces of length ``l``.  Class ``k`` holds the lengths from
    ``k * width + 1`` to ``(k + 1) * width`` and is priced at its longest.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    classes, inverse = np.unique((lengths - 1) // width, return_inverse=True)
    demand = np.bincount(inverse, weights=counts[lengths])
    units = classes + 1
    room = capacity // width
    weight = np.ones(len(classes))
    cover = np.zeros(len(classes))
    use: dict[tuple, float] = {}
    for _ in range(rounds):
        pattern = best_configuration(weight / weight.sum() / demand, units, room)
        if not pattern:
            break
        items = np.array(list(pattern))
        copies = np.array(list(pattern.values()), dtype=float)
        step = (demand[items] / copies).min()
        gain = step * copies / demand[items]
        cover[items] += gain
        weight[items] *= np.exp(-LEARNING_RATE * gain)
        key = tuple(sorted(pattern.items()))
        use[key] = use.get(key, 0.0) + step
    volume = demand * units
    scale = volume.sum() / max((volume * cover).sum(), 1e-12)  # the uses together carry all tokens once
    return [({int(classes[k]): n for k, n in key}, x * scale) for key, x in use.items()]


@dataclass
class Bundles:
    """Intervals sorted by (length, first): where the pieces of each length and rank go."""

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length << 44 | self.first
        at = np.searchsorted(key, length << 44 | rank, side="right") - 1
        local = rank - self.first[at]
        copies = self.copies[at]
        return self.sequence[at] + local // copies, self.offset[at] + local % copies * length


def round_program(
    counts: np.ndarray, capacity: int, program: list[tuple[dict[int, int], float]], width: int = CLASS_WIDTH
) -> Bundles:
    """Whole sequences from a fractional solution, then best fit for what is left."""
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    # below[l]: the largest length up to l with pieces left; paths are shortened as lengths run out
    below = np.arange(len(left))

    def largest(limit: int) -> int:
        path = []
        while limit > 0 and left[limit] == 0:
            path.append(limit)
            limit = below[limit] if below[limit] < limit else limit - 1
        for p in path:
            below[p] = limit
        return int(limit)

    def bundle(items: dict[int, int], room: int, limit: float, waste: int) -> int:
        """Top up ``items`` with the largest lengths that fit and emit as many sequences as counts allow.

        Nothing is emitted if more than ``waste`` places would stay empty.
        """
        nonlocal sequences
        while room > 0:
            size = largest(min(room, capacity))
            while size > 0 and left[size] <= items.get(size, 0):
                size = largest(size - 1)
            if size <= 0:
                break
            more = min(room // size, int(left[size]) - items.get(size, 0))
            items[size] = items.get(size, 0) + more
            room -= more * size
        if not items or room > waste:
            return 0
        times = int(min(limit, min(left[s] // n for s, n in items.items())))
        offset = 0
        for size in sorted(items, reverse=True):
            n = items[size]
            rows.append((size, int(used[size]), n, sequences, offset))
            used[size] += n * times
            left[size] -= n * times
            offset += n * size
        sequences += times
        return times

    for pattern, share in sorted(program, key=lambda p: (-p[1], sorted(p[0].items()))):
        wanted = int(share)
        while wanted > 0:
            items: dict[int, int] = {}
            room = capacity
            smallest = min(pattern)
            for k, n in sorted(pattern.items(), reverse=True):
                n -= k == smallest  # the last place goes to whatever fits best in what is really left
                while n > 0:
                    size = largest((k + 1) * width if (k + 1) * width < len(left) else len(left) - 1)
                    while size > k * width and left[size] <= items.get(size, 0):
                        size = largest(size - 1)
                    if size <= k * width:
                        break
                    more = min(n, int(left[size]) - items.get(size, 0))
                    items[size] = items.get(size, 0) + more
                    room -= more * size
                    n -= more  # what the class no longer holds is topped up with other lengths
            if not items and not left.any():
                break
            made = bundle(items, room, wanted, 0)
            if not made:
                break
            wanted -= made
    while (size := largest(capacity)) > 0:
        bundle({size: 1}, capacity - size, np.inf, capacity)
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Bundles(*(np.ascontiguousarray(table[:, k]) for k in range(5)), sequences)


# ------------------------------------------------------------------ on Spark


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document, with the checksum of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer)
        for batch, texts in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                ids = tokens.ids(text) + END
                total = len(ids) // 4
                for k, start in enumerate(range(0, total, capacity)):
                    stop = min(start + capacity, total)
                    rows.append((doc_id, k, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES_SCHEMA)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece of a stored table (a row with ``length``) its sequence and its offset there."""
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most one row for each length
        counts[length] = n
    bundles = round_program(counts, capacity, solve_program(counts, capacity))
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    shared = spark.sparkContext.broadcast((bundles, before))  # bounded by lengths and rounds, not by pieces
    order = ["length", *[c for c in cut.columns if c != "length"]]
    ranked = number_rows(cut, "_rank", order, Store(spark, "llm-packing"), "ranked", start=0, stored=True)
    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, starts = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(0).to_numpy() - starts[length]
            sequence, offset = plan.place(length, rank)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    added = T.StructType.fromDDL("sequence_id bigint, offset bigint")
    return ranked.mapInArrow(place, T.StructType([*cut.schema.fields, *added.fields]))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Cut, tokenise and pack; the pieces are stored once so that counting and sorting only read them."""
    return pack(keep(pieces(docs, tokenizer or vocabulary(), capacity), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder))
