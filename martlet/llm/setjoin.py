"""Similar sets of hashes: exact links found by rarity-ordered prefixes, without the square of a large group.

Two sets are linked if they share at least ``a / b`` of their union.  Every set is put into one global order,
rarest hash first, by a table of hashed counts of constant size (any order gives the same links, rarity only
saves work).  Sets that are linked share a hash among the first ``n - ceil(a / b * n) + 1`` of each, and what
follows the first shared place bounds what they can share at all.  An equi-join on these hashes with the size
and place bounds in the join yields every linked pair; a passage that many sets hold sorts last and brings
only those together that are close to the bound.

Every set also has a sketch: ``SKETCH_BITS`` bits, each the parity of the number of its hashes that fall on it.
A hash held by one of two sets alone flips one bit, so two sketches differ in at most as many bits as the sets
differ in hashes.  Pairs whose sketches differ in more than a linked pair may are refused in the bucket join
itself; the bound is exact, so no link is lost, and the whole sets of few other pairs are read.

Members of a bucket of few rows (``FEW``) meet pair by pair; what their sizes, places and sketches allow is one table of
pairs.  Of these each set is verified with the first other one, and then what lies in different components.  Larger
buckets meet hub by hub (``BucketLinks``): the members are compared with one of them, the components of these links
are taken, and the next hub is chosen among what is outside.  When a round links nothing more, members of different
components meet directly.  Pairs left out lie in one component, so the components are those of all linked pairs.

Whole sets are read from the texts.  A table of bits of constant size, one for each slot of places that are wanted,
keeps the other texts out of the shuffle; what shares a slot by chance goes in the join that follows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from martlet.llm.common import slices
from martlet.llm.components import components
from martlet.llm.near import SEED, majority, shingle_hashes
from martlet.sources.store import Store

Least = tuple[int, int]  # the least similarity, as a fraction
_NONE = np.zeros(0, np.uint64)

SLOT_BITS = 20  # slots of the table of counts
SKETCH_BITS = 512
_LONGS = [f"_{k}" for k in range(SKETCH_BITS // 64)]
FEW = 16  # rows of a bucket whose members meet pair by pair
ROUNDS = 4  # of hubs, before members of different components meet directly
SIEVE_BITS = 23  # of the number of a slot of places
_CHUNKS = 64
_SEEN = 200_000


# ------------------------------------------------------------------ sets


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def set_digest(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes on each of ``SKETCH_BITS`` bits, as signed longs."""
    counts = np.bincount((hashes % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _sketches(sets: list[np.ndarray]) -> pa.StructArray:
    table = np.array([sketch(s) for s in sets], np.int64).reshape(len(sets), len(_LONGS))
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(_LONGS))], names=_LONGS)


SKETCH = f"struct<{', '.join(f'{name}: bigint' for name in _LONGS)}>"
ROW_COLUMNS = f"doc_id bigint, _mark bigint, _print bigint, _size bigint, _simhash bigint, _sketch {SKETCH}"


def set_rows(
    docs: DataFrame, words: int, keys: Callable[[list[np.ndarray]], list[np.ndarray]], simhashes: bool = False
) -> DataFrame:
    """doc_id, a mark that tells rows of one id apart, digest and size of the set, its sketch and ``_keys``.

    ``keys`` gives the bucket keys of several sets; they are left out where the same task has just given an
    equal set, so that copies stay slim.  With ``simhashes`` there is the SimHash of ``near``, too (else null).
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("_mark"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in slices(batches):
            hashes = [shingle_hashes(t, words) for t in texts]
            sets = [np.unique(h) for h in hashes]
            prints = [set_digest(s) for s in sets]
            marks = np.array([majority(h) for h in hashes], np.uint64).view(np.int64) if simhashes else None
            new = []
            for k, digest in enumerate(prints):
                if digest not in seen and len(sets[k]):
                    new.append(k)
                seen.add(digest)
            if len(seen) > _SEEN:
                seen.clear()
            found = dict(zip(new, keys([sets[k] for k in new]) if new else []))
            lists = [found.get(k, _NONE) for k in range(len(sets))]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.nulls(len(sets), pa.int64()) if marks is None else pa.array(marks),
                _sketches(sets),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).view(np.int64))),
            ]
            names = ["doc_id", "_mark", "_print", "_size", "_simhash", "_sketch", "_keys"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(work, f"{ROW_COLUMNS}, _keys array<bigint>")


def sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node`` and ``_set``, the sorted hashes, of the sets in ``nodes``, each once: it is read from the text of one row.

    ``classes`` names that row of each set: ``_print`` and ``_first`` (no_id, doc_id, mark).  The places of these
    rows are stored first, so the planner knows their size; of the texts only those that pass the sieve move.
    """
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("_mark"))
    wanted = classes.withColumnRenamed("_print", "node").join(nodes, "node", "left_semi")
    wanted = wanted.select("node", F.xxhash64("_first").alias("_place"), "_first")
    wanted = Store(docs.sparkSession, "llm-wanted").put(wanted, "wanted")
    texts = docs.select("text", at.alias("_at")).withColumn("_place", F.xxhash64("_at"))
    texts = sieved(texts, wanted)
    met = texts.join(wanted.withColumnRenamed("_place", "_wanted"), (F.col("_place") == F.col("_wanted")) & F.col("_at").eqNullSafe(F.col("_first")))
    met = met.dropDuplicates(["_place", "node"])  # by the key of the join; rows repeated in full

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            sets = [shingle_set(t, words) for t in texts]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "_set"])

    return met.select("node", "text").mapInArrow(work, "node bigint, _set array<bigint>")


def sieved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``_place`` may be among those of ``wanted``: all that are and a few others, without a shuffle of ``rows``.

    One row of 2^(SIEVE_BITS - 6) longs is broadcast, whatever ``wanted`` holds.
    """
    word = F.shiftright(F.pmod("_place", F.lit(1 << SIEVE_BITS)), 6)
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    blank = rows.sparkSession.range(1 << (SIEVE_BITS - 6)).select("id", F.lit(0).cast("bigint").alias("mark"))
    words = blank.union(wanted.select(word, bit)).groupBy("id").agg(F.bit_or("mark").alias("mark"))
    bits = words.agg(F.array_sort(F.collect_list(F.struct("id", "mark"))).getField("mark").alias("_bits"))
    held = bit.bitwiseAND(F.get("_bits", word.cast("int"))) != 0
    return rows.join(F.broadcast(bits), held, "left_semi")


def _hashes(cell: pa.ListScalar) -> np.ndarray:
    return cell.values.to_numpy().view(np.uint64)


# ------------------------------------------------------------------ rarity and prefixes


def rarity(rows: DataFrame, words: int | None = None) -> np.ndarray:
    """For each slot a level that grows with the number of hashes in it: one byte for each of 2^SLOT_BITS slots.

    ``rows`` holds texts (column ``text``) if ``words`` is given, else sets (column ``_set``).
    """
    size = 1 << SLOT_BITS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        if words is None:
            yield from (_hashes(cell) for batch in batches for cell in batch.column(0))
        else:
            yield from (shingle_set(text, words) for _, texts in slices(batches) for text in texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for own in each(batches):
            np.add.at(sums, _slots(own), 1)
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(sums, _CHUNKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "sums"])

    def summed(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(raw.as_py()), np.int64) for raw in part["sums"])
        levels = (4 * np.log2(total + 1)).astype(np.uint8).tobytes()
        return pa.table({"chunk": part["chunk"].slice(0, 1), "levels": pa.array([levels], pa.binary())})

    counted = rows.select("_set" if words is None else "text").mapInArrow(count, "chunk int, sums binary")
    found = counted.groupBy("chunk").applyInArrow(summed, "chunk int, levels binary").collect()  # 64 rows, one MB together
    levels = np.zeros((_CHUNKS, size // _CHUNKS), np.uint8)
    for chunk, raw in found:
        levels[chunk] = np.frombuffer(raw, np.uint8)
    return levels.reshape(-1)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(hashes: np.ndarray, levels: np.ndarray, least: Least) -> np.ndarray:
    """The first hashes of a set in the order of rarity, as many as a linked set must share one of."""
    n = len(hashes)
    if not n:
        return hashes
    order = np.lexsort((hashes, levels[_slots(hashes)]))
    return hashes[order[: n + least[0] * n // -least[1] + 1]]


def prefix_members(rows: DataFrame) -> DataFrame:
    """Members of the buckets of all prefix hashes: ``_bucket`` and ``at`` (place, size, node); ``rows`` has ``_keys``."""
    placed = rows.select("_print", "_size", F.posexplode("_keys").alias("place", "_bucket"))
    return placed.select("_bucket", F.struct(F.col("place"), F.col("_size").alias("size"), F.col("_print").alias("node")).alias("at"))


def close_sizes(x: Column, y: Column, least: Least) -> Column:
    return least[1] * F.least(x["size"], y["size"]) >= least[0] * F.greatest(x["size"], y["size"])


def close_places(x: Column, y: Column, least: Least) -> Column:
    """Whether what follows a shared hash, if it is the first one, is enough; it also keeps to the prefixes of both."""
    rest = F.least(x["size"] - x["place"], y["size"] - y["place"])
    return close_sizes(x, y, least) & ((least[0] + least[1]) * rest >= least[0] * (x["size"] + y["size"]))


def close_sketches(x: Column, y: Column, least: Least) -> Column:
    """Whether the sketches differ in no more bits than sets of these sizes may that share enough."""
    bits = reduce(add, [F.bit_count(x["sketch"][name].bitwiseXOR(y["sketch"][name])) for name in _LONGS])
    return (least[0] + least[1]) * bits <= (least[1] - least[0]) * (x["size"] + y["size"])


# ------------------------------------------------------------------ links


def verified(pairs: DataFrame, sets: DataFrame, least: Least) -> DataFrame:
    """The pairs ``a``, ``b`` of ``pairs`` whose whole sets are similar; row by row, so sets of any size are held singly."""
    first = sets.select(F.col("node").alias("a"), F.col("_set").alias("_left"))
    second = sets.select(F.col("node").alias("b"), F.col("_set").alias("_right"))
    full = pairs.hint("merge").join(first, "a").hint("merge").join(second, "b")
    both = F.size(F.array_intersect("_left", "_right")).cast("bigint")
    enough = least[1] * both >= least[0] * (F.size("_left") + F.size("_right") - both)
    return full.filter(enough).select("a", "b")


def stored_links(
    store: Store, name: str, pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame], least: Least
) -> tuple[DataFrame, bool]:
    """The similar ones among stored pairs, stored as well, and whether there are any; only their sets are fetched."""
    if pairs.isEmpty():
        return pairs, False
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = store.put(fetch(nodes), f"sets-{name}")
    seen = Observation()
    found = store.put(verified(pairs, sets, least).observe(seen, F.count("*").alias("rows")), f"links-{name}")
    store.drop(f"sets-{name}")
    return found, seen.get["rows"] > 0


def sketches_of(rows: DataFrame) -> DataFrame:
    """``node`` and ``sketch`` of each set of ``set_rows``."""
    return rows.select(F.col("_print").alias("node"), F.col("_sketch").alias("sketch")).dropDuplicates(["node"])


def _pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct pairs ``a < b`` of the nodes of two columns."""
    x, y = F.col(x)["node"], F.col(y)["node"]
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


class BucketLinks:
    """Links between members of the same bucket, hub by hub.

    ``members`` has ``_bucket`` and ``at``, a struct that orders hubs and holds ``size`` and ``node``; ``sketches`` has
    ``node`` and ``sketch``.  ``close`` says of two such structs whether the pair may be similar.  ``fetch`` gives
    ``node`` and ``_set`` of a table of nodes, each once.  With ``large`` there is one hub for each bucket of more than
    ``FEW`` rows, and those that then hold more than ``large`` open pairs are left to the caller: their members are in
    ``large_nodes``.  ``known`` are links found before; they are not tried again, and what they connect meets no further hub.
    """

    def __init__(
        self,
        members: DataFrame,
        sketches: DataFrame,
        fetch: Callable[[DataFrame], DataFrame],
        close: Callable[[Column, Column], Column],
        least: Least,
        large: int | None = None,
        known: DataFrame | None = None,
    ):
        self.store = Store(members.sparkSession, "llm-buckets")
        self.fetch, self.least = fetch, least
        self.close = lambda x, y: close(x, y) & close_sketches(x, y, least)
        self.turn, self.large_nodes = 0, None
        self.tried, self.links = ([], []) if known is None else ([known], [known])
        met = self._first(members, sketches)
        direct = self._direct(met.filter("_few"))
        first = direct.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        hubs = self._hubs(met.filter(~F.col("_few"))) if self.wide_rows else None
        if hubs is not None:
            own = (F.col("at.node") != F.col("_hub.node")) & self.close(F.col("at"), F.col("_hub"))
            first = first.union(_pairs(hubs.filter(own), "at", "_hub")).distinct()
        self._try(first)
        linked = self.linked
        self._rest(direct)
        self.linked |= linked
        if hubs is None:
            return
        state = hubs.filter("_many").select("_bucket", "at", (F.col("at.node") == F.col("_hub.node")).alias("_used"))
        while True:
            rest = self._open(state)
            if rest is None:
                break
            if not self.linked or self.turn > ROUNDS or large is not None or self.open_pairs <= FEW * self.open_rows:
                self._finish(rest, large)
                break
            hub = (~F.col("_used")) & (F.col("label") != F.col("_label"))
            self._try(_pairs(rest.filter(hub & self.close(F.col("at"), F.col("_hub"))), "at", "_hub"))
            state = rest.select("_bucket", "at", (F.col("_used") | (F.col("at.node") == F.col("_hub.node"))).alias("_used"))

    def _first(self, members: DataFrame, sketches: DataFrame) -> DataFrame:
        """Members of buckets of two nodes or more, whether the bucket has few rows and whether it has more than two nodes.

        Most buckets hold one node and go in the first shuffle; what is left gets its sketches.
        """
        bucket, node = Window.partitionBy("_bucket"), F.col("at.node")
        met = members.withColumns({"_low": F.min(node).over(bucket), "_high": F.max(node).over(bucket), "_rows": F.count("*").over(bucket)})
        seen = Observation()
        met = met.filter(F.col("_low") != F.col("_high")).withColumn("_few", F.col("_rows") <= FEW)
        met = met.withColumn("_third", (node != F.col("_low")) & (node != F.col("_high"))).drop("_low", "_high", "_rows")
        met = self.store.put(met.observe(seen, F.count_if(~F.col("_few")).alias("wide")), "met")
        self.wide_rows = seen.get["wide"]
        full = met.hint("merge").join(sketches, node == sketches["node"])
        full = full.select("_bucket", F.col("at").withField("sketch", F.col("sketch")).alias("at"), "_few", "_third")
        out = self.store.put(full, "members")
        self.store.drop("met")
        return out

    def _direct(self, few: DataFrame) -> DataFrame:
        """Stored pairs ``a < b`` of nodes that share a bucket and may be similar."""
        few = few.select("_bucket", "at")
        x, y = F.col("x.at"), F.col("y.at")
        near = (F.col("x._bucket") == F.col("y._bucket")) & (x["node"] < y["node"]) & self.close(x, y)
        met = few.alias("x").hint("merge").join(few.alias("y"), near)
        return self.store.put(met.select(x["node"].alias("a"), y["node"].alias("b")).distinct(), "direct")

    def _hubs(self, wide: DataFrame) -> DataFrame:
        """Members of the larger buckets with the first hub of each and whether there are more than two nodes."""
        bucket = Window.partitionBy("_bucket")
        met = wide.withColumns({"_hub": F.min("at").over(bucket), "_many": F.max("_third").over(bucket)})
        return self.store.put(met.select("_bucket", "at", "_hub", "_many"), "hubs")

    def _rest(self, direct: DataFrame) -> None:
        """Try the stored pairs that lie in different components."""
        left = direct
        for earlier in self.tried:
            left = left.join(earlier, ["a", "b"], "left_anti")
        left = self.store.put(left, "direct-left")
        if left.isEmpty():
            return
        held = Store(direct.sparkSession, "llm-direct-components")
        labels = components(self.found(), held)
        for end in ("a", "b"):
            own = labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))
            left = left.join(own, end, "left")
        self._try(left.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"))
        held.drop()

    def _try(self, pairs: DataFrame) -> None:
        """Store pairs that have not been tried, and the links among them."""
        self.turn += 1
        for earlier in self.tried:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        pairs = self.store.put(pairs, f"pairs-{self.turn}")
        self.tried.append(pairs)
        found, self.linked = stored_links(self.store, str(self.turn), pairs, self.fetch, self.least)
        self.links.append(found)

    def found(self) -> DataFrame:
        """Stored links, the known ones among them."""
        first, *others = self.links
        for more in others:
            first = first.union(more)
        return first

    def _open(self, state: DataFrame) -> DataFrame | None:
        """Members of the buckets that still hold pairs of different components, each with its label and the next hub.

        The main component of a bucket is that of its first hub; the next hub is the first of the members outside.
        """
        held = Store(state.sparkSession, "llm-hub-components")
        labels = components(self.found(), held)
        state = state.withColumn("node", F.col("at.node")).hint("merge").join(labels, "node", "left")
        state = self.store.put(state.select("_bucket", "at", "_used", F.coalesce("label", "node").alias("label")), f"state-{self.turn}")
        held.drop()
        ends = state.groupBy("_bucket").agg(
            F.min_by("label", "at").alias("_main"), F.min("label").alias("_low"), F.max("label").alias("_high")
        )
        ends = ends.filter(F.col("_low") != F.col("_high")).select("_bucket", "_main")
        rows = state.hint("merge").join(ends, "_bucket")
        outside = (~F.col("_used")) & (F.col("label") != F.col("_main"))
        hubs = rows.groupBy("_bucket").agg(
            F.min(F.when(outside, F.col("at"))).alias("_hub"),
            F.min_by("label", F.when(outside, F.col("at"))).alias("_label"),
            F.first("_main").alias("_main"),
            F.count_if(outside).alias("_outside"),
            F.count_if(~F.col("_used")).alias("_left"),
        )
        hubs = hubs.filter((F.col("_outside") > 0) & (F.col("_left") > 1))
        sums = Observation()
        rest = state.hint("merge").join(hubs, "_bucket")
        pairs = F.sum(F.when(~F.col("_used"), F.col("_outside"))).alias("pairs")
        rest = self.store.put(rest.observe(sums, pairs, F.count_if(~F.col("_used")).alias("rows")), f"open-{self.turn}")
        self.open_pairs, self.open_rows = sums.get["pairs"], sums.get["rows"]
        if not self.open_rows:
            return None
        return rest

    def _finish(self, rest: DataFrame, large: int | None) -> None:
        """All pairs of members of different components, one of them outside the main component."""
        rest = rest.filter(~F.col("_used"))
        if large is not None:
            wide = F.col("_outside") * F.col("_left") > large
            seen = Observation()
            nodes = rest.filter(wide).select("at.node").distinct().observe(seen, F.count("*").alias("rows"))
            nodes = self.store.put(nodes, "large-nodes")
            self.large_nodes = nodes if seen.get["rows"] else None
            rest = rest.filter(~wide)
        out = rest.filter(F.col("label") != F.col("_main")).select("_bucket", F.col("at").alias("_out"), F.col("label").alias("_own"), "_main")
        other = rest.select("_bucket", "at", "label")
        once = (F.col("label") == F.col("_main")) | (F.col("at.node") > F.col("_out.node"))
        met = out.hint("merge").join(
            other, (out["_bucket"] == other["_bucket"]) & (F.col("label") != F.col("_own")) & once & self.close(F.col("_out"), F.col("at"))
        )
        self._try(_pairs(met, "_out", "at"))


def prefix_links(
    rows: DataFrame, fetch: Callable[[DataFrame], DataFrame], least: Least, known: DataFrame | None = None
) -> BucketLinks:
    """Links of all similar sets; ``rows`` are those of ``set_rows`` with the keys of ``prefix_keys``."""
    close = lambda x, y: close_places(x, y, least)
    return BucketLinks(prefix_members(rows), sketches_of(rows), fetch, close, least, known=known)


def prefix_keys(levels: np.ndarray, least: Least) -> Callable[[list[np.ndarray]], list[np.ndarray]]:
    """Bucket keys for ``set_rows``: the prefix of each set."""
    return lambda sets: [prefix(s, levels, least) for s in sets]


def links_within(sets: DataFrame, least: Least, known: DataFrame | None = None) -> DataFrame:
    """Links of all similar sets among stored ones (``node`` and ``_set``, each node once).

    With ``known`` links (stored, too) the result holds these and what connects further sets.
    """
    levels = rarity(sets)
    shared = sets.sparkSession.sparkContext.broadcast(levels)  # one MB

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                own = [_hashes(cell) for cell in part.column(1)]
                first = [prefix(s, shared.value, least) for s in own]
                ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first).view(np.int64)))
                columns = [part.column(0), pa.array([len(s) for s in own], pa.int64()), _sketches(own), keys]
                yield pa.RecordBatch.from_arrays(columns, names=["_print", "_size", "_sketch", "_keys"])

    rows = sets.select("node", "_set").mapInArrow(work, f"_print bigint, _size bigint, _sketch {SKETCH}, _keys array<bigint>")
    return prefix_links(rows, lambda nodes: sets.join(nodes, "node", "left_semi"), least, known).found()
