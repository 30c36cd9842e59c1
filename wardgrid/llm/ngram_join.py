"""N-gram Jaccard join over a count-vector R-tree.

A text's set is its distinct word shingles.  Texts with equal sets are one class.  Two classes link when
their Jaccard similarity is at least ``percent``.

Search space.  One R-tree over all documents can't be distributed: every coordinate of a count vector is
nearly the same for unrelated texts of one length, so a query box touches most leaves.  The space is
therefore first cut by exact sub-points: the hash range is divided into blocks, more of them than two
linked sets can differ in, so linked sets agree in the content of some blocks.
Their contents are join keys (one per three shingles or so); the classes that share keys, directly or
over others, form a family.  No link leaves a family.

Families are then cut by their count vectors: the shingles of a class are hashed into groups, one for every two to
four, and the group counts are a point.  Points of a family meet by bands of set size in which linked sets
are at most one band apart, and bands in pairs of leaves of bounded size, so that a family of any size is
spread over many tasks.  The points of a leaf are packed into boxes; the overlap of two boxes is bounded by the
summed coordinate minima of their upper corners, then that of two points likewise.  Pairs that survive
make smaller families, and only for these are exact sets sent and verified.  A point takes a 16th to a 32nd of
its set's bytes (more for fewer than 32 shingles).

Set sizes fall into classes with upper size u; a set publishes the keys of its own size class and of
those in which a larger partner may lie.  A set of n shingles and one of at most u differ in at most
d(n) = (n + u)(100 - percent) / (100 + percent) shingles.  Blocks are taken in groups of three, and a key is the
content of two blocks of a group: to spoil a group two of its blocks must differ, so of d(u) / 2 + 1 + d(u) / 12 groups
linked sets agree in a key of more than s = d(u) / 2 + d(u) / 12 - d(n) / 2 groups.  A set leaves out its smallest keys
(all those up to some size, empty ones first) as long as they lie in no more than s groups: of the s + 1 keys or more
that agree, one is then larger than what the set leaves out, and the largest is larger than what either leaves out.

Shingles are compared by 64-bit hashes.  Defined results: NULL or empty text has the empty set and links
with nothing; a text with fewer words than a shingle has one shingle; repeated rows and equal texts are in
one component; rows of one id with different texts are separate nodes; NULL ids are never a component's
name unless it has no other; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes
from wardgrid.llm.columns import null_safe, shielded
from wardgrid.llm.components import components
from wardgrid.session import forget_shuffles, staged, staging, staging_path

LEAF_SHINGLES = 1_000_000  # shingles of a family that one side of a task holds, about
LEAF_POINTS = 2_000_000  # the same where only points are held
NODE = 16  # points in a box
BOX = 64  # points in a box of a leaf of points alone
RATIO = 1.25  # between the upper sizes of neighbouring size classes


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, bounds in textbytes.blocks(texts):
        lowered = textbytes.LOWER[data]
        starts, ends, before = textbytes.spans(lowered, bounds)
        words = textbytes.hash_spans(lowered, starts, ends)
        grams = textbytes.gram_hash(words, size)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if b - a >= size:
                yield textbytes.distinct(grams[a : b - size + 1])
            else:
                yield textbytes.gram_hash(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def set_name(members: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = textbytes.mix(members ^ textbytes.GRAM[11]).sum(dtype=np.uint64) + np.uint64(len(members)) * textbytes.GRAM[12]
        return int(textbytes.mix(np.array([total], np.uint64)).view(np.int64)[0])


def size_class(n: int) -> tuple[int, int]:
    """Number and upper size of the size class of ``n``."""
    number, upper = 0, 1
    while upper < n:
        number, upper = number + 1, max(upper + 1, int(upper * RATIO))
    return number, upper


def block_keys(members: np.ndarray, percent: int) -> np.ndarray:
    """The keys a set publishes: names of what its blocks hold, for each size class a partner may fall into."""
    n = len(members)
    keys, at = [], n
    largest = n * 100 // percent
    mixed = textbytes.mix(members)
    while n and at <= largest:
        number, upper = size_class(at)
        differ = 2 * upper * (100 - percent) // (100 + percent)
        if differ:  # else only equal sets link
            groups = differ // 2 + 2 + differ // 12
            spare = groups - 1 - (n + upper) * (100 - percent) // (100 + percent) // 2
            place = (((members >> np.uint64(32)) * np.uint64(3 * groups)) >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            content, sizes = np.zeros(3 * groups, np.uint64), np.zeros(3 * groups, np.int64)
            with np.errstate(over="ignore"):
                content[place[first]] = np.add.reduceat(mixed, first)
                sizes[place[first]] = np.diff(np.append(first, n))
                one, two = content.reshape(-1, 3)[:, [0, 0, 1]], content.reshape(-1, 3)[:, [1, 2, 2]]
                held = sizes.reshape(-1, 3)[:, [0, 0, 1]] + sizes.reshape(-1, 3)[:, [1, 2, 2]]
                # All keys up to this size lie in ``spare`` groups at most, and linked sets agree in a key of more.
                small = int(np.sort(held.min(1))[spare]) - 1
                which = np.arange(3 * groups, dtype=np.uint64).reshape(-1, 3)
                names = one * textbytes.GRAM[15] + two * textbytes.GRAM[16] + which * textbytes.GRAM[13] + np.uint64(number) * textbytes.GRAM[14]
                keys.append(textbytes.mix(names[held > small]))
        at = upper + 1
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


SETS = "doc_id bigint, tkey bigint, n bigint, cls bigint, point binary"


def point_of(members: np.ndarray) -> np.ndarray:
    """The count vector of a set: a power of two of groups, at least one for every four members."""
    groups = 16
    while groups * 4 < len(members):
        groups *= 2
    return np.bincount((members & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def named_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, tkey, n, cls, point) of every row: a hash of the text, the size of the set, its name and its count vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(members), set_name(members), packed(point_of(members))) for members in shingle_sets(batch.column(2), size)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "tkey", "n", "cls", "point"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tkey"), "text").mapInArrow(run, SETS)


def classes_of(sets: DataFrame) -> DataFrame:
    """(cls, n, _first, first_doc): the classes, each with the row that names it, which has an id if any of its rows has one."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tkey"))
    found = sets.where("n > 0").groupBy("cls").agg(first.alias("_first"), F.first("n").alias("n"))
    return found.select("cls", "n", "_first", F.col("_first.doc_id").alias("first_doc"))


TASK_KEYS = 4_000_000  # keys that a task holds before it sends them on
SHARD_SHINGLES = 16_000_000  # shingles whose keys meet in one task, about


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, each no wider than the largest needs; the first byte is the width."""
    numbers = np.ascontiguousarray(numbers, "<u8")
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    return bytes([width]) + numbers.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    whole = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return whole.view("<u8").ravel()


def packed_sorted(numbers: np.ndarray) -> bytes:
    """Ascending numbers as the steps between them."""
    return packed(np.diff(numbers, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpacked(data), dtype=np.uint64)


SENT = "shard int, keys binary, names binary, places binary"


def stars(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys, the least name that has each, and (name, least name) of the others, distinct."""
    order = np.argsort(keys)
    keys, names = keys[order], names[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    least = np.minimum.reduceat(names, first) if len(first) else names
    centre = np.repeat(least, np.diff(np.append(first, len(keys))))
    pairs = np.stack([names, centre], 1)[names != centre]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(1))) if len(pairs) else np.zeros(0, bool)
    return keys[first], least, pairs[new]


def edges(docs: DataFrame, size: int, percent: int, shingles: int) -> DataFrame:
    """(a, b): links of classes to the least class that shares one of their keys.

    A task joins the classes it has seen itself and sends on one class per key, so a key that a third of
    all documents publish costs one entry per task.  Keys travel as sorted arrays per hash range; the number of
    ranges follows from the ``shingles`` of all classes, so what meets in one task stays the same.
    """
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shingles // SHARD_SHINGLES))

    def send(keys: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
        of = np.repeat(np.array(names, np.int64), [len(k) for k in keys])
        found, least, pairs = stars(np.concatenate(keys), of)
        cuts = np.searchsorted(((found >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32), np.arange(shards + 1))
        rows = []
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                known, place = np.unique(least[a:b], return_inverse=True)
                rows.append((shard, packed_sorted(found[a:b]), known.tobytes(), packed(place)))
        for at in range(0, len(pairs), 100_000):
            part = pairs[at : at + 100_000]
            rows.append((int(part[0, 0]) % shards, None, part[:, 0].tobytes(), part[:, 1].tobytes()))
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["shard", "keys", "names", "places"])

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets publish once in a task
        keys, names, held = [], [], 0
        for batch in batches:
            for members in shingle_sets(batch.column(0), size):
                name = set_name(members)
                if name not in seen:
                    seen.add(name)
                    keys.append(block_keys(members, percent))
                    names.append(name)
                    held += len(keys[-1])
            if held > TASK_KEYS:
                yield send(keys, names)
                keys, names, held, seen = [], [], 0, set()
        if held:
            yield send(keys, names)

    def pairs_of(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], ["a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:  # sorted by shard
            for number, keys, names, places in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                known = np.frombuffer(names, np.int64)
                if keys is None:
                    yield pairs_of(np.stack([known, np.frombuffer(places, np.int64)], 1))
                    continue
                if number != shard and parts:
                    yield pairs_of(stars(*map(np.concatenate, zip(*parts, strict=True)))[2])
                    parts = []
                shard = number
                parts.append((unpacked_sorted(keys), known[unpacked(places).astype(np.int64)]))
        if parts:
            yield pairs_of(stars(*map(np.concatenate, zip(*parts, strict=True)))[2])

    sent = docs.select("text").mapInArrow(publish, SENT).repartition(shards, "shard").sortWithinPartitions("shard")
    return sent.mapInArrow(meet, "a bigint, b bigint")


def families(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(cls, family) of the classes that share a key with another."""
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    return components(edges(docs, size, percent, shingles)).select(F.col("node").alias("cls"), F.col("root").alias("family"))


def banded_leaves(located: DataFrame, bound: int, always: bool) -> DataFrame:
    """``located`` (cls, family, n and others) once for each size band it belongs to, with the leaves of the band and its own leaf.

    A family of more than ``bound`` shingles (every family if ``always``) is cut into bands of set size in which
    linked sets are at most one band apart; a class goes to its own and to the next band.  A band that is still
    larger is cut into leaves.  Bands of one class are left out.
    """
    own = F.floor(F.log(F.col("n").cast("double")) / F.col("_step")).cast("int")
    if always:
        bands, whole = F.array(own, own + 1), located
    else:
        whole = located.join(located.groupBy("family").agg(F.sum("n").alias("_total")), "family")
        bands = F.when(F.col("_total") <= bound, F.array(F.lit(-1))).otherwise(F.array(own, own + 1))
    banded = whole.withColumn("band", F.explode(bands)).drop("_total", "_step")
    leaves = banded.groupBy("family", "band").agg(F.ceil(F.sum("n") / bound).cast("int").alias("leaves"), F.count("*").alias("_classes"))
    leaf = F.pmod(F.xxhash64("cls"), F.col("leaves")).cast("int")
    return banded.join(leaves.where("_classes > 1").drop("_classes"), ["family", "band"]).withColumn("leaf", leaf)


def with_partners(placed: DataFrame, *carried: str) -> DataFrame:
    """Each class once for every pair of leaves that it belongs to; every such pair is a task of bounded size."""
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("leaves") - 1)))
    return other.select("family", "band", F.least("leaf", "other").alias("left"), F.greatest("leaf", "other").alias("right"), "leaf", "cls", *carried)


def step_of(percent: int) -> float:
    """The width of a band of set size, as a logarithm."""
    return math.log(100 / percent) * (1 + 1e-9)


PAIR_KEYS = ["family", "band", "left", "right"]


def finer(sets: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """(cls, family) of the classes whose count vectors let them link with another class of their family."""
    one = sets.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    located = one.join(family, "cls").withColumn("_step", F.lit(step_of(percent)))
    placed = with_partners(banded_leaves(located, LEAF_POINTS, True), "n", "point")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result() -> pa.RecordBatch:
            rows = sorted(held.values(), key=lambda h: h[0])
            found = close_points([r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows], np.int64), [r[3] for r in rows], percent)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        at, held = None, {}
        for batch in batches:  # sorted by family and leaves
            for *key, leaf, name, n, point in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != at:
                    if len(held) > 1:
                        yield result()
                    at, held = key, {}
                held[name] = (name, leaf, n, point)
        if len(held) > 1:
            yield result()

    found = placed.repartition(*PAIR_KEYS).sortWithinPartitions(*PAIR_KEYS).mapInArrow(run, "a bigint, b bigint")
    return components(found).select(F.col("node").alias("cls"), F.col("root").alias("family"))


class Leaf:
    """Points of a leaf, packed into boxes.

    A point is held as marks, one for each unit that a coordinate counts (count > 0, count > 1, ...).  The summed minima
    of two points are then the marks they share: one matrix product for many pairs, exact in single precision.
    """

    def __init__(self, names: np.ndarray, sizes: np.ndarray, counts: np.ndarray, levels: int):
        spread = np.argsort(-counts.var(0))[:3]
        order = np.lexsort((*[counts[:, c] for c in spread[::-1]], sizes // 8))
        self.names, self.sizes = names[order], sizes[order]
        self.marks = (counts[order][:, :, None] > np.arange(levels)).reshape(len(order), -1).astype(np.float32)
        self.first = np.arange(0, len(order), BOX)
        self.upper = np.maximum.reduceat(self.marks, self.first, axis=0)
        self.least = np.minimum.reduceat(self.sizes, self.first)

    def near(self, other: Leaf, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (own, other) of pairs whose bounded overlap may suffice, box by box."""
        bound = self.upper @ other.upper.T
        fits = (100 + percent) * bound >= percent * (self.least[:, None] + other.least[None])
        for box, start in enumerate(self.first.tolist()):
            there = np.flatnonzero(fits[box])
            if len(there):
                # Boxes lie in order of size, so those that fit are near one another.
                own, near = slice(start, start + BOX), slice(int(other.first[there[0]]), int(other.first[there[-1]]) + BOX)
                overlap = self.marks[own] @ other.marks[near].T
                i, j = np.nonzero((100 + percent) * overlap >= percent * (self.sizes[own, None] + other.sizes[None, near]))
                yield i + start, j + near.start


def close_points(names: list[int], leaves: np.ndarray, sizes: np.ndarray, points: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs of classes whose points may link, as far as they connect classes that the pairs before don't; of two leaves, pairs between them."""
    counts = [unpacked(p).astype(np.int64) for p in points]
    groups = min(map(len, counts))
    counts = np.stack([c.reshape(-1, groups).sum(0) for c in counts])
    levels = int(counts.max())
    sides = [np.flatnonzero(leaves == side) for side in np.unique(leaves)]
    if len(sides) == 1:
        sides = sides * 2
    held = [Leaf(side, sizes[side], counts[side], levels) for side in sides]
    group, out = np.arange(len(names)), []
    for i, j in held[0].near(held[1], percent):
        a, b = held[0].names[i], held[1].names[j]
        while len(a):
            new = group[a] != group[b]
            a, b = a[new], b[new]
            # One pair for every class on the left at a time; those that joined others fall out.
            _, take = np.unique(group[a], return_index=True)
            for k in take.tolist():
                if group[a[k]] != group[b[k]]:
                    out.append((names[a[k]], names[b[k]]))
                    group[group == group[a[k]]] = group[b[k]]
    return out


def leaf_pairs(docs: DataFrame, classes: DataFrame, family: DataFrame, size: int, percent: int) -> DataFrame:
    """Each class with its exact set, once for every pair of leaves that it belongs to."""
    located = classes.join(family, "cls").select("cls", "family", "_first", "n").withColumn("_step", F.lit(step_of(percent)))
    banded = banded_leaves(located, LEAF_SHINGLES, False)
    place = F.struct("band", "leaves", "leaf")
    wanted = staged(
        banded.groupBy("cls", "family", "_first").agg(F.collect_list(place).alias("places")),
        "wanted",
    ).hint("merge")  # grows with the documents: one plan at every size
    # Only the row that names a class carries its text on: by id and text, so that rows with a missing or repeated id don't multiply.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
    texts = keyed.join(wanted, null_safe([F.col("doc_id"), F.col("tkey")], [F.col("_first.doc_id"), F.col("_first.tkey")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, name, *rest = batch.columns
            keep, members = [], []
            for k, (found, wanted_name) in enumerate(zip(shingle_sets(text, size), name.to_pylist(), strict=True)):
                if set_name(found) == wanted_name:
                    keep.append(k)
                    members.append(found.tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([name.take(at), *[c.take(at) for c in rest], pa.array(members, pa.binary())], ["cls", "family", "places", "members"])

    places = "array<struct<band: int, leaves: int, leaf: int>>"
    found = texts.select("text", "cls", "family", "places").mapInArrow(run, f"cls bigint, family bigint, places {places}, members binary")
    return with_partners(found.select("cls", "family", "members", F.inline("places")), "members")


class Points:
    """Count vectors of sets, packed into boxes of neighbouring points."""

    def __init__(self, sets: list[np.ndarray], groups: int):
        counts = np.zeros((len(sets), groups), np.int32)
        for k, members in enumerate(sets):
            counts[k] = np.bincount((members & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        sizes = np.array([len(s) for s in sets], np.int64)
        # Sort by size, then tile by the coordinates that spread most.
        spread = np.argsort(-counts.var(0))[:3]
        order = np.lexsort((*[counts[:, c] for c in spread[::-1]], sizes // 8))
        self.order, self.counts, self.sizes = order, counts[order], sizes[order]
        first = np.arange(0, len(order), NODE)
        self.first, self.upper = first, np.maximum.reduceat(self.counts, first, axis=0)
        self.least = np.minimum.reduceat(self.sizes, first)
        self.most = np.maximum.reduceat(self.sizes, first)

    def candidates(self, other: Points, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs (own, other) whose bounded overlap may suffice; of points against themselves each pair once."""
        same = self is other
        for node, at in enumerate(self.first.tolist()):
            fits = np.flatnonzero((other.most * 100 >= self.least[node] * percent) & (self.most[node] * 100 >= other.least * percent))
            fits = fits[fits >= node] if same else fits
            bound = np.minimum(self.upper[node], other.upper[fits]).sum(1)
            need = percent * (self.least[node] + other.least[fits])
            for there in fits[(100 + percent) * bound >= need].tolist():
                a, b = slice(at, at + NODE), slice(other.first[there], other.first[there] + NODE)
                overlap = np.minimum(self.counts[a, None], other.counts[None, b]).sum(2)
                good = (100 + percent) * overlap >= percent * (self.sizes[a, None] + other.sizes[None, b])
                for i, j in zip(*np.nonzero(good), strict=True):
                    one, two = at + int(i), int(b.start) + int(j)
                    if not same or one < two:
                        yield int(self.order[one]), int(other.order[two])


class Forest:
    """Which of a task's classes are known to be connected."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def links_between(names: list[int], leaves: list[int], sets: list[np.ndarray], left: int, right: int, percent: int, spanning: bool) -> list[tuple[int, int]]:
    """Links among the classes of a leaf, or between those of two leaves."""
    groups = 16
    while groups < 1024 and groups * 8 < max(map(len, sets)):
        groups *= 2
    sides = [[k for k, leaf in enumerate(leaves) if leaf == side] for side in dict.fromkeys((left, right))]
    if not all(sides):
        return []
    points = [Points([sets[k] for k in side], groups) for side in sides]
    forest, out = Forest(), []
    for i, j in points[0].candidates(points[-1], percent):
        a, b = sides[0][i], sides[-1][j]
        one, two = forest.root(a), forest.root(b)
        if (one != two or not spanning) and linked(sets[a], sets[b], percent):
            forest.parent[one] = two
            out.append((names[a], names[b]))
    return out


def links(parts: DataFrame, percent: int, spanning: bool = True) -> DataFrame:
    """(a, b): links between classes.  ``spanning`` leaves out links between classes already connected in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result() -> pa.RecordBatch:
            names, leaves, sets = zip(*sorted(held.values(), key=lambda h: h[0]), strict=True)
            found = links_between(names, leaves, sets, at[2], at[3], percent, spanning)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        at, held = None, {}
        for batch in batches:  # sorted by family and leaves
            for family, band, left, right, leaf, name, members in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (family, band, left, right) != at:
                    if held:
                        yield result()
                    at, held = (family, band, left, right), {}
                held[name] = (name, leaf, np.frombuffer(members, np.uint64))
        if held:
            yield result()

    return parts.repartition(*PAIR_KEYS).sortWithinPartitions(*PAIR_KEYS).mapInArrow(run, "a bigint, b bigint")


def _write_names(docs: DataFrame, sets: DataFrame, size: int, percent: int, path: str):
    """Write each class with its root and the name of its component; the schema."""
    spark = docs.sparkSession
    classes = classes_of(sets)
    family = staged(families(docs, classes, size, percent), "families")
    forget_shuffles(spark)
    family = staged(finer(sets, family, percent), "finer")
    forget_shuffles(spark)
    found = staged(links(leaf_pairs(docs, classes, family, size, percent), percent), "links")
    forget_shuffles(spark)
    roots = staged(components(found), "roots").withColumnRenamed("node", "cls")
    named = classes.join(roots, "cls").select("root", "cls", "first_doc")
    least = named.groupBy("root").agg(F.min("first_doc").alias("least"))
    of_class = classes.select("cls", "first_doc").join(named.join(least, "root").select("cls", "root", "least"), "cls", "left")
    names = of_class.select(F.col("cls").alias("_cls"), F.coalesce("root", "cls").alias("root"), F.coalesce("least", "first_doc").alias("component_id"))
    names.write.parquet(path)
    return names.schema


def join_documents(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, text_key, n_shingles, class_id, root, component_id) of every row; component_id is the least doc_id reachable by links."""
    spark = docs.sparkSession
    sets = staged(named_sets(docs, size), "sets")
    path = staging_path(spark, "names")
    with staging(spark):  # what the steps write goes once the names are written
        schema = _write_names(docs, sets, size, percent, path)
    forget_shuffles(spark)
    names = spark.read.schema(schema).parquet(path)
    return (
        sets.select("doc_id", F.col("tkey").alias("text_key"), F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"))
        .join(names, (F.col("class_id") == F.col("_cls")) & (F.col("n_shingles") > 0), "left")
        .select("doc_id", "text_key", "n_shingles", "class_id", "root", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def link_classes(docs: DataFrame, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Every link, not only those that connect: (class_a, class_b) with a < b, and the (doc_id, text_key, n_shingles, class_id) of every row.

    Rows of one class have equal sets, so they are linked among themselves and with all rows of a linked class.
    """
    sets = staged(named_sets(docs, size), "sets")
    classes = classes_of(sets)
    family = staged(finer(sets, staged(families(docs, classes, size, percent), "families"), percent), "finer")
    found = links(leaf_pairs(docs, classes, family, size, percent), percent, spanning=False)
    # A pair may meet in several bands.
    pairs = staged(found.select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b")).distinct(), "links")
    return pairs, sets.select("doc_id", F.col("tkey").alias("text_key"), F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least id stays.

    Rows without shingles all stay.  Of rows with that id the one with the least text hash stays, once.
    """
    joined = staged(join_documents(docs, size, percent).where("n_shingles > 0"), "joined")
    first = joined.where("doc_id <=> component_id").groupBy("root").agg(F.min("text_key").alias("_first"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("_first"))
    each = joined.join(first, "root").groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).agg(F.max(stays).alias("_stays"), F.count("*").alias("_rows"))
    drop = staged(each.where("not _stays or _rows > 1"), "dropped")
    plain, restored = shielded(docs, ("doc_id", "text"))
    key = [F.col("doc_id").cast("long"), F.xxhash64("text")]
    kept = plain.join(drop.select("_d", "_t").hint("merge"), null_safe(key, [F.col("_d"), F.col("_t")]), "left_anti")
    stay = drop.where("_stays").select("_d", "_t")
    if stay.isEmpty():
        return restored(kept)
    # Rows that occur several times and stay: one of each.
    again = plain.join(stay.hint("merge"), null_safe(key, [F.col("_d"), F.col("_t")]), "left_semi")
    return restored(kept.unionByName(again.dropDuplicates(["doc_id", "text"])))
