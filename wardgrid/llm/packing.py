"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths.

Texts are tokenised and cut into pieces of at most ``capacity`` tokens.  Only the counts per length (at
most ``capacity`` rows) reach the driver; best fit decreasing runs over these counts and gives, for each
length, ranges of ranks with their sequences and offsets.  Pieces then take their slot by their rank
among the pieces of their length.  A rank is the row number inside a hashed cell of the length plus the
rows of the cells before it, so no length, however common, is ranked in one task, equal rows included.

Defined results: NULL or empty text is one piece that holds the end token alone; repeated rows are packed
as often as they occur; an empty table gives an empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm import textbytes
from wardgrid.session import staged

CAPACITY = 4096
END_ID = 1
CELL_ROWS = 1024  # pieces of a length that are ranked together, about
CACHE_WORDS = 400_000  # words a task remembers the ids of
BATCH_WORDS = 2_000  # words the tokenizer encodes at once; what it returns for a word takes about a kilobyte

LETTER, SIGN = np.zeros(256, bool), np.zeros(256, bool)
LETTER[97:123] = True
SIGN[list(b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~")] = True

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def word_tokenizer(path: str):
    """Words -> bytes of their token ids, for a vocabulary whose tokens never span white space; and its added tokens, lower case."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    added = sorted({t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()})
    if any(set(t) & set(textbytes.SPACE_BYTES) for t in added):
        raise ValueError("an added token of the vocabulary holds white space")

    def ids_of(words: list[str]) -> Iterator[bytes]:
        for at in range(0, len(words), BATCH_WORDS):
            for found in encode(words[at : at + BATCH_WORDS], add_special_tokens=False):
                yield np.array(found.ids, np.uint32).tobytes()

    return ids_of, added


def lowered(data: np.ndarray, bounds: np.ndarray, added: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``data`` in lower case where that leaves the ids as they are, and the borders inside what reads like an added token.

    The tokenizer finds added tokens in the raw text, and composes a letter with the marks after it before it
    lowers it.  So letters of an added token, in whatever case, and letters before a byte beyond ASCII stay as they are.
    """
    lower = textbytes.LOWER[data]
    keep, inside = np.zeros(len(data), bool), np.zeros(len(data) + 1, bool)
    keep[:-1] = data[1:] > 127
    raw = lower.tobytes()
    for token in added:
        at = raw.find(token)
        while at >= 0:
            keep[at : at + len(token)] = True
            inside[at + 1 : at + len(token)] = True
            at = raw.find(token, at + 1)
    inside[bounds] = False
    return np.where(keep, data, lower), inside


def units(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cut where an ASCII letter meets a sign: no token spans that border, and far fewer units are distinct.

    ``inside`` marks borders that stay whole.
    """
    starts, ends, before = textbytes.spans(data, bounds)
    cuts = np.flatnonzero(LETTER[data[:-1]] & SIGN[data[1:]]) + 1
    border = inside.copy()
    border[bounds] = True
    cuts = cuts[~border[cuts]]
    starts, ends = (np.sort(np.concatenate([x, cuts]), kind="stable") for x in (starts, ends))
    return starts, ends, np.searchsorted(starts, bounds)


def token_ids(texts: pa.Array, encode, added: list[bytes], cache: dict[bytes, bytes]) -> Iterator[np.ndarray]:
    """Ids of each text.  Every distinct word of a block is looked up once and encoded once per task."""
    for _, _, data, bounds in textbytes.blocks(texts):
        data, inside = lowered(data, bounds, added)  # the vocabulary is lower case
        starts, ends, words_before = units(data, bounds, inside)
        _, example, which = np.unique(textbytes.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        distinct = [raw[s:e] for s, e in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = [w for w in distinct if w not in cache]
        for w, ids in zip(new, encode([w.decode("utf-8") for w in new]), strict=True):
            cache[w] = ids
        found = [cache[w] for w in distinct]
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        flat = np.frombuffer(b"".join(found), np.uint32)
        first = np.cumsum(sizes) - sizes
        lengths = sizes[which] if len(which) else np.zeros(0, np.int64)
        before = np.concatenate(([0], np.cumsum(lengths)))
        ids = flat[np.arange(before[-1]) + np.repeat(first[which] - before[:-1], lengths)] if len(which) else flat
        cuts = before[words_before]
        for k in range(len(bounds) - 1):
            yield ids[cuts[k] : cuts[k + 1]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (encode, added), cache = word_tokenizer(tokenizer), {}
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), encode, added, cache), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (doc, piece, start, len(part), zlib.crc32(part.tobytes()))
                    for column, value in zip(rows, (*row, part) if with_ids else row, strict=False):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(v, t) for v, t in zip(rows, types, strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in rows[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over counts: (length, first rank, pieces, first sequence, offset) of each slot range.

    A group is a range of sequences with equal content.  Each length takes the groups with the least room
    that fits, as many pieces per sequence as go in, and opens new sequences when nothing fits.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, sequences)
    opened = 0

    def fill(length: int, rank: int, room: int, first: int, size: int, each: int) -> int:
        """Put ``each`` pieces into every one of ``size`` sequences; the next rank."""
        for k in range(each):
            slots.append((length, rank, size, first, capacity - room + k * length))
            rank += size
        groups[room - each * length].append((first, size))
        return rank

    for length in sorted(counts, reverse=True):
        left, rank, room = counts[length], 0, length
        while left:
            while room <= capacity and not groups[room]:
                room += 1
            most = min(room, capacity) // length
            if room > capacity:
                first, size = opened, -(-left // most)
                opened += size
                room_now = capacity
            else:
                first, size = groups[room].pop()
                room_now = room
            full = min(size, left // most)
            if full:
                rank = fill(length, rank, room_now, first, full, most)
                left -= full * most
                first, size = first + full, size - full
            if size and left and left < most:
                rank = fill(length, rank, room_now, first, 1, left)
                left, first, size = 0, first + 1, size - 1
            if size:
                groups[room_now].append((first, size))
    return slots


def assign(cut: DataFrame, capacity: int = CAPACITY, place: str | None = None) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.  ``cut`` is read three times, so it should be a written table.

    ``place`` names a column that differs between all rows; it is left out of the result.  Without it equal
    rows share one cell, and all of them are ranked in one task.
    """
    spark = cut.sparkSession
    row = ["doc_id", "piece", "ids_crc32", *([place] if place else [])]
    own = [c for c in cut.columns if c != place]
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    slots = plan(counts, capacity)
    if not slots:
        return cut.select(*own, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # Both tables are bounded by the capacity, not by the documents: a length opens or closes few groups.
    table = spark.createDataFrame(slots, "length bigint, rank bigint, n bigint, sequence bigint, at bigint")
    per_length = table.groupBy("length").agg(
        F.sum("n").alias("_total"), F.sort_array(F.collect_list(F.struct("rank", "n", "sequence", "at"))).alias("_slots")
    )
    cells = F.ceil(F.col("_total") / CELL_ROWS)
    placed = cut.join(F.broadcast(per_length.select("length", cells.alias("_cells"))), "length").withColumn(
        "_cell", F.pmod(F.xxhash64(*row), F.col("_cells"))
    )
    order = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("length", "_cell").agg(F.count("*").alias("_n")).select(
        "length", "_cell", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_cell").orderBy(*row)
    ranked = placed.withColumn("_row", F.row_number().over(inside) - 1).join(before, ["length", "_cell"])
    found = (
        ranked.join(F.broadcast(per_length.select("length", "_slots")), "length")
        .withColumn("_rank", F.col("_before") + F.col("_row"))
        .withColumn("_slot", F.filter("_slots", lambda s: (s["rank"] <= F.col("_rank")) & (F.col("_rank") < s["rank"] + s["n"]))[0])
    )
    return found.select(
        *own,
        (F.col("_slot.sequence") + F.col("_rank") - F.col("_slot.rank")).alias("sequence_id"),
        F.col("_slot.at").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` with their sequence and offset; ``with_ids`` adds the token ids."""
    cut = pieces(docs, tokenizer, capacity, end_id, with_ids).withColumn("_place", F.monotonically_increasing_id())
    return assign(staged(cut, "pieces"), capacity, "_place")  # written, so a row keeps its place


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences, from ``pack(..., with_ids=True)``; each is at most a capacity long."""
    ordered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("_p"))
    return ordered.select(
        "sequence_id",
        F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"),
        F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"),
    )
