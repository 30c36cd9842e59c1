"""Line dedup by winnowing: later repeats of line runs of at least ``min_words`` words are deleted.

A text is its sequence of lines that have a word.  A window is a shortest run of lines from some line on
(or back from some line) with ``min_words`` words, so a line lies in a repeated run of at least that many
words exactly if it lies in a repeated window.  Each line also starts a gram, the shortest run with half
as many words; the least gram hash inside a window (rightmost of equals) is the window's fingerprint.
Equal runs choose equal fingerprints, so a run that repeats shares one with its first occurrence.

Fingerprints that occur at two places or more are joined with the positions of their windows; matches
extend both ways over all windows around a fingerprint, compared by 128-bit hashes of their lines.
The first occurrence by (doc_id, hash of the text) and position keeps its lines; a repeat in the same text counts
only where it doesn't overlap the first.  Everything is a grouping by hash, so a passage that a third of
all documents share is added up before the shuffle and never expanded into pairs.

Defined results: NULL text stays NULL, empty text empty; lines without a word are never compared, and go
only between two deleted lines; rows equal in id and text are one document and treated alike; texts under
``min_words`` words are unchanged; NULL ids compare as equal and come first; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wardgrid.llm import textbytes
from wardgrid.llm.columns import null_safe, shielded
from wardgrid.session import forget_shuffles, staged, staging, staging_path

MIN_WORDS = 50
BASES = (np.uint64(0x9E3779B97F4A7C55), np.uint64(0xD1342543DE82EF95))

WINDOWS = "fp bigint, at int, w1 bigint, w2 bigint, doc_id bigint, tkey bigint, first int, last int"


def lines_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the lines that have a word: two hashes, words, number of the line in its text, and the text."""
    feeds = np.flatnonzero(data == 10)
    starts = textbytes.distinct(np.concatenate([bounds[:-1], feeds + 1]))
    starts = starts[starts < len(data)]
    ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
    ends = ends - (data[ends - 1] == 10) if len(starts) else ends
    text = np.searchsorted(bounds, starts, side="right") - 1
    words, _, _ = textbytes.spans(data, bounds)
    per_line = np.diff(np.searchsorted(words, np.append(starts, len(data)))) if len(starts) else starts
    number = np.arange(len(starts)) - np.searchsorted(starts, bounds[text]) if len(starts) else starts
    used = per_line > 0
    starts, ends = starts[used], ends[used]
    one, two = (textbytes.hash_spans(data, starts, ends, near) for near in (textbytes.NEAR, textbytes.OTHER))
    return one, two, per_line[used], number[used], text[used]


def run_hashes(lines: np.ndarray, first: np.ndarray, last: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of the runs of lines ``first..last``."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(lines), base, np.uint64)]))
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(lines), inverse, np.uint64)]))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(lines * powers[:-1])])
        return textbytes.mix((prefix[last + 1] - prefix[first]) * back[first] + (last - first + 1).astype(np.uint64) * base)


def windows_of(one: np.ndarray, two: np.ndarray, words: np.ndarray, text: np.ndarray, texts: int, min_words: int) -> tuple[np.ndarray, ...]:
    """Windows as (first, last, fingerprint, its place, two hashes), all lines of a block at once."""
    total = np.concatenate([[0], np.cumsum(words)])
    cuts = np.searchsorted(text, np.arange(texts + 1))
    begin, end = cuts[text], cuts[text + 1]
    line = np.arange(len(words))

    def shortest(least: int) -> np.ndarray:
        return np.searchsorted(total, total[line] + least) - 1

    gram_end = shortest(max(1, min_words // 2))
    gram = run_hashes(one, line, np.minimum(gram_end, len(line) - 1), BASES[0])
    ahead = shortest(min_words)
    forward = ahead < end
    behind = np.searchsorted(total, total[line + 1] - min_words, side="right") - 1
    backward = (behind >= begin) & (total[line + 1] >= min_words)
    both = np.unique(np.concatenate([np.stack([line[forward], ahead[forward]], 1), np.stack([behind[backward], line[backward]], 1)]), axis=0)
    first, last = both[:, 0], both[:, 1]
    if not len(first):
        none = np.zeros(0, np.uint64)
        return first, last, none, first, none, none
    # Grams inside a window are those from its first line to the last whose end is inside.
    stop = np.searchsorted(gram_end, last, side="right")
    _, rank = np.unique(gram, return_inverse=True)
    order = np.append(rank.astype(np.int64) << 32 | (len(line) - line), np.int64(2**62))
    least = np.minimum.reduceat(order, np.stack([first, stop], 1).ravel())[::2]
    place = len(line) - (least & (2**32 - 1))
    return first, last, gram[place], place, run_hashes(one, first, last, BASES[0]), run_hashes(two, first, last, BASES[1])


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per window: fingerprint and its line, hashes, document, first and last line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for row, end, data, bounds in textbytes.blocks(batch.column(2)):
                one, two, words, number, text = lines_of(data, bounds)
                if not len(words):
                    continue
                first, last, fp, place, w1, w2 = windows_of(one, two, words, text, end - row, min_words)
                of = pa.array(row + text[first])
                columns = [fp.view(np.int64), number[place].astype(np.int32), w1.view(np.int64), w2.view(np.int64)]
                lines = [number[first].astype(np.int32), number[last].astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), ids.take(of), keys.take(of), *map(pa.array, lines)], [f.split()[0] for f in WINDOWS.split(", ")]
                )

    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tkey"), "text")
    return given.mapInArrow(run, WINDOWS)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tkey, first, last) of the windows that repeat an earlier one."""
    found = staged(windows(docs, min_words), "windows")
    places = found.select("fp", "doc_id", "tkey", "at").distinct()
    twice = places.groupBy("fp").agg(F.count("*").alias("_n")).where("_n > 1").select("fp")
    matched = found.join(twice, "fp").select("w1", "w2", "doc_id", "tkey", "first", "last")
    origin = matched.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "tkey", "first", "last")).alias("_o"), F.count("*").alias("_n")).where("_n > 1")
    own = F.col("doc_id").eqNullSafe(F.col("_o.doc_id")) & (F.col("tkey") == F.col("_o.tkey"))
    return (
        matched.join(origin.drop("_n"), ["w1", "w2"])
        .where(~own | (F.col("first") > F.col("_o.last")))
        .select("doc_id", "tkey", "first", "last")
    )


def cuts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tkey, _firsts, _lasts): the distinct windows to cut, so that a group is bounded by its text however often it is repeated."""
    runs = repeats(docs, min_words).groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("first", "last")).alias("_runs"))
    return runs.select("doc_id", "tkey", F.col("_runs.first").alias("_firsts"), F.col("_runs.last").alias("_lasts"))


@F.pandas_udf(StructType([StructField("text", StringType()), StructField("removed", LongType())]))
def _without(text: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
    out, removed = [], []
    for value, first, last in zip(text, firsts, lasts, strict=True):
        if first is None or value is None:
            out.append(value)
            removed.append(0)
            continue
        lines = value.split("\n")
        edges = np.zeros(len(lines) + 1, np.int64)
        np.add.at(edges, np.asarray(first, np.int64), 1)
        np.add.at(edges, np.asarray(last, np.int64) + 1, -1)
        gone = np.cumsum(edges)[:-1] > 0
        out.append("\n".join(line for line, drop in zip(lines, gone.tolist(), strict=True) if not drop))
        removed.append(int(gone.sum()))
    return pd.DataFrame({"text": out, "removed": removed})


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, removed: str | None = None) -> DataFrame:
    """``docs`` with the repeats cut out of ``text``; ``removed`` names a column for the lines cut per row, in place of an own column of that name."""
    spark = docs.sparkSession
    path = staging_path(spark, "cuts")
    with staging(spark):  # the windows go once the cuts are written
        runs = cuts(docs, min_words)
        runs.write.parquet(path)
        schema = runs.schema
        del runs
    forget_shuffles(spark)
    # The cuts grow with the documents, so both sides are shuffled whatever their size: one plan at every size.
    cut = spark.read.schema(schema).parquet(path).withColumnsRenamed({"doc_id": "_d", "tkey": "_t"}).hint("merge")
    plain, restored = shielded(docs, ("doc_id", "text"))
    keyed = plain.withColumn("_key", F.xxhash64("text"))
    joined = keyed.join(cut, null_safe([F.col("doc_id").cast("long"), F.col("_key")], [F.col("_d"), F.col("_t")]), "left")
    done = joined.withColumn("_new", _without("text", "_firsts", "_lasts")).withColumn("text", F.col("_new.text"))
    if removed is None:
        return restored(done)
    own = [F.col(f"`{o}`").alias(c) for o, c in zip(plain.columns, docs.columns, strict=True) if c != removed]
    return done.select(*own, F.col("_new.removed").alias(removed))
