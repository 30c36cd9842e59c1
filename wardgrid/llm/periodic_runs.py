"""Periodic runs of words: every maximal stretch that repeats with its smallest period, found as a maximal pair.

Per text, the suffixes of words are sorted by prefix doubling and their LCP-interval tree is built bottom-up.  A
maximal pair is two places whose words agree for exactly ``l`` words: they differ in the word to the right
(so they meet first in the interval of length ``l``, in different children) and in the word to the left (they
are of different left-word classes).  A pair at distance ``d <= l`` is a stretch of ``d + l`` words with period
``d`` that no neighbour extends, so it is a run as it stands and nothing is extended; of pairs with one stretch
the least distance is its period.

Pairs within reach are few: if two places agree for exactly ``l`` words at distance ``d <= l``, no place of
that interval lies between them (three such places would share a period that the break after ``l`` words
denies).  So only neighbours in the ordered places of an interval are looked at.  The places of the whole
tree form one linked list; going down the tree in the reverse of the order it was built, all children but the
largest are taken out of it, so every place moves at most log n times.

Texts are handled where they lie, in blocks of bounded size (a longer text is a block of its own), without a
shuffle.  A run of ``MIN_WORDS`` words repeats at least half of them, so texts in which no gram of that half
occurs twice are not sorted at all.

Defined results: NULL and empty texts have no words and no runs, and collapse to the empty text; ties for the
longest run go to the smallest start, then period; repeated rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes

MIN_WORDS = 12

RUNS = "array<struct<start:int,length:int,period:int>>"


def suffix_levels(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes, and for every power of two the rank of the run of that many symbols from each place.

    ``symbols`` may be any numbers; runs of different texts and runs that end with their text are all different.
    A rank is the place of its group in the sorted order; only groups of several places are refined further.
    """
    n = len(symbols)
    end = np.searchsorted(text, text, side="right")
    order = np.lexsort((symbols, text))
    new = np.ones(n, bool)
    new[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, size = [rank], 1
    alone = new & np.append(new[1:], True)
    active = order[~alone]  # in sorted order, whole groups
    while len(active):
        rank = levels[-1]
        ahead = active + size
        second = np.where(ahead < end[active], rank[np.minimum(ahead, n - 1)].astype(np.int64), -1)
        own = rank[active].astype(np.int64)
        sort = np.argsort(own * (n + 1) + second + 1, kind="stable")
        active, own, second = active[sort], own[sort], second[sort]
        first = np.ones(len(active), bool)
        first[1:] = own[1:] != own[:-1]
        new = first.copy()
        new[1:] |= second[1:] != second[:-1]
        at = np.arange(len(active))
        place = own + at - at[first][np.cumsum(first) - 1]  # where the sorted place of each member is
        order[place] = active
        rank = rank.copy()
        rank[active] = place[new][np.cumsum(new) - 1]
        levels.append(rank)
        size *= 2
        active = active[~(new & np.append(new[1:], True))]
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """How many symbols each sorted suffix shares with the one before it (0 for the first)."""
    n = len(order)
    one, two = order[1:].copy(), order[:-1].copy()
    shared = np.zeros(n, np.int64)
    stop_one, stop_two = end[one], end[two]
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        same = (one < stop_one) & (two < stop_two)
        same &= rank[np.minimum(one, n - 1)] == rank[np.minimum(two, n - 1)]
        step = same.astype(np.int64) << k
        shared[1:] += step
        one += step
        two += step
    return shared


def intervals(shared: list[int], low: int, high: int) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
    """The LCP-interval tree over sorted places ``low..high``, bottom-up: (length, first, last, inner children)."""
    done: list[tuple[int, int, int, list[tuple[int, int]]]] = []
    stack: list[tuple[int, int, list[tuple[int, int]]]] = [(0, low, [])]
    for at in range(low + 1, high + 2):
        length = shared[at] if at <= high else 0
        first, last_child = at - 1, None
        while stack[-1][0] > length:
            depth, first, children = stack.pop()
            if last_child is not None:
                children.append(last_child)
            done.append((depth, first, at - 1, children))
            last_child = (first, at - 1)
        if stack[-1][0] == length:
            if last_child is not None:
                stack[-1][2].append(last_child)
        else:
            stack.append((length, first, [last_child] if last_child is not None else []))
    return done


def pairs(places: list[int], shared: list[int], low: int, high: int, left: list[int], found: dict[tuple[int, int], int]) -> None:
    """Note the maximal pairs within reach among the sorted places ``low..high``: (start, end) -> least distance."""
    tree = intervals(shared, low, high)
    where = {places[k]: k for k in range(low, high + 1)}
    before: dict[int, int] = {}
    after: dict[int, int] = {}

    def chain(members: list[int]) -> None:
        members.sort()
        last = -1
        for p in members:
            before[p] = last
            if last >= 0:
                after[last] = p
            last = p
        after[last] = -1

    for length, first, last, children in reversed(tree):
        if places[first] not in before:  # the top of the segment: its list is not built yet
            chain([places[k] for k in range(first, last + 1)])
        # All children, single places too; the largest keeps the list.
        every, at = [], first
        for a, b in children:
            every += [(k, k) for k in range(at, a)]
            every.append((a, b))
            at = b + 1
        every += [(k, k) for k in range(at, last + 1)]
        largest = max(every, key=lambda c: c[1] - c[0])
        moved = [c for c in every if c is not largest]
        for a, b in moved:
            for k in range(a, b + 1):
                p = places[k]
                q = after[p]
                if q >= 0 and q - p <= length and not a <= where[q] <= b and left[p] != left[q]:
                    key = (p, q + length)
                    found[key] = min(found.get(key, q - p), q - p)
                q = before[p]
                if q >= 0 and p - q <= length and not a <= where[q] <= b and left[p] != left[q]:
                    key = (q, p + length)
                    found[key] = min(found.get(key, p - q), p - q)
        for a, b in moved:
            for k in range(a, b + 1):
                p = places[k]
                one, two = before[p], after[p]
                if one >= 0:
                    after[one] = two
                if two >= 0:
                    before[two] = one
        for a, b in moved:
            if a < b:
                chain([places[k] for k in range(a, b + 1)])


def runs_of(symbols: np.ndarray, text: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (among all symbols), length and period of every run, in that order; ``text`` numbers the texts upwards."""
    none = np.zeros(0, np.int64)
    least = -(-min_words // 2)  # a run agrees with itself, one period on, for at least this many symbols
    n = len(symbols)
    if n <= least:
        return none, none, none
    grams = textbytes.gram_hash(symbols, least)
    whole = text[: len(grams)] == text[least - 1 :]
    with np.errstate(over="ignore"):
        keyed = textbytes.mix(grams[whole] + text[: len(grams)][whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed)
    twice = np.flatnonzero(keyed[order[1:]] == keyed[order[:-1]])
    if not len(twice):
        return none, none, none
    # Only texts in which a gram occurs twice can have a run.
    holds = np.zeros(int(text[-1]) + 1, bool)
    holds[text[np.flatnonzero(whole)[order[twice]]]] = True
    chosen = np.flatnonzero(holds[text])
    some, own = symbols[chosen], text[chosen]
    places, levels = suffix_levels(some, own)
    shared = common_prefixes(places, levels, np.searchsorted(own, own, side="right"))
    del levels
    left = some.tolist()
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    previous = [None, *left[:-1]]
    for k in np.flatnonzero(first).tolist():
        previous[k] = (k,)  # nothing precedes a text: a class of its own
    found: dict[tuple[int, int], int] = {}
    joined = shared >= least
    edges = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
    listed, lengths = places.tolist(), shared.tolist()
    for low, high in zip((edges[::2] - 1).tolist(), (edges[1::2] - 1).tolist(), strict=True):
        pairs(listed, lengths, low, high, previous, found)
    rows = sorted((s, e - s, d) for (s, e), d in found.items() if e - s >= max(min_words, 2 * d))
    if not rows:
        return none, none, none
    start, length, period = np.array(rows, np.int64).T
    return chosen[start], length, period


def kept_words(words: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:-1] == 0


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): all runs of each text, and the text with each run cut to its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in textbytes.blocks(batch.column(1)):
                starts, ends, before = textbytes.spans(data, bounds)
                text = np.repeat(np.arange(end - row), np.diff(before))
                start, length, period = runs_of(textbytes.hash_spans(data, starts, ends), text, min_words)
                keep = kept_words(len(starts), start, length, period)
                collapsed = _joined(data, starts[keep], ends[keep], text[keep], end - row)
                cuts = np.searchsorted(start, before)
                columns = [pa.array(v.astype(np.int32)) for v in (start - before[text[start]], length, period)] if len(start) else [pa.array([], pa.int32())] * 3
                runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
                counts = pa.array(np.diff(before).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), counts, runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    """The given words of each text, joined by one space."""
    sizes = ends - starts + 1
    edge = np.concatenate(([0], np.cumsum(sizes)))
    out = data[np.minimum(np.arange(edge[-1]) + np.repeat(starts - edge[:-1], sizes), len(data) - 1)] if len(sizes) else np.zeros(0, np.uint8)
    out[edge[1:] - 1] = 0x20
    keep = np.ones(len(out), bool)
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    keep[edge[1:][last] - 1] = False
    counted = np.concatenate(([0], np.cumsum(keep)))
    offsets = counted[edge[np.searchsorted(text, np.arange(texts + 1))]]
    return pa.LargeStringArray.from_buffers(texts, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[keep].tobytes())).cast(pa.string())
