"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Tokens are lower-cased (A-Z) words and one end token per text.  Counting: every task adds up its bigrams
and sends, for each shard of the hash range, one sorted table of counts; shards are merged on their own,
so no group is larger than its share of the hash range.  A bigram's shard depends on its context and on
``SPLIT`` classes of its word, so the followers of a very common word are spread over several shards.

Model folder (below the cluster's shared folder, which workers must be able to map as files):
``bigram-*``: sorted 64-bit keys and counts; ``context-*``: sorted context hashes, their tokens and their
interpolation weight; ``word-*``: sorted word hashes, their counts and the distinct words before them.
Keys are ordered over all shards, so a batch of sorted look-ups walks through the files once.

score(w | u) = (c(uw) - D) / c(u) + weight(u) * p(w), where p interpolates the continuation share of w with
the uniform distribution over the vocabulary and one unknown word.

Defined results: NULL or empty text is the end token alone; repeated rows count and score as often as they
occur; an empty training set gives a uniform model over one unknown word.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes
from wardgrid.session import staging_path

BEGIN = np.uint64(0x1B873593CC9E2D51)  # context of the first word; no word hashes to these but by chance
END = np.uint64(0x85EBCA6BC2B2AE35)
SPLIT = 4
TASK_BIGRAMS = 4_000_000  # distinct bigrams a task holds before it sends them on


def token_arrays(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens, tokens before each text) of blocks of texts; every text ends with END."""
    for first, end, data, bounds in textbytes.blocks(texts):
        lowered = textbytes.LOWER[data]
        starts, ends, before = textbytes.spans(lowered, bounds)
        words = textbytes.hash_spans(lowered, starts, ends)
        cuts = before + np.arange(len(before))
        tokens = np.full(int(cuts[-1]), END, np.uint64)
        keep = np.ones(len(tokens), bool)
        keep[cuts[1:] - 1] = False
        tokens[keep] = words
        yield first, end, tokens, cuts


def contexts_of(tokens: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The token before each token; BEGIN at the start of a text."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[cuts[:-1]] = BEGIN
    return out


def bigram_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Sixteen bits from the context and a class of the word, which choose the shard, then 48 bits of both."""
    with np.errstate(over="ignore"):
        place = textbytes.mix(context * np.uint64(SPLIT) + (word >> np.uint64(60)) % np.uint64(SPLIT)) >> np.uint64(48)
        rest = textbytes.mix(context * textbytes.GRAM[1] + word * textbytes.GRAM[2]) >> np.uint64(16)
    return (place << np.uint64(48)) | rest


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(shards)) >> np.uint64(16)


def add_up(keys: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct sorted keys, the columns of their first row, and summed counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    sums = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return keys[first], [c[order][first] for c in columns], sums


COUNTED = "shard int, contexts binary, words binary, counts binary"


def _count(shards: int):
    def flush(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        context, word, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, (context, word), count = add_up(bigram_keys(context, word), [context, word], count)
        cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
        rows = [(k, context[a:b].tobytes(), word[a:b].tobytes(), count[a:b].astype(np.int64).tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["shard", "contexts", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, tokens, cuts in token_arrays(batch.column(0)):
                context = contexts_of(tokens, cuts)
                _, (context, word), count = add_up(bigram_keys(context, tokens), [context, tokens], np.ones(len(tokens), np.int64))
                parts.append((context, word, count))
                held += len(word)
                if held > TASK_BIGRAMS:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as files of their own; a repeated task replaces them by the same bytes."""
    for part, array in arrays.items():
        path = f"{folder}/{name}.{part}.npy"
        own = f"{path}.{uuid.uuid4().hex}.part"
        with open(own, "wb") as file:
            np.save(file, array)
        os.replace(own, path)


MERGED = "kind string, key bigint, a bigint, b bigint, c bigint, d bigint"


def _merge_shards(folder: str):
    """Merge each shard's tables, save its bigrams, and pass on sums per context and per word of this shard."""

    def finish(shard: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        context, word, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, (context, word), count = add_up(bigram_keys(context, word), [context, word], count)
        high = np.flatnonzero(count > 254)
        _save(folder, f"bigram-{shard:06d}", {"keys": keys, "counts": np.minimum(count, 255).astype(np.uint8), "high": np.stack([high, count[high]])})
        seen = [(count == k).astype(np.int64) for k in (1, 2)] + [(count >= 3).astype(np.int64)]
        names, _, tokens = add_up(context, [], count)
        ones, twos, more = (add_up(context, [], s)[2] for s in seen)
        yield _rows("context", names, tokens, ones, twos, more)
        names, _, tokens = add_up(word, [], count)
        yield _rows("word", names, tokens, add_up(word, [], np.ones_like(count))[2])
        of = np.array([int((count == k).sum()) for k in (1, 2, 3, 4)], np.int64)
        yield _rows("total", np.zeros(1, np.uint64), *[of[k : k + 1] for k in range(4)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:  # sorted by shard
            for k, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != shard and parts:
                    yield from finish(shard, parts)
                    parts = []
                shard = k
                parts.append((np.frombuffer(blobs[0], np.uint64), np.frombuffer(blobs[1], np.uint64), np.frombuffer(blobs[2], np.int64)))
        if parts:
            yield from finish(shard, parts)

    return run


def _rows(kind: str, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    filled = [*columns, *[np.zeros(len(keys), np.int64)] * (4 - len(columns))]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(keys), pa.string()) if len(keys) < 2 else pa.DictionaryArray.from_arrays(np.zeros(len(keys), np.int32), [kind]).cast(pa.string()),
         pa.array(keys.view(np.int64)), *[pa.array(c, pa.int64()) for c in filled]],
        ["kind", "key", "a", "b", "c", "d"],
    )


# Over all words: how many there are, their tokens, their distinct contexts, and how many have 1 to 4 of these.
SUMS = ("vocabulary", "tokens", "bigrams", "one", "two", "three", "four")


def _save_tables(folder: str):
    """Save the summed contexts and words of each shard, sorted by hash; rows come sorted by kind and shard."""

    def finish(kind: str, shard: int, parts: list[tuple[np.ndarray, ...]]) -> None:
        key, *columns = (np.concatenate(x) for x in zip(*parts, strict=True))
        key = key.view(np.uint64)
        order = np.argsort(key)
        _save(folder, f"{kind}-{shard:06d}", {"keys": key[order], "values": np.stack([c[order] for c in columns], 1)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, sums = None, [], np.zeros(len(SUMS), np.int64)
        for batch in batches:
            kind = np.array(batch.column(0).to_pylist(), object)
            shard = batch.column(1).to_numpy()
            rest = [batch.column(k).to_numpy() for k in range(2, 7)]
            tokens, before = rest[1][kind == "word"], rest[2][kind == "word"]
            sums += [len(before), tokens.sum(), before.sum(), *[(before == k).sum() for k in (1, 2, 3, 4)]]
            borders = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (shard[1:] != shard[:-1])))) if len(kind) else []
            for a, b in zip(borders, [*borders[1:], len(kind)], strict=True):
                if (kind[a], shard[a]) != at and parts:
                    finish(*at, parts)
                    parts = []
                at = (kind[a], shard[a])
                parts.append(tuple(x[a:b] for x in rest))
        if parts:
            finish(*at, parts)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums.tolist()], list(SUMS))

    return run


def local_folder(path: str) -> str:
    """The shared folder as a path that workers can map."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model is memory-mapped, so the shared folder must be mounted on every executor, not {path}")
    return parts.path


def train(docs: DataFrame, shards: int | None = None) -> str:
    """Count ``docs`` and write the model; its folder."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = local_folder(staging_path(spark, "kneser-ney"))
    os.makedirs(folder)
    counted = docs.select("text").mapInArrow(_count(shards), COUNTED)
    sums = (
        counted.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_merge_shards(folder), MERGED)
        .groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in "abcd"])
    )
    # The counters of the whole corpus and one row per word or context; the former is one row.
    place = F.when(F.col("kind") == "total", F.lit(0)).otherwise(F.shiftrightunsigned("key", 48) * shards).cast("long")
    tables = (
        sums.withColumn("shard", F.shiftright(place, 16).cast("int")).select("kind", "shard", "key", "a", "b", "c", "d")
        .repartition(shards, "kind", "shard").sortWithinPartitions("kind", "shard")
    )
    saved = tables.mapInArrow(_save_tables(folder), ", ".join(f"{c} bigint" for c in SUMS))
    done = saved.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]).first().asDict()
    totals = f"{folder}/total-000000.values.npy"
    of = np.load(totals)[0].tolist() if os.path.exists(totals) else [0, 0, 0, 0]
    lower = discounts([done[c] for c in ("one", "two", "three", "four")])
    summary = {"shards": shards, "discounts": discounts(of), "lower_discounts": lower, **done}
    with open(f"{folder}/model.json", "w") as file:
        json.dump(summary, file)
    return folder


def discounts(of: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of bigrams that occur once, twice, three and four times."""
    if min(of) == 0:
        return [0.5, 0.75, 0.9]
    y = of[0] / (of[0] + 2 * of[1])
    found = [k - (k + 1) * y * of[k] / of[k - 1] for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True)]


class Shards:
    """Sorted arrays over all shards of one kind, mapped when first used."""

    def __init__(self, folder: str, kind: str, shards: int, parts: tuple[str, ...]):
        self.folder, self.kind, self.shards, self.parts = folder, kind, shards, parts
        self.open: dict[int, list[np.ndarray] | None] = {}

    def arrays(self, shard: int) -> list[np.ndarray] | None:
        if shard not in self.open:
            names = [f"{self.folder}/{self.kind}-{shard:06d}.{p}.npy" for p in ("keys", *self.parts)]
            self.open[shard] = [np.load(n, mmap_mode="r") for n in names] if os.path.exists(names[0]) else None
        return self.open[shard]

    def find(self, keys: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """For sorted keys: (their slice, which of it are found, the places of those, the shard's arrays)."""
        cuts = np.searchsorted(shard_of(keys, self.shards), np.arange(self.shards + 1))
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a and (arrays := self.arrays(shard)) is not None and len(arrays[0]):
                at = np.minimum(np.searchsorted(arrays[0], keys[a:b]), len(arrays[0]) - 1)
                hit = arrays[0][at] == keys[a:b]
                yield slice(a, b), hit, at[hit], arrays


class Model:
    """A trained model, opened by a worker."""

    def __init__(self, folder: str):
        with open(f"{folder}/model.json") as file:
            about = json.load(file)
        self.bigrams, self.vocabulary, self.discount = about["bigrams"], about["vocabulary"], np.array([0.0, *about["discounts"]])
        self.tokens = about["tokens"]
        self.lower_discount = np.array([0.0, *about["lower_discounts"]])
        of = np.array([about["one"], about["two"], about["vocabulary"] - about["one"] - about["two"]])
        self.lower_weight = float(of @ self.lower_discount[1:]) / max(self.bigrams, 1)
        self.pairs = Shards(folder, "bigram", about["shards"], ("counts", "high"))
        self.contexts = Shards(folder, "context", about["shards"], ("values",))
        self.words = Shards(folder, "word", about["shards"], ("values",))

    def word_values(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted distinct words: their counts and the distinct words before them."""
        out = np.zeros((len(words), 2), np.int64)
        for part, hit, at, (_, values) in self.words.find(words):
            view = out[part]
            view[hit] = values[at][:, :2]
        return out[:, 0], out[:, 1]

    def context_values(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted distinct contexts: their tokens and the weight of the lower order."""
        tokens, weight = np.zeros(len(contexts)), np.ones(len(contexts))
        for part, hit, at, (_, values) in self.contexts.find(contexts):
            found = values[at]
            tokens[part][hit] = found[:, 0]
            weight[part][hit] = found[:, 1:4] @ self.discount[1:] / found[:, 0]
        return tokens, weight

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for part, hit, at, (_, counts, high) in self.pairs.find(keys):
            found = counts[at].astype(np.int64)
            large = np.flatnonzero(found == 255)
            if len(large):
                found[large] = high[1][np.searchsorted(high[0], at[large])]
            out[part][hit] = found
        return out

    def lower(self, before: np.ndarray) -> np.ndarray:
        """Probability from the distinct words before a word, interpolated with the uniform distribution."""
        if not self.bigrams:
            return np.ones(len(before))
        share = np.maximum(before - self.lower_discount[np.minimum(before, 3)], 0) / self.bigrams
        return share + self.lower_weight / (self.vocabulary + 1)

    def token_values(self, tokens: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and log10 probability of each token."""
        words, of_word = np.unique(tokens, return_inverse=True)
        counts, before = self.word_values(words)
        above, of_context = np.unique(contexts, return_inverse=True)
        total, weight = self.context_values(above)
        keys, of_pair = np.unique(bigram_keys(contexts, tokens), return_inverse=True)
        pair = self.pair_counts(keys)
        higher = np.maximum(pair - self.discount[np.minimum(pair, 3)], 0)[of_pair] / np.maximum(total, 1)[of_context]
        return counts[of_word], np.log10(higher + weight[of_context] * self.lower(before)[of_word])


SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, folder: str, add: float = 0.1) -> DataFrame:
    """Token counts, a smoothed unigram score and the model's log10 probability of every text.

    Perplexity is ``10 ** (-score / n_tokens)``.  Scoring needs no shuffle; workers share the mapped files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder)
        for batch in batches:
            sums = []
            for _, _, tokens, cuts in token_arrays(batch.column(1)):
                count, logp = model.token_values(tokens, contexts_of(tokens, cuts))
                base = np.log10((count + add) / (model.tokens + add * (model.vocabulary + 1)))
                sums.append(np.stack([np.diff(cuts), *[np.add.reduceat(x, cuts[:-1]) for x in ((count > 0).astype(float), base, logp)]], 1))
            if sums:
                n, known, base, logp = np.concatenate(sums).T
                whole = [pa.array(x.astype(np.int64)) for x in (n, known, np.full(len(n), model.tokens))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *whole, pa.array(base), pa.array(logp)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED)
