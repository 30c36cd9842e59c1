"""A byte-level convolutional network in numpy that scores the quality of whole texts.

A text's bytes are embedded; learned filters run over all of them.  Chunks of ``CHUNK_CELLS`` cells (128
bytes each) overlap by one cell and cover the document from end to end.  Every filter is max-pooled inside
each chunk; the strongest chunk and the mean over chunks of each filter are combined into one probability.

The network is fitted on the driver from at most ``max_rows`` labelled texts of at most ``max_bytes`` together
(in order of a hash of their id, leaving out what doesn't fit); both are parameters, and every chosen text is
read whole.  Scoring reads every byte of every text, in blocks of bounded size, and needs no shuffle: the
model is a few kB.  A window that would reach into the next text is never looked at, so a score depends on
the text alone.

Defined results: NULL or empty text gets the score of a text without bytes; a NULL label is not learnt
from; several labels of one document count by majority (ties count as 1); without labels of both kinds
every score is the share of label 1 (0.5 without labels); repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes

CELL = 128  # bytes
CHUNK_CELLS = 4
CHUNK_STEP = 3
WIDTH = 8  # bytes a filter sees
STRIDE = 2
EMBED = 8
FILTERS = 16
PAD = 256  # the byte value of padding; its embedding stays zero
BLOCK_CELLS = 4096  # half a megabyte of text at once


@dataclass
class Network:
    """Embedding (257 x EMBED), filters (WIDTH*EMBED x FILTERS), their bias, output weights and bias."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights]


def start_network(seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
    embedding[PAD] = 0
    filters = rng.normal(0, 0.3, (WIDTH * EMBED, FILTERS)).astype(np.float32)
    return Network(embedding, filters, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0)


def cells_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts laid out in whole cells with at least WIDTH padding after each, and the cells before each text."""
    sizes = np.diff(bounds)
    cells = (sizes + WIDTH + CELL - 1) // CELL
    before = np.concatenate(([0], np.cumsum(cells)))
    out = np.full(int(before[-1]) * CELL, PAD, np.int16)
    out[np.arange(len(data)) + np.repeat(before[:-1] * CELL - bounds[:-1], sizes)] = data
    return out, before


def cell_maxima(net: Network, values: np.ndarray, last: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Each filter's maximum in every cell (cells x FILTERS), and the position of it in the cell.

    Windows that start at the end of a ``last`` cell of a text would read the next text.  They hold no byte of
    their own text beyond its padding, which an earlier window has seen, and are left out.
    """
    pairs = np.take(net.embedding, values, axis=0).reshape(-1, STRIDE * EMBED)
    taps = WIDTH // STRIDE
    kernel = net.filters.reshape(taps, STRIDE * EMBED, FILTERS).transpose(1, 0, 2).reshape(STRIDE * EMBED, -1)
    partial = (pairs @ kernel).reshape(len(pairs), taps, FILTERS)
    response = np.ascontiguousarray(partial[:, 0])
    for k in range(1, taps):
        response[:-k] += partial[k:, k]
    response = response.reshape(-1, CELL // STRIDE, FILTERS)
    response[last, 1 - taps :] = -np.inf
    if not where:
        return response.max(1) + net.bias, None
    at = response.argmax(1)
    return np.take_along_axis(response, at[:, None], 1)[:, 0] + net.bias, at


def maxima_of(net: Network, values: np.ndarray, before: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """``cell_maxima`` of whole texts, in slices of bounded size."""
    cells, ends = len(values) // CELL, np.zeros(len(values) // CELL + 1, bool)
    ends[before[1:] - 1] = True
    maxima, places = [], []
    for at in range(0, cells, BLOCK_CELLS):
        stop = min(at + BLOCK_CELLS, cells)
        part = values[at * CELL : (stop + 1) * CELL]  # filters reach over the border of the slice
        most, place = cell_maxima(net, part, np.flatnonzero(ends[at : at + len(part) // CELL]), where)
        maxima.append(most[: stop - at])
        if place is not None:
            places.append(place[: stop - at])
    return np.concatenate(maxima), np.concatenate(places) if places else None


def chunk_borders(before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end cell of every chunk, and the chunks before each text."""
    cells = np.diff(before)
    chunks = np.maximum(1, -(-(cells - 1) // CHUNK_STEP))
    first = np.concatenate(([0], np.cumsum(chunks)))
    number = np.arange(first[-1]) - np.repeat(first[:-1], chunks)
    start = np.repeat(before[:-1], chunks) + number * CHUNK_STEP
    return start, np.minimum(start + CHUNK_CELLS, np.repeat(before[1:], chunks)), first


def pooled(maxima: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squashed chunk maxima, and the chunks before each text."""
    start, end, first = chunk_borders(before)
    padded = np.vstack([maxima, np.full((1, maxima.shape[1]), -np.inf, maxima.dtype)])
    borders = np.stack([start, end], 1).ravel()
    return np.tanh(np.maximum.reduceat(padded, borders, axis=0)[::2]), first


def combine(net: Network, chunks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features (strongest and mean chunk per filter) and the logit of each text."""
    strongest = np.maximum.reduceat(chunks, first[:-1], axis=0)
    mean = np.add.reduceat(chunks, first[:-1], axis=0) / np.diff(first)[:, None]
    features = np.hstack([strongest, mean])
    return features, features @ net.weights + net.offset


def score_texts(net: Network, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 for each text; a text longer than a block is read in slices of whole cells."""
    scores = [_score_block(net, data, bounds) for _, _, data, bounds in textbytes.blocks(texts, BLOCK_CELLS * CELL)]
    return np.concatenate(scores) if scores else np.zeros(0)


def _score_block(net: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    values, before = cells_of(data, bounds)
    maxima, _ = maxima_of(net, values, before)
    chunks, first = pooled(maxima, before)
    logits = combine(net, chunks, first)[1]
    return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))


def fit(texts: list[bytes], labels: list[int], steps: int = 900, batch: int = 32, rate: float = 0.004, seed: int = 0) -> Network:
    """Train by Adam on the log loss, in about ``steps`` batches.  Only the winning position of a filter in a chunk has a gradient."""
    net = start_network(seed)
    share = float(np.mean(labels)) if labels else 0.5
    if not labels or share in (0.0, 1.0):
        net.weights[:] = 0
        net.offset = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return net
    net.offset = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    layouts = [cells_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] for text in texts]
    target = np.array(labels, np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in [*net.parameters(), np.zeros(1, np.float32)]]
    epochs = -(-steps // -(-len(texts) // batch))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            gradients = _gradients(net, [layouts[k] for k in chosen], target[chosen])
            step += 1
            pace = rate * (1 - epoch / epochs) + rate * 0.05
            offset = np.array([net.offset], np.float32)
            for p, g, (m, v) in zip([*net.parameters(), offset], gradients, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)
            net.offset = float(offset[0])
            net.embedding[PAD] = 0
    return net


def _gradients(net: Network, layouts: list[np.ndarray], target: np.ndarray) -> list[np.ndarray]:
    values = np.concatenate(layouts)
    before = np.concatenate(([0], np.cumsum([len(x) // CELL for x in layouts])))
    maxima, at = maxima_of(net, values, before, where=True)
    start, end, first = chunk_borders(before)
    # The winning cell of each chunk and filter: compare the cells of a chunk one by one.
    best = maxima[start]
    cell = np.repeat(start[:, None], FILTERS, 1)
    for k in range(1, CHUNK_CELLS):
        other = np.minimum(start + k, end - 1)
        better = maxima[other] > best
        best = np.where(better, maxima[other], best)
        cell = np.where(better, other[:, None], cell)
    chunks = np.tanh(best)
    features, logits = combine(net, chunks, first)
    error = (1 / (1 + np.exp(-logits)) - target) / len(target)
    d_weights = features.T @ error
    d_features = error[:, None] * net.weights[None, :]
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    d_chunks = (d_features[:, FILTERS:] / sizes[:, None])[text]
    # Of equally strong chunks (repeated passages) the first counts.
    number = np.arange(len(text))[:, None]
    winner = np.minimum.reduceat(np.where(chunks == features[:, :FILTERS][text], number, len(text)), first[:-1], axis=0)[text] == number
    d_chunks = d_chunks + np.where(winner, d_features[:, :FILTERS][text], 0)
    d_chunks *= 1 - chunks**2
    position = cell * CELL + np.take_along_axis(at, cell, 0) * STRIDE  # (chunks, FILTERS): first byte of the window
    window = values[np.minimum(position[..., None] + np.arange(WIDTH), len(values) - 1)]  # (chunks, FILTERS, WIDTH)
    seen = net.embedding[window].reshape(*position.shape, WIDTH * EMBED)
    d_filters = np.einsum("cf,cfk->kf", d_chunks, seen)
    d_seen = d_chunks[..., None] * net.filters.T[None]
    byte, d_byte = window.ravel(), d_seen.reshape(-1, EMBED)
    d_embedding = np.stack([np.bincount(byte, d_byte[:, k], PAD + 1) for k in range(EMBED)], 1)
    d_embedding[PAD] = 0
    return [d_embedding, d_filters, d_chunks.sum(0), d_weights, np.array([error.sum()])]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int, label: str = "quality") -> list[tuple[bytes, int]]:
    """(text, label) of the labelled documents in order of a hash of their id, as far as the bounds allow."""
    voted = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    first = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    own = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_key", F.xxhash64("text"))
    sizes = own.join(F.broadcast(first.select("doc_id")), F.col("_id") == F.col("doc_id")).select("_id", "_key", F.octet_length("text").alias("_size"))
    # Only ids, hashes and sizes travel until it is known which texts fit.
    known = sizes.distinct().orderBy(F.xxhash64("_id"), "_id", "_key", "_size").limit(max_rows).collect()
    chosen, room = [], max_bytes
    for r in known:
        if r["_size"] <= room:
            chosen.append((r["_id"], r["_key"]))
            room -= r["_size"]
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame(chosen, "_id long, _key long")
    rows = own.join(F.broadcast(wanted), ["_id", "_key"]).dropDuplicates(["_id", "_key"]).join(F.broadcast(first), F.col("_id") == F.col("doc_id"))
    return [(r["text"].encode(), r["_label"]) for r in sorted(rows.select("_id", "_key", "text", "_label").collect())]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = 64_000_000, steps: int = 900, label: str = "quality") -> Network:
    """Fit on the bounded sample; an id that occurs with several texts counts with each of them, equal rows count once."""
    rows = labelled_sample(docs, labels, max_rows, max_bytes, label)
    return fit([text for text, _ in rows], [value for _, value in rows], steps=steps)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few kB

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id bigint, score double")
