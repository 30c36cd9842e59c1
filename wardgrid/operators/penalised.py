"""Boosted regression trees whose leaf values carry L1 and L2 penalties.

Spark grows the trees; their leaves are then valued anew, tree by tree: a leaf's value is the soft-thresholded sum of
the residuals of its rows over their number plus the L2 penalty.  Which leaf a row falls into is computed once for all
trees and written with the rows, a few bits a tree.  A pass sums residuals and counts rows by the combination of leaves in the next few
trees, at most ``CELLS`` of them.  These sums are all that the trees' values depend on, so the driver finds them in
turn without another pass, and nothing larger than the combinations reaches it; sums combine on the map side.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import literal
from wardgrid.session import staged

KEEP = 20  # trees after which the sum of the trees so far is written down; past 25 terms Java no longer compiles a pass
CELLS = 4096  # combinations of leaves that one pass tells apart, unless a single tree has more leaves


@dataclass
class PenalisedTrees:
    """The fitted trees, the constant they start from, and the (already scaled) value of every leaf of every tree."""

    model: PipelineModel
    start: float
    leaves: list[list[float]]


def _with_leaves(model: PipelineModel, df: DataFrame) -> DataFrame:
    *before, trees = model.stages
    for stage in before:
        df = stage.transform(df)
    found = trees.copy({trees.leafCol: "_leaf_vector"}).transform(df)
    return found.withColumn("_leaf", F.transform(vector_to_array("_leaf_vector"), lambda x: x.cast("int")))


def _numbers(values: Iterable[float]) -> str:
    """Constants as the text of an array; parsed at once, where the Column API needs a call for each."""
    return "array(" + ", ".join(literal(x) if math.isfinite(x) else f"double('{x}')" for x in values) + ")"


def _words(trees: int, bits: int) -> list[list[int]]:
    """The trees in words of 63 bits at most; ``KEEP`` trees fill whole words."""
    step = max(1, min(63 // bits, KEEP))
    return [list(range(first, min(first + step, trees))) for first in range(0, trees, step)]


def _leaf_in(word: list[int], name: str, tree: int, bits: int) -> str:
    """The leaf of a tree, read from the column ``name`` that packs the trees of ``word``."""
    return f"cast(shiftright({name}, {(word[-1] - tree) * bits}) & {2**bits - 1} as int)"


def _sum_of(leaves: list[list[float]], found: list[str]) -> str:
    """The values of the leaves a row falls into; ``found`` gives a leaf for each of these trees first."""
    return " + ".join(["0.0D", *[f"element_at({_numbers(v)}, {leaf} + 1)" for v, leaf in zip(leaves, found)]])


def _runs(sizes: list[int]) -> list[list[int]]:
    """The trees in runs whose combinations of leaves are at most ``CELLS``; a larger tree is a run of its own."""
    runs: list[list[int]] = []
    held = 0
    for size in sizes:
        if runs and held * size <= CELLS:
            runs[-1].append(size)
            held *= size
        else:
            runs.append([size])
            held = size
    return runs


def _values(cells: list[tuple[int, float, int]], sizes: list[int], rate: float, l1: float, l2: float) -> list[list[float]]:
    """Leaf values of a run of trees, from the sum of residuals and the number of rows of each combination of leaves."""
    out = []
    step = math.prod(sizes)
    for size in sizes:
        step //= size
        sums, counts = [0.0] * size, [0] * size
        for cell, g, n in cells:
            sums[cell // step % size] += g
            counts[cell // step % size] += n
        values = [0.0] * size
        for leaf in range(size):
            if counts[leaf]:
                shrunk = max(abs(sums[leaf]) - l1, 0.0)
                values[leaf] = rate * (shrunk if sums[leaf] > 0 else -shrunk) / (counts[leaf] + l2)
        out.append(values)
        cells = [(cell, g - n * values[cell // step % size], n) for cell, g, n in cells]
    return out


def refit_leaves(model: PipelineModel, train: DataFrame, label: str, rate: float = 0.05, l1: float = 0.1, l2: float = 1.0) -> PenalisedTrees:
    """Penalised leaf values for a fitted ``fit_gbt_regressor`` model, on its training rows and log(1 + label)."""
    target = F.log1p(F.col(label).cast("double"))
    sizes = [(tree.numNodes + 1) // 2 for tree in model.stages[-1].trees]
    bits = max(1, (max(sizes) - 1).bit_length())
    words = _words(len(sizes), bits)
    names = [f"_leaves_{w}" for w in range(len(words))]
    packed = [
        F.expr(f"aggregate(slice(_leaf, {w[0] + 1}, {len(w)}), 0L, (a, x) -> shiftleft(a, {bits}) | x)").alias(name)
        for w, name in zip(words, names)
    ]
    rows = staged(_with_leaves(model, train).select(target.alias("_y"), *packed).where("_y is not null"), "leaves")
    start = float(rows.agg(F.avg("_y")).first()[0] or 0.0)
    now = rows.withColumn("_f", F.lit(start))
    done: list[list[float]] = []
    step = max(1, KEEP // len(words[0]))
    for first in range(0, len(words), step):
        part = list(zip(words, names))[first : first + step]
        leaf = [_leaf_in(word, name, tree, bits) for word, name in part for tree in word]
        own: list[list[float]] = []
        for run in _runs([sizes[tree] for word, _ in part for tree in word]):
            cell = "0"
            for size, place in zip(run, leaf[len(own) :]):
                cell = f"({cell}) * {size} + {place}"
            residual = f"_y - _f - ({_sum_of(own, leaf)})"
            found = now.groupBy(F.expr(cell).alias("cell")).agg(F.expr(f"sum({residual})").alias("g"), F.count(F.lit(1)).alias("n"))
            own += _values(sorted(tuple(r) for r in found.collect()), run, rate, l1, l2)
        done += own
        if first + step < len(words):
            total = F.expr(f"_f + ({_sum_of(own, leaf)})").alias("_f")
            now = staged(now.select("_y", total, *names[first + step :]), "leaves")
    return PenalisedTrees(model, start, done)


def score_penalised(trees: PenalisedTrees, df: DataFrame) -> DataFrame:
    """``df`` with the log-scale prediction and the prediction in the target's own unit."""
    found = _with_leaves(trees.model, df)
    # One loop over the trees: hundreds of terms written out are too long for Spark to compile.
    values = "array(" + ", ".join(_numbers(v) for v in trees.leaves) + ")"
    each = F.zip_with("_leaf", F.expr(values), lambda leaf, of_tree: F.element_at(of_tree, leaf + 1))
    total = found.withColumn("_total", F.aggregate(each, F.lit(trees.start), lambda a, x: a + x))
    return total.select(*[f"`{c}`" for c in df.columns], F.col("_total").alias("predicted_log"), F.expm1("_total").alias("predicted"))
