"""Prediction intervals from held-out residuals, and how often they hold.

Predictions fall into bins of about equal size; the exact quantiles of actual minus predicted inside a bin, added to
a prediction, are its interval.  Both the edges of the bins and the residual quantiles come from the rows of the *other*
folds, for all folds in one pass, so every row is judged by rows it had no part in.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.operators.quantiles import exact_quantiles
from wardgrid.operators.splits import folds
from wardgrid.session import staged

LEVELS = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def _bin(edges: Column, predicted: Column) -> Column:
    """How many edges lie below the prediction."""
    return F.size(F.filter(edges, lambda e: e < predicted))


def interval_table(
    rows: DataFrame, actual: str, predicted: str, by: str, groups: int, bins: int = 10, levels: Mapping[str, float] = LEVELS
) -> DataFrame:
    """(``by``, bin, n, edges, one column of residual quantiles per level), for at most ``groups`` values of ``by``."""
    known = rows.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    cuts = exact_quantiles(known, predicted, {f"_e{k}": k / bins for k in range(1, bins)}, [by], groups)
    edges = staged(cuts.select(by, F.array(*[f"_e{k}" for k in range(1, bins)]).alias("edges")), "edges")
    # Written once, three numbers a row: the quantiles below read them three times.
    binned = staged(
        known.join(F.broadcast(edges), by).select(
            by, _bin(F.col("edges"), F.col(predicted)).alias("bin"), (F.col(actual) - F.col(predicted)).alias("_residual")
        ),
        "binned",
    )
    quantiles = exact_quantiles(binned, "_residual", levels, [by, "bin"], groups * bins, [F.count(F.lit(1)).alias("n")])
    quantiles = quantiles.join(F.broadcast(edges), by)
    return quantiles.select(by, "bin", "n", "edges", *levels)


def apply_intervals(rows: DataFrame, table: DataFrame, predicted: str, by: str, levels: Mapping[str, float] = LEVELS) -> DataFrame:
    """``rows`` with ``bin`` and the predicted quantiles; ``table`` holds at most groups x bins rows.

    A prediction whose bin held no residual gets missing quantiles.
    """
    edges = table.groupBy(F.col(by).alias("_b")).agg(F.first("edges").alias("_edges"))
    placed = rows.join(F.broadcast(edges), F.col(by) == F.col("_b")).withColumn("bin", _bin(F.col("_edges"), F.col(predicted)))
    shifts = table.select(F.col(by).alias("_t"), F.col("bin").alias("_tbin"), *[F.col(c).alias(f"_s_{c}") for c in levels])
    met = placed.join(F.broadcast(shifts), (F.col(by) == F.col("_t")) & (F.col("bin") == F.col("_tbin")), "left")
    return met.select(*[f"`{c}`" for c in rows.columns], "bin", *[(F.col(predicted) + F.col(f"_s_{c}")).alias(c) for c in levels])


def quantile_intervals(
    preds: DataFrame, id_col: str | list[str], actual: str, predicted: str, bins: int = 10, k: int = 5, seed: int = 42,
    levels: Mapping[str, float] = LEVELS,
) -> DataFrame:
    """``preds`` with ``fold``, ``bin`` and the predicted quantiles, calibrated on the other ``k - 1`` folds."""
    # Written once: a fold costs a hash of the id, and the calibration reads the rows several times.
    marked = staged(folds(preds, id_col, None, k, seed), "marked")
    others = F.explode(F.filter(F.array(*map(F.lit, range(k))), lambda f: f != F.col("fold"))).alias("_for")
    calibration = marked.select(F.col(actual), F.col(predicted), others)
    table = staged(interval_table(calibration, actual, predicted, "_for", k, bins, levels).withColumnRenamed("_for", "fold"), "intervals")
    return apply_intervals(marked, table, predicted, "fold", levels)


def interval_coverage(intervals: DataFrame, actual: str, low: str = "p10", high: str = "p90", by: str = "bin") -> DataFrame:
    """Per bin: rows with both values, the share of actual values inside the interval, and its mean width."""
    known = intervals.where(F.col(actual).isNotNull() & F.col(low).isNotNull())
    return known.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(actual).between(F.col(low), F.col(high)).cast("double")).alias("coverage"),
        F.avg(F.col(high) - F.col(low)).alias("mean_width"),
    )
