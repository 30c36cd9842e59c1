"""Evaluation of scores, classes and numeric predictions.

ROC-type measures need running totals over all distinct scores.  A window without partitioning
would pull them into one task, so scores fall into ordered cells first, and cells into blocks: totals
per block and per cell give each cell its offset, and the running total inside a cell is local.
Cells are functions of the score, so no job runs ahead and a recomputed task sees the same cells.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import order_cell

CELLS_PER_OCTAVE = 65_536
BLOCK = 1024


def _score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    return (
        scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isin(0, 1))
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )


def running_score_totals(
    scored: DataFrame, score: str, label: str, per_octave: int | None = None
) -> DataFrame:
    """Distinct scores with class counts, counts strictly below each score, and class totals.

    Columns: score, pos, neg, pos_below, neg_below, n_pos, n_neg.  Scores fall into ordered cells
    (``per_octave`` between a score and its double), cells into blocks of ``BLOCK`` cells.
    """
    counts = _score_counts(scored, score, label)
    cell = order_cell("score", per_octave or CELLS_PER_OCTAVE)
    cut = counts.selectExpr("*", f"{cell} as _cell").selectExpr("*", f"floor(_cell / {BLOCK}) as _block")
    cells = cut.groupBy("_block", "_cell").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    blocks = cells.groupBy("_block").agg(F.sum("_p").alias("_bp"), F.sum("_n").alias("_bn"))

    def sums(partition: list[str], order: str, columns: dict[str, str]) -> list:
        within = W.partitionBy(*partition) if partition else W
        before = within.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(out) for c, out in columns.items()]

    # The number of blocks follows from the range of doubles, not from the rows.
    whole = W.orderBy("_block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = blocks.select(
        "_block", *sums([], "_block", {"_bp": "_bp0", "_bn": "_bn0"}),
        F.sum("_bp").over(whole).alias("n_pos"), F.sum("_bn").over(whole).alias("n_neg"),
    )
    inner = cells.select("_block", "_cell", *sums(["_block"], "_cell", {"_p": "_p0", "_n": "_n0"}))
    located = inner.join(offsets, "_block").drop("_block")
    return (
        cut.select("_cell", "score", "pos", "neg", *sums(["_cell"], "score", {"pos": "_pi", "neg": "_ni"}))
        .join(located, "_cell")
        .select(
            "score", "pos", "neg",
            (F.col("_bp0") + F.col("_p0") + F.col("_pi")).alias("pos_below"),
            (F.col("_bn0") + F.col("_n0") + F.col("_ni")).alias("neg_below"),
            "n_pos", "n_neg",
        )
    )


def auroc(scored: DataFrame, score: str, label: str, per_octave: int | None = None) -> DataFrame:
    """Area under the ROC curve by the rank statistic, ties counting one half."""
    totals = running_score_totals(scored, score, label, per_octave)
    won = F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    return totals.agg(
        F.try_divide(
            F.sum(won), F.max("n_pos").cast("double") * F.max("n_neg").cast("double")
        ).alias("auroc"),
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
    )


def average_precision(scored: DataFrame, score: str, label: str, per_octave: int | None = None) -> DataFrame:
    """Sum over thresholds of recall gained times precision (step form, not trapezoidal)."""
    totals = running_score_totals(scored, score, label, per_octave)
    tp = F.col("n_pos") - F.col("pos_below")
    fp = F.col("n_neg") - F.col("neg_below")
    gain = F.try_divide(F.col("pos").cast("double"), F.col("n_pos"))
    return totals.agg(F.sum(gain * tp / (tp + fp)).alias("average_precision"))


def roc_points(scored: DataFrame, score: str, label: str, per_octave: int | None = None) -> DataFrame:
    """False and true positive rate at every distinct score, plus the origin (threshold NULL)."""
    return _rates(running_score_totals(scored, score, label, per_octave)).unionByName(_origin(scored))


def roc_points_reduced(scored: DataFrame, score: str, label: str, per_octave: int | None = None) -> DataFrame:
    """ROC points without those inside a straight piece: a point stays if the step to it differs from the next step.

    The highest and lowest threshold and the origin (threshold NULL) always stay, so the area is the same.  The next lower
    score may lie in an earlier cell or block; the last counts of a cell and of a block are compared over those borders.
    """
    totals = running_score_totals(scored, score, label, per_octave)
    cell = order_cell("score", per_octave or CELLS_PER_OCTAVE)
    cut = totals.selectExpr("*", f"{cell} as _cell").selectExpr("*", f"floor(_cell / {BLOCK}) as _block", "named_struct('p', pos, 'n', neg) as _step")
    tops = cut.groupBy("_block", "_cell").agg(F.max_by("_step", "score").alias("_top"))
    by_cell, by_block = W.partitionBy("_block").orderBy("_cell"), W.orderBy("_block")
    inner = tops.select(F.col("_block").alias("_b"), F.col("_cell").alias("_c"), F.lag("_top").over(by_cell).alias("_below_cell"))
    # One row per block; their number follows from the range of doubles, not from the rows.
    blocks = tops.groupBy("_block").agg(F.max_by("_top", "_cell").alias("_top")).select("_block", F.lag("_top").over(by_block).alias("_below_block"))
    borders = inner.join(blocks, F.col("_b") == F.col("_block")).select("_c", F.coalesce("_below_cell", "_below_block").alias("_below"))
    inside = W.partitionBy("_cell").orderBy("score")
    next_step = F.coalesce(F.col("_inside"), F.col("_below"))
    joined = cut.withColumn("_inside", F.lag("_step").over(inside)).join(borders, F.col("_cell") == F.col("_c"))
    highest = (F.col("pos_below") + F.col("pos") == F.col("n_pos")) & (F.col("neg_below") + F.col("neg") == F.col("n_neg"))
    kept = joined.where(highest | next_step.isNull() | (next_step != F.col("_step")))
    return _rates(kept).unionByName(_origin(scored))


def _rates(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("score").alias("threshold"),
        F.try_divide((F.col("n_neg") - F.col("neg_below")).cast("double"), F.col("n_neg")).alias("fpr"),
        F.try_divide((F.col("n_pos") - F.col("pos_below")).cast("double"), F.col("n_pos")).alias("tpr"),
    )


def _origin(scored: DataFrame) -> DataFrame:
    return scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )


def pr_curve(scored: DataFrame, score: str, label: str, per_octave: int | None = None) -> DataFrame:
    """Precision and recall at every distinct score."""
    totals = running_score_totals(scored, score, label, per_octave)
    tp = (F.col("n_pos") - F.col("pos_below")).cast("double")
    fp = F.col("n_neg") - F.col("neg_below")
    return totals.select(
        F.col("score").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("n_pos")).alias("recall"),
    )


def _cells(preds: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return preds.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(preds: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts on the full 2 x 2 grid, empty cells included."""
    grid = [
        F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for y, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
    return _cells(preds, label, pred).select(F.inline(F.array(*grid)))


def classification_report(preds: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    cells = _cells(preds, label, pred)
    c = {name: F.col(name) for name in ("tn", "fp", "fn", "tp")}
    scores = cells.select(
        *c.values(),
        ratio(c["tn"], c["tn"] + c["fn"]).alias("p0"),
        ratio(c["tn"], c["tn"] + c["fp"]).alias("r0"),
        ratio(c["tp"], c["tp"] + c["fp"]).alias("p1"),
        ratio(c["tp"], c["tp"] + c["fn"]).alias("r1"),
    ).select(
        "*",
        *[
            ratio(F.lit(2.0) * F.col(f"p{k}") * F.col(f"r{k}"), F.col(f"p{k}") + F.col(f"r{k}")).alias(f"f{k}")
            for k in (0, 1)
        ],
        (c["tn"] + c["fp"]).alias("s0"),
        (c["tp"] + c["fn"]).alias("s1"),
    )
    n = F.col("s0") + F.col("s1")
    accuracy = ratio(F.col("tn") + F.col("tp"), n)

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
            s.alias("support"),
        )

    def blend(m, weighted):
        if weighted:
            return ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), n)
        return (F.col(f"{m}0") + F.col(f"{m}1")) / F.lit(2.0)

    rows = [
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", accuracy, accuracy, accuracy, n),
        row("macro avg", *[blend(m, False) for m in "prf"], n),
        row("weighted avg", *[blend(m, True) for m in "prf"], n),
    ]
    return scores.select(F.inline(F.array(*rows)))


def regression_metrics(preds: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 in one aggregation; R2 measures against the mean of these rows."""
    error = F.col(predicted) - F.col(actual)
    known = preds.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    stats = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(actual).alias("_var"),
    )
    r2 = F.when(F.col("_var") == 0, F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)).otherwise(
        F.lit(1.0) - F.try_divide("_mse", "_var")
    )
    return stats.select("n", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))


def model_comparison(metrics: Iterable[DataFrame]) -> DataFrame:
    """One row per model; a metric a model lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), metrics)
