"""Correlation, z-score outliers, aligned trajectories and prediction errors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import hours_between
from wardgrid.functions.sqltext import ident, literal
from wardgrid.operators.sizing import sized
from wardgrid.session import staged


def _pair_correlation(a: str, b: str) -> str:
    # Pairwise complete Pearson; a constant column gives NULL where the built-in corr would raise.
    return (
        f"try_divide(covar_samp({a}, {b}), stddev_samp(case when {b} is not null then {a} end)"
        f" * stddev_samp(case when {a} is not null then {b} end))"
    )


def correlation_matrix(wide: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Full square Pearson matrix, long form, from one aggregation over the upper triangle."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    stats = wide.agg(
        *[F.expr(f"{_pair_correlation(ident(cols[i]), ident(cols[j]))} as _r{i}_{j}") for i, j in pairs]
    )
    cells = [
        f"named_struct('marker_a', {literal(a)}, 'marker_b', {literal(b)}, "
        f"'r', _r{min(i, j)}_{max(i, j)})"
        for i, a in enumerate(cols)
        for j, b in enumerate(cols)
    ]
    return stats.selectExpr(f"inline(array({', '.join(cells)}))")


def segmented_correlation(wide: DataFrame, segment: str, a: str, b: str) -> DataFrame:
    """Pearson correlation of two columns inside every segment, with the number of complete pairs."""
    return wide.where(F.col(segment).isNotNull()).groupBy(segment).agg(
        F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("n"),
        F.expr(f"{_pair_correlation(ident(a), ident(b))} as r"),
    )


def hours_segment(hours: Column, cuts: Iterable[float] = (24.0, 72.0)) -> Column:
    """The segment a number of hours after the anchor falls into, as ``0-24``, ``24-72``, ``72+``; NULL before the anchor."""
    edges = [0.0, *map(float, cuts)]
    out = F.when(hours >= edges[-1], f"{edges[-1]:g}+")
    for low, high in zip(edges, edges[1:]):
        out = out.when((hours >= low) & (hours < high), f"{low:g}-{high:g}")
    return out


def comoments(rows: DataFrame, by: str | list[str], a: str, b: str) -> DataFrame:
    """Per group the complete pairs of two columns as counts, means and centred sums, which ``merge_comoments`` can add up."""
    pairs = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    n = F.count(F.lit(1))
    return pairs.groupBy(*([by] if isinstance(by, str) else by)).agg(
        n.alias("n"), F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"),
        (F.var_pop(a) * n).alias("ss_a"), (F.var_pop(b) * n).alias("ss_b"), (F.covar_pop(a, b) * n).alias("ss_ab"),
    )


def merge_comoments(moments: DataFrame, by: str | list[str] = ()) -> DataFrame:
    """Co-moments of wider groups from those of the groups they consist of; the rows themselves are not read again."""
    keys = [by] if isinstance(by, str) else list(by)
    wide = moments.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean_a")) / F.sum("n")).alias("mean_a"),
        (F.sum(F.col("n") * F.col("mean_b")) / F.sum("n")).alias("mean_b"),
        F.collect_list(F.struct("n", "mean_a", "mean_b", "ss_a", "ss_b", "ss_ab")).alias("_parts"),
    )

    def total(own: str, left: str, right: str) -> Column:
        # Centred on the common means, so that nothing large cancels.
        def add(acc: Column, p: Column) -> Column:
            return acc + p[own] + p["n"] * (p[left] - F.col(left)) * (p[right] - F.col(right))

        return F.aggregate("_parts", F.lit(0.0), add).alias(own)

    return wide.select(
        *keys, "n", "mean_a", "mean_b", total("ss_a", "mean_a", "mean_a"), total("ss_b", "mean_b", "mean_b"), total("ss_ab", "mean_a", "mean_b")
    )


def comoment_correlation(moments: DataFrame) -> DataFrame:
    """The groups of ``moments`` with ``n`` and Pearson's ``r``; NULL where a column is constant."""
    keys = [c for c in moments.columns if c not in ("n", "mean_a", "mean_b", "ss_a", "ss_b", "ss_ab")]
    return moments.select(*keys, "n", F.try_divide(F.col("ss_ab"), F.sqrt("ss_a") * F.sqrt("ss_b")).alias("r"))


def correlation_by_hours(
    events: DataFrame, anchors: DataFrame, on: str, event_ts: str, anchor_ts: str, item: str, value: str, item_a, item_b,
    cuts: Iterable[float] = (24.0, 72.0),
) -> DataFrame:
    """Correlation of two items' peaks per entity, in each segment of hours after the anchor, and over all segments' pairs (``all``).

    ``anchors`` has one row per entity.  The last row is added up from the others.
    """
    marked = events.where(F.col(item).isin(item_a, item_b)).join(anchors.select(on, anchor_ts), on)
    placed = marked.select(on, item, value, hours_segment(hours_between(anchor_ts, event_ts), cuts).alias("segment")).where("segment is not null")
    peaks = placed.groupBy(on, "segment").agg(
        F.max(F.when(F.col(item) == item_a, F.col(value))).cast("double").alias("a"), F.max(F.when(F.col(item) == item_b, F.col(value))).cast("double").alias("b")
    )
    parts = staged(comoments(peaks, "segment", "a", "b"), "comoments")  # one row per segment
    whole = merge_comoments(parts).select(F.lit("all").alias("segment"), "*").where("n is not null")
    return comoment_correlation(parts.unionByName(whole))


def strongest_pair(corr: DataFrame) -> DataFrame:
    """The off-diagonal pair with the largest absolute correlation."""
    return (
        corr.where(F.col("marker_a") < F.col("marker_b"))
        .orderBy(F.abs("r").desc_nulls_last(), "marker_a", "marker_b")
        .limit(1)
    )


def zscore_outliers(
    peaks: DataFrame, subject: str, item: str, value: str, items: Iterable | None = None
) -> DataFrame:
    """Largest absolute z-score per subject and the item it comes from (ties: lowest item code).

    Long form throughout.  ``items`` keeps only these items; with such a list the per-item statistics are a provably small
    broadcast; otherwise they are staged so that their size decides.
    """
    items = list(items) if items is not None else None
    rows = peaks.where(F.col(item).isNotNull())
    if items is not None:
        rows = rows.where(F.col(item).isin(items))
    stats = rows.groupBy(item).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    stats = sized(stats, len(items) if items is not None else None, "item-stats")
    z = F.abs(F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd")))
    scored = rows.join(stats, item).select(subject, item, z.alias("_z"))
    # The largest z-score, of those the lowest item: one grouping with map-side combine.
    best = F.min(F.when(F.col("_z").isNotNull(), F.struct((-F.col("_z")).alias("z"), F.col(item).alias("item"))))
    found = scored.groupBy(subject).agg(best.alias("_best"))
    return found.select(subject, (-F.col("_best.z")).alias("max_abs_z"), F.col("_best.item").alias("extreme_item"))


def extreme_item(peaks: DataFrame, subject: str, item: str, value: str, items=None) -> DataFrame:
    """The item in which each subject deviates most."""
    return zscore_outliers(peaks, subject, item, value, items).select(subject, "extreme_item")


def outlier_threshold_flag(outliers: DataFrame, threshold: float = 2.5) -> DataFrame:
    """Mark subjects whose largest absolute z-score exceeds the threshold."""
    return outliers.withColumn(
        "is_outlier", F.coalesce(F.col("max_abs_z") > F.lit(threshold), F.lit(False))
    )


def aligned_trajectories(
    events: DataFrame,
    selected: DataFrame,
    anchors: DataFrame,
    fallback: DataFrame,
    items: Iterable,
    subject: str = "subject_id",
    item: str = "itemid",
    event_ts: str = "charttime",
    value: str = "valuenum",
    anchor_ts: str = "intime",
    fallback_ts: str = "admittime",
    low: float = -6.0,
    high: float = 120.0,
    selected_bound: int | None = None,
) -> DataFrame:
    """Measurements of the selected subjects in hours from their first anchor (else the fallback).

    The selection is joined to the anchors before any event is touched, so the event table meets
    one small side.  Both ends of the window are kept.
    """
    chosen = sized(selected.select(subject).distinct(), selected_bound, "selected")

    def first_time(df: DataFrame, ts: str, alias: str) -> DataFrame:
        mine = df.select(subject, ts).join(chosen, subject, "left_semi")
        return mine.groupBy(subject).agg(F.min(ts).alias(alias))

    zero = (
        chosen.join(first_time(anchors, anchor_ts, "_t1"), subject, "left")
        .join(first_time(fallback, fallback_ts, "_t2"), subject, "left")
        .select(subject, F.coalesce("_t1", "_t2").alias("_t0"))
    )
    hours = hours_between("_t0", event_ts)
    return (
        events.where(F.col(item).isin(list(items)))
        .join(sized(zero, selected_bound, "zero-time"), subject)
        .select(subject, item, hours.alias("hours"), value)
        .where(F.col("hours").between(low, high))
        .orderBy(subject, item, "hours", value)
    )


def predicted_vs_actual(preds: DataFrame, model: str, actual: str, predicted: str) -> DataFrame:
    """(model, actual, predicted) rows with the common axis maximum."""
    rows = preds.select(F.col(model).alias("model"), F.col(actual).alias("actual"),
                        F.col(predicted).alias("predicted"))
    top = preds.agg(F.greatest(F.max(actual), F.max(predicted)).alias("m")).scalar()
    return rows.withColumn("axis_max", top)


def prediction_error_histogram(
    preds: DataFrame, model: str, actual: str, predicted: str, models: Iterable[str], bins: int = 30
) -> DataFrame:
    """Equal-width bins of predicted minus actual for the named models; the maximum falls in the last bin."""
    models = list(models)
    errors = preds.where(F.col(model).isin(models)).select(
        F.col(model).alias("model"), (F.col(predicted) - F.col(actual)).alias("_e")
    ).where(F.col("_e").isNotNull())
    ends = errors.groupBy("model").agg(F.min("_e").alias("_lo"), F.max("_e").alias("_hi"))
    share = F.try_divide(F.col("_e") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    index = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(bins))), F.lit(bins - 1))
    return (
        errors.join(sized(ends, len(models)), "model")
        .groupBy(
            "model",
            index.cast("int").alias("bin"),
            (F.col("_lo") + index * (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))).alias("bin_low"),
        )
        .agg(F.count(F.lit(1)).alias("bin_count"))
    )
