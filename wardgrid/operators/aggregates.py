"""Descriptive aggregations: rates, counts, box summaries, histograms, peaks and nadirs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import coerce_numeric, fill_flag, label_or_code, normalise_category
from wardgrid.operators.quantiles import exact_quantiles


def overall_rate(df: DataFrame, flag: str) -> DataFrame:
    """Total, positives, negatives and the rate in percent."""
    return (
        df.agg(
            F.count(F.lit(1)).alias("n_total"),
            F.coalesce(F.sum(fill_flag(flag)), F.lit(0)).cast("long").alias("n_positive"),
        )
        .withColumn("n_negative", F.col("n_total") - F.col("n_positive"))
        .withColumn("rate_pct", F.try_divide(F.col("n_positive") * F.lit(100.0), F.col("n_total")))
    )


def rate_by_category(df: DataFrame, category: str, flag: str, normalise: bool = False) -> DataFrame:
    """Per category: number of flags, number of positives, rate in percent.

    ``normalise`` trims and upper-cases the category, keeps a missing one as the text ``NAN``, and
    turns unreadable flags into 0; otherwise missing categories drop and missing flags do not count.
    """
    if normalise:
        rows = df.select(
            normalise_category(category).alias(category),
            F.coalesce(coerce_numeric(flag), F.lit(0.0)).cast("int").alias("_flag"),
        )
    else:
        rows = df.where(F.col(category).isNotNull()).select(category, F.col(flag).alias("_flag"))
    return (
        rows.groupBy(category)
        .agg(
            F.count("_flag").alias("total"),
            F.coalesce(F.sum("_flag"), F.lit(0)).cast("long").alias("positive"),
        )
        .withColumn("rate_pct", F.try_divide(F.col("positive") * F.lit(100.0), F.col("total")))
    )


def top_k_labels(df: DataFrame, label: str, counted: str, k: int = 10) -> DataFrame:
    """The k labels with most non-missing counted values; ties go to the smaller label."""
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(counted).alias("n"))
        .orderBy(F.col("n").desc(), label)
        .limit(k)
    )


def top_k_titles(
    codes: DataFrame, titles: DataFrame, code: str, title: str, counted: str, k: int = 10
) -> DataFrame:
    """Most frequent titles of coded rows, falling back to the code where the lookup has none.

    Counts per code first, so the join with the lookup sees one row per code and a code that makes
    up a third of all rows is never shuffled row by row.
    """
    per_code = codes.groupBy(code).agg(F.count(counted).alias("_n"))
    named = per_code.join(titles.select(code, title), code, "left")
    return (
        named.groupBy(label_or_code(title, code).alias("label"))
        .agg(F.sum("_n").alias("n"))
        .orderBy(F.col("n").desc(), "label")
        .limit(k)
    )


def stay_by_unit(
    df: DataFrame, unit: str, stay: str, coerce: bool = False, ceiling: float = 35.0
) -> DataFrame:
    """Box summary of positive stays per unit, most frequent unit first, and a common scale ceiling.

    ``coerce`` reads the stay as a number, trims the unit, drops blank units and keeps a missing
    unit as the text ``nan``.
    """
    if coerce:
        rows = df.select(
            normalise_category(unit, upper=False).alias(unit), coerce_numeric(stay).alias(stay)
        ).where((F.col(stay) > 0) & (F.col(unit) != ""))
    else:
        rows = df.where(F.col(stay) > 0).select(unit, stay)
    summary = exact_quantiles(
        rows,
        stay,
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
        by=[unit],
        extra=[
            F.count(stay).alias("n"),
            F.min(stay).alias("min"),
            F.max(stay).alias("max"),
            F.avg(stay).alias("mean"),
            F.stddev_samp(stay).alias("sd"),
        ],
    )
    p95 = exact_quantiles(rows, stay, {"p95": 0.95}).select("p95").scalar()
    return summary.withColumn(
        "scale_ceiling", F.least(p95 * F.lit(1.2), F.lit(float(ceiling)))
    ).orderBy(F.col("n").desc(), unit)


def bounded_histogram(
    events: DataFrame, item: str, value: str, spec: Mapping[object, tuple[float, float, float]]
) -> DataFrame:
    """Fixed-width bins per item over low < value <= high, with the item's n, median and mean.

    The upper end belongs to the last bin.
    """
    low, high, width = (
        reduce(
            lambda acc, kv: acc.when(F.col(item) == kv[0], F.lit(float(kv[1][i]))),
            spec.items(),
            F.when(F.lit(False), F.lit(0.0)),
        )
        for i in range(3)
    )
    rows = (
        events.where(F.col(item).isin(list(spec)) & F.col(value).isNotNull())
        .select(item, F.col(value).cast("double").alias("_v"), low.alias("_lo"), high.alias("_hi"),
                width.alias("_w"))
        .where((F.col("_v") > F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
    )
    index = F.floor((F.col("_v") - F.col("_lo")) / F.col("_w"))
    last = F.ceil((F.col("_hi") - F.col("_lo")) / F.col("_w")) - 1
    bins = rows.groupBy(
        item, (F.col("_lo") + F.least(index, last) * F.col("_w")).alias("bin_low")
    ).agg(F.count(F.lit(1)).alias("bin_count"))
    markers = exact_quantiles(
        rows, "_v", {"median": 0.5}, by=[item], max_groups=len(spec),
        extra=[F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean")],
    )
    return bins.join(F.broadcast(markers), item)  # at most one marker row per item of the spec


def stay_histogram(df: DataFrame, stay: str, width: float = 0.5, upper_q: float = 0.97) -> DataFrame:
    """Bins of fixed width from 0 while the bin starts below the upper quantile, with markers."""
    rows = df.where(F.col(stay) > 0).select(F.col(stay).cast("double").alias("_v"))
    marks = exact_quantiles(
        rows, "_v", {"median": 0.5, "p75": 0.75, "_upper": upper_q},
        extra=[F.avg("_v").alias("mean")],
    ).select(F.struct("median", "p75", "mean", "_upper").alias("_m")).scalar()
    bins = rows.groupBy((F.floor(F.col("_v") / F.lit(width)) * F.lit(width)).alias("bin_low")).agg(
        F.count(F.lit(1)).alias("bin_count")
    )
    return (
        bins.withColumn("_m", marks)
        .where(F.col("bin_low") < F.col("_m._upper"))
        .select("bin_low", "bin_count", "_m.median", "_m.mean", "_m.p75")
    )


def window_min_max_mean(events: DataFrame, entity: str, item: str, value: str) -> DataFrame:
    """Min, max and mean per entity and item."""
    return (
        events.where(F.col(entity).isNotNull() & F.col(item).isNotNull())
        .groupBy(entity, item)
        .agg(
            F.min(value).alias("value_min"),
            F.max(value).alias("value_max"),
            F.avg(value).alias("value_mean"),
        )
    )


def code_count(codes: DataFrame, entity: str, code: str, alias: str = "diag_count") -> DataFrame:
    """Non-missing codes per entity."""
    return codes.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(code).alias(alias))


def peak_by_subject(
    events: DataFrame, subject: str, item: str, value: str, code, alias: str = "peak"
) -> DataFrame:
    """Largest value of one item per subject."""
    return (
        events.where((F.col(item) == code) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.max(value).alias(alias))
    )


def nadir_by_subject(
    events: DataFrame, subject: str, item: str, value: str, code, alias: str = "nadir"
) -> DataFrame:
    """Smallest positive value of one item per subject."""
    return (
        events.where((F.col(item) == code) & (F.col(value) > 0) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.min(value).alias(alias))
    )


def baseline_peak_stats(
    events: DataFrame, subject: str, value: str, low: float = 0.0, high: float = 30.0
) -> DataFrame:
    """Baseline (own minimum), peak, ratio and rise per subject for values strictly inside the bounds."""
    return (
        events.where((F.col(value) > low) & (F.col(value) < high) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.min(value).alias("baseline"), F.max(value).alias("peak"))
        .withColumn("ratio", F.try_divide("peak", "baseline"))
        .withColumn("delta", F.col("peak") - F.col("baseline"))
    )


def peak_by_subject_item(events: DataFrame, subject: str, item: str, value: str) -> DataFrame:
    """Largest value per subject and item, long form."""
    return (
        events.where(F.col(subject).isNotNull() & F.col(item).isNotNull())
        .groupBy(subject, item)
        .agg(F.max(value).alias("peak"))
    )


def outcome_mean_peaks(
    peaks: DataFrame, outcomes: DataFrame, on: str, item: str, value: str, outcome: str
) -> DataFrame:
    """Mean peak per outcome and item; subjects without a known outcome drop."""
    return (
        peaks.join(outcomes.where(F.col(outcome).isNotNull()), on)
        .groupBy(outcome, item)
        .agg(F.avg(value).alias("mean_peak"), F.count(value).alias("n_subjects"))
    )


def class_distribution(df: DataFrame, cls: str, labels: Iterable | None = None) -> DataFrame:
    """Rows per class; with a label list the listed classes only."""
    rows = df.where(F.col(cls).isNotNull())
    if labels is not None:
        rows = rows.where(F.col(cls).isin(list(labels)))
    return rows.groupBy(cls).agg(F.count(F.lit(1)).alias("n")).orderBy(cls)


def unpivot_grades(df: DataFrame, id_col: str, cols: Iterable[str]) -> DataFrame:
    """Wide grade columns to (id, marker, grade) rows, missing grades left out."""
    return df.unpivot([id_col], list(cols), "marker", "grade").where(F.col("grade").isNotNull())


def grade_by_marker_counts(grades: DataFrame, id_col: str, markers: Iterable[str]) -> DataFrame:
    """Subjects per grade and marker over every grade that occurs, zeros included.

    One conditional count per marker and grade row, then back to long form.
    """
    markers = list(markers)
    long = unpivot_grades(grades, id_col, markers)
    per_grade = long.groupBy("grade").agg(
        *[F.count_if(F.col("marker") == m).alias(m) for m in markers]
    )
    return per_grade.unpivot(["grade"], markers, "marker", "n")


def signal_summary(df: DataFrame, flag: str) -> DataFrame:
    """Total, flagged rows and their share in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col(flag)).alias("n_flagged")
    ).withColumn("rate_pct", F.try_divide(F.col("n_flagged") * F.lit(100.0), F.col("n_total")))


def signal_members(df: DataFrame, flag: str, id_col: str) -> DataFrame:
    """The flagged ids in ascending order, one per row so that the list may be of any length."""
    return df.where(F.col(flag)).select(id_col).orderBy(id_col)


def outlier_outcome_count(outliers: DataFrame, outcome: str) -> DataFrame:
    """Number of listed subjects and of those with outcome 1."""
    return outliers.agg(
        F.count(F.lit(1)).alias("n_listed"), F.count_if(F.col(outcome) == 1).alias("n_deceased")
    )


def records_per_subject(events: DataFrame, subject: str, k: int = 4) -> DataFrame:
    """The k subjects with most rows."""
    return (
        events.where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), subject)
        .limit(k)
    )
