"""First rows, top-k and ordering.

De-duplication is one ``min_by`` per key, which combines on the map side: a task passes on one row per key,
so a subject that holds a third of the rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_row_per_key(df: DataFrame, key: str | list[str], order: Iterable[str]) -> DataFrame:
    """The earliest row of each key by the ordering columns (give a unique last column for ties).

    A missing value orders last, so an undated row is taken only where a key has no dated one; rows
    with a missing key are dropped.
    """
    keys, order = [key] if isinstance(key, str) else list(key), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    # Missing values order last; rows that tie in every ordering column are told apart by a hash of the other columns.
    place = [F.struct(F.col(c).isNull().alias("missing"), F.col(c).alias("value")) for c in order]
    tie = F.xxhash64(*[f"`{c}`" for c in rest]) if rest else F.lit(0).cast("long")
    first = F.min_by(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)]), F.struct(*place, tie))
    # Of itself min_by of rows sorts all rows of a task by key.  Beside an aggregate that Spark keeps as an object, here an always
    # empty set, a task hashes its rows and sorts only what comes once it has met many keys.
    nothing = F.collect_set(F.lit(None).cast("int")).alias("_nothing")
    kept = df.na.drop(subset=keys).groupBy(*keys).agg(first.alias("_first"), nothing).where(F.size("_nothing") == 0)
    return kept.select(*[F.col(f"_first.c{k}").alias(c) for k, c in enumerate(df.columns)])


def sort_rows(df: DataFrame, keys: Iterable) -> DataFrame:
    """Plain ordering."""
    return df.orderBy(*keys)


def top_outliers(outliers: DataFrame, subject: str = "subject_id", k: int = 20) -> DataFrame:
    """The k subjects with the largest absolute z-score; subjects without one come last."""
    return outliers.orderBy(F.col("max_abs_z").desc_nulls_last(), subject).limit(k)


def feature_top_n(importance: DataFrame, n: int = 15) -> DataFrame:
    """The n most important features."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def best_model(
    metrics: DataFrame, metric: str, maximise: bool = True, exclude: Iterable[str] = ()
) -> DataFrame:
    """The best row of a metrics table; ties go to the smaller model name."""
    order = F.col(metric).desc_nulls_last() if maximise else F.col(metric).asc_nulls_last()
    return metrics.where(~F.col("model").isin(list(exclude))).orderBy(order, "model").limit(1)


def representative_subjects(
    outliers: DataFrame,
    events: DataFrame,
    encounters: DataFrame,
    outcome: str,
    subject: str = "subject_id",
    per_group: int = 2,
    fallback: int = 4,
) -> DataFrame:
    """The first subjects of each outcome in a top-k outlier list.

    Open survivor slots are filled with the survivors that have most rows.  ``outliers`` is a top-k
    list (with ``max_abs_z``), so the ranking below only ever sees k + ``fallback`` rows.
    """
    listed = outliers.where(F.col(outcome).isin(0, 1)).select(
        subject, F.col(outcome).cast("int").alias("outcome_flag"), F.lit(0).alias("_source"),
        F.col("max_abs_z").alias("_weight"),
    )
    survivors = encounters.where(F.col(outcome) == 0).select(subject).distinct()
    counts = events.groupBy(subject).agg(F.count(F.lit(1)).alias("n"))
    busiest = (
        counts.join(survivors, subject, "left_semi")
        .orderBy(F.col("n").desc(), subject)
        .limit(fallback)
        .select(
            subject, F.lit(0).alias("outcome_flag"), F.lit(1).alias("_source"),
            F.col("n").cast("double").alias("_weight"),
        )
    )
    candidates = (
        listed.unionByName(busiest)
        .groupBy("outcome_flag", subject)
        .agg(F.min(F.struct("_source", (-F.col("_weight")).alias("_w"))).alias("_first"))
    )
    rank = W.partitionBy("outcome_flag").orderBy("_first", subject)
    return (
        candidates.withColumn("slot", F.row_number().over(rank))
        .where(F.col("slot") <= per_group)
        .select(
            subject,
            F.when(F.col("outcome_flag") == 0, "Survived").otherwise("Deceased").alias("outcome"),
            "slot",
        )
    )
