"""Weighted code-prefix score and threshold ladders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.config import (
    ALP_MULTIPLE,
    ALT_MULTIPLE,
    BILIRUBIN_MULTIPLE,
    BLOOD_LADDERS,
    BLOOD_MARKERS,
    COMORBIDITY_TABLE,
    ULN_ALP,
    ULN_ALT,
    ULN_BILIRUBIN,
)
from wardgrid.functions.sqltext import ident, literal, literals


def _starts_with_any(code: str, prefixes: Iterable[str]) -> str:
    """SQL text: the code starts with a listed prefix; one set lookup per prefix length."""
    by_length: dict[int, list[str]] = {}
    for prefix in prefixes:
        by_length.setdefault(len(prefix), []).append(prefix)
    return " or ".join(
        f"substring({code}, 1, {n}) in ({literals(group)})" for n, group in sorted(by_length.items())
    )


def prefix_match_score(
    codes: DataFrame,
    entity: str,
    code: str,
    table: Mapping[str, tuple[int, list[str]]] = COMORBIDITY_TABLE,
    hierarchy: Mapping[str, str] | None = None,
    alias: str = "score",
) -> DataFrame:
    """Sum of the weights of every category for which the entity has a matching code.

    A category counts once however many codes match, and mild and severe forms add up unless
    ``hierarchy`` (mild -> severe) says otherwise.  Entities whose codes match nothing, or are all
    missing, score 0; entities without code rows do not appear.

    The table is configuration, so it becomes one "any code matches" aggregate per category.  Rows
    collapse to one per entity on the map side: no code is multiplied, joined or de-duplicated.
    """
    text = f"trim(cast({ident(code)} as string))"
    hits = [
        F.expr(f"coalesce(bool_or({_starts_with_any(text, prefixes)}), false) as {ident(name)}")
        for name, (_, prefixes) in table.items()
    ]
    flags = codes.where(F.col(entity).isNotNull()).groupBy(entity).agg(*hits)
    stronger = hierarchy or {}
    points = [
        f"case when {ident(name)}"
        + (f" and not {ident(stronger[name])}" if name in stronger else "")
        + f" then {literal(weight)} else 0 end"
        for name, (weight, _) in table.items()
    ]
    return flags.selectExpr(ident(entity), f"cast({' + '.join(points)} as int) as {ident(alias)}")


def edish_quadrant(
    peaks: DataFrame,
    a: str,
    b: str,
    uln_a: float = ULN_ALT,
    uln_b: float = ULN_BILIRUBIN,
    x_a: float = ALT_MULTIPLE,
    x_b: float = BILIRUBIN_MULTIPLE,
) -> DataFrame:
    """Liver-safety quadrant from two peaks as multiples of their upper limits (strictly above)."""
    high_a, high_b = F.col("ratio_a") > x_a, F.col("ratio_b") > x_b
    quadrant = (
        F.when(high_a & high_b, "Hy's Law")
        .when(high_b, "Temple's Corollary")
        .when(high_a, "Hepatocellular")
        .otherwise("Normal")
    )
    return (
        peaks.withColumn("ratio_a", F.col(a) / F.lit(float(uln_a)))
        .withColumn("ratio_b", F.col(b) / F.lit(float(uln_b)))
        .withColumn("quadrant", quadrant)
        .withColumn("hys_law", F.col("quadrant") == "Hy's Law")
    )


def cholestasis_exclusion(
    quadrants: DataFrame, peaks: DataFrame, subject: str, peak: str, uln: float = ULN_ALP, multiple: float = ALP_MULTIPLE
) -> DataFrame:
    """Quadrant rows with the third peak: a case at ``multiple`` x its limit or more is cholestatic and no Hy's Law case.

    ``peaks`` has one row per subject; subjects without the third marker keep their quadrant.
    """
    third = peaks.select(subject, F.col(peak).alias("peak_c"))
    cholestatic = F.coalesce(F.col("peak_c") >= F.lit(float(uln * multiple)), F.lit(False))
    return (
        quadrants.join(third, subject, "left")
        .withColumn("ratio_c", F.col("peak_c") / F.lit(float(uln)))
        .withColumn("cholestatic", cholestatic)
        .withColumn("hys_law_confirmed", F.col("hys_law") & ~F.col("cholestatic"))
    )


def kdigo_stage(
    stats: DataFrame, peak_limit: float = 4.0, delta_limit: float = 0.3, alias: str = "stage"
) -> DataFrame:
    """Kidney injury stage 0-3 from baseline, peak, ratio and rise."""
    ratio = F.col("ratio")
    stage = (
        F.when((ratio >= 3.0) | (F.col("peak") >= peak_limit), 3)
        .when(ratio >= 2.0, 2)
        .when((ratio >= 1.5) | (F.col("delta") >= delta_limit), 1)
        .otherwise(0)
    )
    return stats.withColumn(alias, stage)


def _grade(value: Column, ladder: Iterable[tuple[int, float]], mode: str) -> Column:
    # Documented: the lowest threshold carries the highest grade.  As coded: the grades are swapped
    # and the widest threshold is tried first, so only the highest grade can ever be given.
    ladder = sorted(ladder, key=lambda step: step[1])
    if mode == "as_coded":
        grades = sorted(grade for grade, _ in ladder)
        thresholds = [threshold for _, threshold in ladder]
        ladder = list(zip(grades, thresholds))[::-1]
    first, *rest = ladder
    chain = F.when(value < first[1], first[0])
    for grade, threshold in rest:
        chain = chain.when(value < threshold, grade)
    return chain.when(value > 0, 0)


def ctcae_grade(
    nadirs: DataFrame,
    marker: str,
    value: str,
    ladder: Mapping[str, Iterable[tuple[int, float]]] = BLOOD_LADDERS,
    mode: str = "as_documented",
    alias: str = "grade",
) -> DataFrame:
    """Toxicity grade of each nadir by its marker's ladder; 0 when no threshold is undercut."""
    column = F.lit(None).cast("int")
    for name, steps in ladder.items():
        column = F.when(F.col(marker) == name, _grade(F.col(value), steps, mode)).otherwise(column)
    return nadirs.withColumn(alias, column)


def blood_grades_wide(
    events: DataFrame,
    subject: str,
    item: str,
    value: str,
    markers: Mapping[object, str] = BLOOD_MARKERS,
    ladder: Mapping[str, Iterable[tuple[int, float]]] = BLOOD_LADDERS,
    mode: str = "as_documented",
) -> DataFrame:
    """Nadir and grade of every marker per subject in one aggregation."""
    nadirs = (
        events.where(F.col(item).isin(list(markers)) & (F.col(value) > 0) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            *[
                F.min(F.when(F.col(item) == code, F.col(value))).alias(f"{name}_nadir")
                for code, name in markers.items()
            ]
        )
    )
    return nadirs.withColumns(
        {
            f"{name}_grade": _grade(F.col(f"{name}_nadir"), ladder[name], mode)
            for name in markers.values()
        }
    )
