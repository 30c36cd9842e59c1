"""Joins.  All are equi joins; an interval is only ever a residual predicate on an equi key.

Hot keys are left to AQE: ``wardgrid.prepare`` switches on skew splitting even where a later
aggregation would reuse the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.operators.ranking import first_row_per_key

Keys = str | list[str]


def _keys(on: Keys) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_subject_demographics(encounters: DataFrame, subjects: DataFrame, on: Keys) -> DataFrame:
    """Encounters with their subject's columns; encounters without a subject stay."""
    return encounters.join(subjects, _keys(on), "left")


def join_code_titles(codes: DataFrame, titles: DataFrame, on: Keys) -> DataFrame:
    """Coded rows with the lookup title; codes without a title stay."""
    return codes.join(titles, _keys(on), "left")


def anchored_window_join(
    events: DataFrame,
    anchors: DataFrame,
    on: Keys,
    event_ts: str,
    anchor_ts: str,
    start_hours: float = 0.0,
    end_hours: float = 24.0,
) -> DataFrame:
    """Events that fall between start and end after their entity's anchor, both ends included.

    ``anchors`` has one row per entity.  The bounds are compared as timestamps, so no per-row
    conversion is needed and the inner join drops events without an anchor.
    """
    first = F.col(anchor_ts) + F.lit(timedelta(hours=start_hours))
    last = F.col(anchor_ts) + F.lit(timedelta(hours=end_hours))
    keyed = anchors.where(F.col(anchor_ts).isNotNull())
    return events.join(keyed, _keys(on)).where((F.col(event_ts) >= first) & (F.col(event_ts) <= last))


def assemble_features(
    base: DataFrame, parts: Iterable[DataFrame], on: Keys | list[Keys], zero_fill: Iterable[str] = ()
) -> DataFrame:
    """Base rows with every part attached; ``on`` is one key or one key per part.

    Parts are unique on their key, so each left join keeps the base grain.
    """
    parts = list(parts)
    keys = on if isinstance(on, list) and len(on) == len(parts) else [on] * len(parts)
    wide = base
    for part, key in zip(parts, keys):
        wide = wide.join(part, _keys(key), "left")
    zeros = {c: 0 for c in zero_fill}
    return wide.fillna(zeros) if zeros else wide


def outer_align(parts: Iterable[DataFrame], on: Keys) -> DataFrame:
    """Full outer alignment of per-signal tables on their entity key."""
    return reduce(lambda a, b: a.join(b, _keys(on), "full_outer"), parts)


def inner_peaks(
    events: DataFrame, subject: str, item: str, value: str, item_a, item_b,
    a: str = "peak_a", b: str = "peak_b",
) -> DataFrame:
    """Peak of two items per subject, for subjects that have both.

    One conditional aggregation replaces two group-bys and a join.
    """
    peaks = (
        events.where(F.col(item).isin(item_a, item_b) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            F.max(F.when(F.col(item) == item_a, F.col(value))).alias(a),
            F.max(F.when(F.col(item) == item_b, F.col(value))).alias(b),
        )
    )
    return peaks.where(F.col(a).isNotNull() & F.col(b).isNotNull())


def join_safety_profile(
    quadrants: DataFrame, stages: DataFrame, grades: DataFrame, on: Keys
) -> DataFrame:
    """Liver quadrant rows with kidney stage and blood grades where the subject has them."""
    return quadrants.join(stages, _keys(on), "left").join(grades, _keys(on), "left")


def join_first_outcome(
    subjects: DataFrame,
    encounters: DataFrame,
    on: str,
    order: Iterable[str],
    outcome: str,
    mode: str = "first",
) -> DataFrame:
    """Subjects with their outcome: that of the first encounter, or 1 if ``any`` encounter had it."""
    if mode == "any":
        outcomes = encounters.groupBy(on).agg(F.max(outcome).alias(outcome))
    else:
        order = list(order)
        narrow = encounters.select(*dict.fromkeys([on, *order, outcome]))
        outcomes = first_row_per_key(narrow, on, order).select(on, outcome)
    return subjects.join(outcomes, on, "left")


def semi_membership(df: DataFrame, col: str, values: DataFrame | Iterable) -> DataFrame:
    """Keep rows whose key is in a literal list or in another table's column of the same name."""
    if isinstance(values, DataFrame):
        return df.join(values.select(col), col, "left_semi")
    return df.where(F.col(col).isin(list(values)))
