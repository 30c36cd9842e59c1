"""Long to wide, wide to long, appending and projecting."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import ident, literal, literals

_STATS = {"min": "min", "max": "max", "mean": "avg"}


def _codes_by_name(names: Mapping) -> dict[str, list]:
    grouped: dict[str, list] = {}
    for code, name in names.items():
        grouped.setdefault(name, []).append(code)
    return grouped


def pivot_stats_wide(
    events: DataFrame,
    entity: str,
    item: str,
    value: str,
    names: Mapping[object, str],
    stats: Iterable[str] = ("min", "max", "mean"),
) -> DataFrame:
    """One row per entity with ``{signal}_{stat}`` columns; several codes may share a signal.

    A single conditional aggregation: rows combine on the map side and are shuffled once.  Entities
    with at least one row of any listed item are kept, even if every value is missing.
    """
    stats = list(stats)
    columns = []
    for name, codes in _codes_by_name(names).items():
        picked = f"case when {ident(item)} in ({literals(codes)}) then {ident(value)} end"
        columns += [F.expr(f"{_STATS[stat]}({picked}) as {ident(f'{name}_{stat}')}") for stat in stats]
    return (
        events.where(F.col(item).isin(list(names)) & F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(*columns)
    )


def pivot_peak_matrix(
    events: DataFrame, subject: str, item: str, value: str, names: Mapping[object, str]
) -> DataFrame:
    """Peak of each listed item per subject, one column per item."""
    return (
        events.where(F.col(item).isin(list(names)) & F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            *[
                F.expr(
                    f"max(case when {ident(item)} = {literal(code)} then {ident(value)} end) as {ident(n)}"
                )
                for code, n in names.items()
            ]
        )
    )


def min_non_null(df: DataFrame, cols: Iterable[str], n: int = 3) -> DataFrame:
    """Keep rows with at least n present values among the columns."""
    return df.na.drop(thresh=n, subset=list(cols))


def append_rows(parts: Iterable[DataFrame]) -> DataFrame:
    """Rows of all parts, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def project_columns(
    df: DataFrame,
    keep: Iterable[str] | None = None,
    drop: Iterable[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep, drop and rename columns, in that order."""
    out = df.select(*keep) if keep is not None else df
    return out.drop(*drop).withColumnsRenamed(dict(rename or {}))
