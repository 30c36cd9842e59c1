"""Filling missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import ident
from wardgrid.operators.quantiles import column_quantiles


def column_medians(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row holding the exact median of every column, all computed in the same two passes."""
    return column_quantiles(df, cols, 0.5)


def median_impute(
    df: DataFrame,
    cols: Iterable[str],
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Fill each column with its own exact median, taken before any filling.

    ``fit_on`` supplies the rows the medians come from, e.g. the training part only.  The medians
    arrive as one scalar subquery.  The frame is read three times, so stage it first when it is the
    result of heavy joins.
    """
    cols = list(cols)
    medians = column_medians(fit_on if fit_on is not None else df, cols)
    filled = df.withColumn("_medians", medians.select(F.struct(*cols).alias("_medians")).scalar())
    return filled.selectExpr(
        *[
            f"coalesce(cast({ident(c)} as double), _medians.{ident(c)}) as {ident(c)}"
            if c in cols
            else ident(c)
            for c in df.columns
        ]
    )


def residual_impute(
    df: DataFrame,
    cols: Iterable[str],
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """The second fill, over the joined matrix: rows without any in-window data are filled here."""
    return median_impute(df, cols, fit_on)


def zero_fill(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Missing scores and counts become 0."""
    return df.fillna({c: 0 for c in cols})
