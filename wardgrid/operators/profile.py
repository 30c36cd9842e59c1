"""Validation and health checks; each is one aggregation over its table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.operators.quantiles import exact_median
from wardgrid.sources.scan import require_columns


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table; Parquet counts come from file metadata."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def required_columns_check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise when a required column is absent, else report rows and missing values per column."""
    require_columns(df, schema.fieldNames())
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(c)).alias(f"_present_{c}") for c in schema.fieldNames()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("declared_type"),
                F.lit(df.schema[f.name].dataType.simpleString()).alias("actual_type"),
                F.col("n_rows"),
                (F.col("n_rows") - F.col(f"_present_{f.name}")).alias("n_missing"),
            )
            for f in schema.fields
        ]
    )
    return counted.select(F.inline(rows))


def flag_health(df: DataFrame, flag: str) -> DataFrame:
    """Total, missing flags, events after missing becomes 0, and the rate in percent."""
    filled = F.coalesce(F.col(flag), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col(flag).isNull()).alias("n_missing"),
        F.coalesce(F.sum(filled), F.lit(0)).cast("long").alias("n_positive"),
    ).withColumn("rate_pct", F.try_divide(F.col("n_positive") * F.lit(100.0), F.col("n_total")))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per category, most frequent first; a missing category is not counted."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), col)
    )


def stay_health(df: DataFrame, stay: str) -> DataFrame:
    """Row count and median stay."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "median_stay", exact_median(df, stay)
    )


def matrix_health(df: DataFrame, label: str, target: str, score: str, imputed: str) -> DataFrame:
    """Shape, label balance, target summary, mean score and number of imputed ages."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count_if(F.col(label) == 0).alias("n_negative"),
        (F.avg(label) * 100.0).alias("label_rate_pct"),
        F.avg(target).alias("mean_target"),
        F.max(target).alias("max_target"),
        F.avg(score).alias("mean_score"),
        F.coalesce(F.sum(imputed), F.lit(0)).cast("long").alias("n_imputed"),
    ).withColumn("median_target", exact_median(df, target))
