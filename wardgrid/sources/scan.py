"""Table scans: projection by name, declared types, filters that reach the file scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.sources.schemas import TABLES


class FeatureMatrix(NamedTuple):
    """A feature matrix with its label column and the list of feature columns."""

    data: DataFrame
    features: list[str]
    target: str


def _nan_to_null(df: DataFrame) -> DataFrame:
    # Spark orders NaN above every number, so a missing measurement must be NULL before any filter.
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not doubles:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def scan_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Iterable[str] | None = None,
    fmt: str | None = None,
) -> DataFrame | None:
    """Scan a CSV or Parquet table, keep the named columns with their declared types.

    Columns are matched by name whatever their position in the file; NaN is read as NULL in every format.
    A missing path gives ``None``.
    """
    fmt = fmt or ("csv" if path.lower().split("?")[0].endswith((".csv", ".csv.gz")) else "parquet")
    try:
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        raw = reader.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise
    wanted = list(columns) if columns is not None else (schema.fieldNames() if schema else raw.columns)
    if schema is None:
        return _nan_to_null(raw.select(*wanted))
    require_columns(raw, wanted)
    typed = raw.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in wanted])
    return _nan_to_null(typed)


def load_tables(
    spark: SparkSession,
    base: str,
    fmt: str = "csv",
    names: Iterable[str] | None = None,
    schemas: Mapping[str, T.StructType] = TABLES,
) -> dict[str, DataFrame]:
    """Scan every registered table found below ``base``; tables without a file are left out."""
    tables = {}
    for name in names or schemas:
        table = scan_table(spark, f"{base.rstrip('/')}/{name}.{fmt}", schemas[name], fmt=fmt)
        if table is not None:
            tables[name] = table
    return tables


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise when a required column is absent."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in names if c.lower() not in present]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def scan_filtered_events(
    df: DataFrame, item_col: str, items: Iterable, error_col: str | None = None
) -> DataFrame:
    """Keep the target items and drop rows flagged as errors (flag NULL or 0 is fine).

    A stateless filter: it reaches the Parquet scan and works unchanged on a streaming DataFrame.
    """
    kept = df.where(F.col(item_col).isin(list(items)))
    if error_col is not None:
        kept = kept.where(F.col(error_col).isNull() | (F.col(error_col) == 0))
    return kept


def scan_valid_measurements(df: DataFrame, value_col: str) -> DataFrame:
    """Keep rows whose value is present and above zero."""
    value = F.col(value_col)
    return df.where((value > 0) & ~F.isnan(value))


def feature_columns(df: DataFrame, target: str, drop: Iterable[str]) -> list[str]:
    """Every column that is neither the target nor an excluded id or time column."""
    excluded = set(drop) | {target}
    return [c for c in df.columns if c not in excluded]


def read_feature_matrix(
    spark: SparkSession,
    path: str,
    target: str,
    drop: Iterable[str],
    schema: T.StructType | None = None,
    fmt: str | None = None,
) -> FeatureMatrix:
    """Read a stored matrix and separate features from ids and label by an exclusion list."""
    data = scan_table(spark, path, schema, fmt=fmt)
    if data is None:
        raise FileNotFoundError(path)
    features = feature_columns(data, target, drop)
    return FeatureMatrix(data.select(*features, target), features, target)
