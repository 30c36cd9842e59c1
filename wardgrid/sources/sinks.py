"""Writers for feature matrices and model results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_feature_matrix(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a feature matrix as Parquet or as CSV with a header; returns the path."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_model_results(results: Mapping[str, DataFrame | PipelineModel], path: str) -> str:
    """Write each result below ``path``: DataFrames as Parquet, fitted pipelines with their own writer."""
    for name, result in results.items():
        target = f"{path.rstrip('/')}/{name}"
        if isinstance(result, DataFrame):
            result.write.mode("overwrite").parquet(target)
        else:
            result.write().overwrite().save(target)
    return path
