"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.registry import LABS, labs, query, table
from wardgrid.session import staging_path
from wardgrid.sources.scan import (
    read_feature_matrix,
    scan_filtered_events,
    scan_table,
    scan_valid_measurements,
)
from wardgrid.sources.sinks import write_feature_matrix

LINE_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ]
)


@query(
    "scan_table",
    "select l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_returnflag from lineitem",
)
def _(spark, sf):
    return scan_table(spark, f"{sf}/lineitem.parquet", LINE_SCHEMA)


@query(
    "scan_filtered_events",
    f"select hadm_id, itemid, charttime, valuenum from {LABS} l "
    "where itemid in (1, 3, 5) and (error is null or error = 0)",
)
def _(spark, sf):
    kept = scan_filtered_events(labs(spark, sf), "itemid", [1, 3, 5], "error")
    return kept.select("hadm_id", "itemid", "charttime", "valuenum")


@query(
    "scan_valid_measurements",
    "select l_orderkey, l_linenumber, valuenum from (select l_orderkey, l_linenumber, "
    "case when l_discount <> 0 then l_extendedprice - 30000.0 end as valuenum from lineitem) v "
    "where valuenum > 0",
)
def _(spark, sf):
    shifted = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice") - F.lit(30000.0)).alias("valuenum"),
    )
    return scan_valid_measurements(shifted, "valuenum")


MATRIX_SQL = "select l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice from lineitem"
MATRIX_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("read_feature_matrix", MATRIX_SQL)
def _(spark, sf):
    return read_feature_matrix(spark, f"{sf}/lineitem.parquet", "l_extendedprice", MATRIX_IDS).data


@query("write_feature_matrix", MATRIX_SQL)
def _(spark, sf):
    matrix = read_feature_matrix(spark, f"{sf}/lineitem.parquet", "l_extendedprice", MATRIX_IDS)
    path = write_feature_matrix(matrix.data, staging_path(spark, "matrix"))
    return read_feature_matrix(spark, path, matrix.target, []).data
