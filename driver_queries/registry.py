"""Registration of queries and the mapping of the star schema onto the clinical roles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent statement on the same tables."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, as the SQL side does."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) as `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Roles.  The tables hold no missing values, so some are derived from ordinary columns.

FLAG_SQL = "case o_orderstatus when 'F' then 1 when 'O' then 0 end"


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as encounters: an outcome flag that is missing for open orders."""
    flag = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").alias("admittime"),
        F.col("o_orderpriority").alias("admission_type"),
        flag.alias("flag"),
    )


ENCOUNTERS = f"""(select o_orderkey as hadm_id, o_custkey as subject_id, o_orderdate as admittime,
    o_orderpriority as admission_type, {FLAG_SQL} as flag from orders)"""


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as laboratory events: missing value without discount, error flag from the return flag."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_linenumber").alias("itemid"),
        F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("valuenum"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).alias("error"),
    )


LABS = """(select l_orderkey as hadm_id, l_linenumber as itemid, l_shipdate as charttime,
    case when l_discount <> 0 then l_extendedprice end as valuenum,
    case l_returnflag when 'R' then 1 when 'A' then 0 end as error from lineitem)"""


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as vital signs of a user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject_id"),
        F.col("event_type").alias("itemid"),
        F.col("ts").alias("charttime"),
        F.col("value").alias("valuenum"),
    )


VITALS = """(select user_id as subject_id, event_type as itemid, ts as charttime,
    value as valuenum from events)"""
VITAL_ITEMS = ("click", "error", "purchase", "signup", "view")


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipment as lengths of stay; some are negative."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderpriority").alias("unit"),
        (F.date_diff("l_shipdate", "o_orderdate") / F.lit(100.0)).alias("los"),
    )


STAYS = """(select o_orderkey as hadm_id, o_orderpriority as unit,
    cast(date_diff('day', o_orderdate, l_shipdate) as double) / 100.0 as los
    from lineitem join orders on l_orderkey = o_orderkey)"""


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands ordered, as diagnosis codes of the order; one brand is recorded as missing."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("hadm_id"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_brand")).alias("code"),
    )


CODES = """(select l_orderkey as hadm_id, case when p_brand <> 'Brand#7' then p_brand end as code
    from lineitem join part on l_partkey = p_partkey)"""

SCORE_TABLE = {
    "A": (1, ["Brand#1"]),
    "B": (2, ["Brand#2", "Brand#3"]),
    "C": (3, ["Brand#25"]),
    "D": (6, ["Brand#9"]),
}

LAB_NAMES = {i: f"lab{i}" for i in range(1, 8)}
LAB_WIDE = [f"lab{i}_{stat}" for i in range(1, 8) for stat in ("min", "max", "mean")]
WINDOW_HOURS = 365 * 24

WINDOW = f"""(select l.hadm_id, l.itemid, l.charttime, l.valuenum from {LABS} l
    join {ENCOUNTERS} e on l.hadm_id = e.hadm_id
    where l.charttime >= e.admittime and l.charttime <= e.admittime + interval 365 day)"""

WIDE = "(select hadm_id, " + ", ".join(
    f"{fn}(case when itemid = {i} then valuenum end) as lab{i}_{stat}"
    for i in range(1, 8)
    for fn, stat in (("min", "min"), ("max", "max"), ("avg", "mean"))
) + f" from {WINDOW} w group by hadm_id)"


def round_list(cols: list[str], digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in cols)
