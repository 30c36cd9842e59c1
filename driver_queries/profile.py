"""Validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.registry import ENCOUNTERS, STAYS, encounters, query, rounded, stays, table
from wardgrid.operators import profile
from wardgrid.session import staged

COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_row_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows, "
        f"(select cast(count(*) as integer) from (describe {t})) as n_columns from {t}"
        for t in COUNTED
    ),
)
def _(spark, sf):
    return profile.table_row_counts({t: table(spark, sf, t) for t in COUNTED})


REQUIRED = T.StructType(
    [
        T.StructField("hadm_id", T.LongType()),
        T.StructField("admittime", T.TimestampType()),
        T.StructField("flag", T.IntegerType()),
    ]
)


@query(
    "required_columns_check",
    " union all ".join(
        f"select '{c}' as column_name, '{d}' as declared_type, '{a}' as actual_type, "
        f"count(*) as n_rows, count(*) - count({c}) as n_missing from {ENCOUNTERS} e"
        for c, d, a in (
            ("hadm_id", "bigint", "bigint"),
            ("admittime", "timestamp", "timestamp_ntz"),
            ("flag", "int", "int"),
        )
    ),
)
def _(spark, sf):
    return profile.required_columns_check(encounters(spark, sf), REQUIRED)


@query(
    "flag_health",
    "select count(*) as n_total, count(*) - count(flag) as n_missing, "
    "cast(sum(coalesce(flag, 0)) as bigint) as n_positive, "
    f"round(sum(coalesce(flag, 0)) * 100.0 / nullif(count(*), 0), 6) as rate_pct from {ENCOUNTERS} e",
)
def _(spark, sf):
    return rounded(profile.flag_health(encounters(spark, sf), "flag"))


@query(
    "category_counts",
    f"select admission_type, count(*) as n from {ENCOUNTERS} e where admission_type is not null "
    "group by admission_type",
)
def _(spark, sf):
    return profile.category_counts(encounters(spark, sf), "admission_type")


@query(
    "stay_health",
    f"select count(*) as n_rows, round(median(los), 6) as median_stay from {STAYS} s",
)
def _(spark, sf):
    return rounded(profile.stay_health(staged(stays(spark, sf)), "los"))


@query(
    "matrix_health",
    """select count(*) as n_rows, cast(4 as integer) as n_columns,
    count(*) filter (where label = 1) as n_positive, count(*) filter (where label = 0) as n_negative,
    round(avg(label) * 100.0, 6) as label_rate_pct, round(avg(target), 4) as mean_target,
    max(target) as max_target, round(avg(score), 6) as mean_score,
    cast(sum(imputed) as bigint) as n_imputed, round(median(target), 4) as median_target
    from (select case l_returnflag when 'R' then 1 else 0 end as label, l_extendedprice as target,
    l_quantity as score, case when l_shipdate < timestamp '1996-01-01' then 1 else 0 end as imputed
    from lineitem) m""",
)
def _(spark, sf):
    matrix = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_extendedprice").alias("target"),
        F.col("l_quantity").alias("score"),
        (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).cast("int").alias("imputed"),
    )
    health = profile.matrix_health(matrix, "label", "target", "score", "imputed")
    return health.select(
        "n_rows", "n_columns", "n_positive", "n_negative", F.round("label_rate_pct", 6).alias("label_rate_pct"),
        F.round("mean_target", 4).alias("mean_target"), "max_target",
        F.round("mean_score", 6).alias("mean_score"), "n_imputed",
        F.round("median_target", 4).alias("median_target"),
    )
