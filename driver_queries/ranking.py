"""Sorting, top-k, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    ENCOUNTERS,
    VITAL_ITEMS,
    VITALS,
    encounters,
    query,
    rounded,
    table,
    vitals,
)
from driver_queries.statistics import OUTLIERS_SQL, listed_outliers, vital_peaks
from wardgrid.operators import ranking as K
from wardgrid.operators.aggregates import outlier_outcome_count
from wardgrid.operators.statistics import extreme_item


@query(
    "first_row_per_key",
    f"select subject_id, hadm_id, admittime, admission_type from {ENCOUNTERS} e "
    "qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1",
)
def _(spark, sf):
    rows = encounters(spark, sf).select("subject_id", "hadm_id", "admittime", "admission_type")
    return K.first_row_per_key(rows, "subject_id", ["admittime", "hadm_id"])


@query(
    "sort_rows",
    f"select subject_id, itemid, charttime, valuenum from {VITALS} v",
)
def _(spark, sf):
    return K.sort_rows(vitals(spark, sf), ["subject_id", "charttime", "itemid"])


@query(
    "top_outliers",
    f"select subject_id, round(max_abs_z, 6) as max_abs_z, extreme_item from {OUTLIERS_SQL} z "
    "order by z.max_abs_z desc nulls last, subject_id limit 20",
)
def _(spark, sf):
    return rounded(listed_outliers(spark, sf))


@query("extreme_item", f"select subject_id, extreme_item from {OUTLIERS_SQL} z")
def _(spark, sf):
    return extreme_item(vital_peaks(spark, sf), "subject_id", "itemid", "peak", VITAL_ITEMS)


SUBJECT_FLAG_SQL = """(select c_custkey as subject_id, case when c_acctbal < 3000 then 1
    when c_acctbal < 8000 then 0 end as flag from customer)"""


def _subject_flags(spark, sf):
    flag = F.when(F.col("c_acctbal") < 3000, 1).when(F.col("c_acctbal") < 8000, 0)
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("subject_id"), flag.alias("flag")
    )


_LISTED_SQL = f"""(select z.subject_id, z.max_abs_z, f.flag from (select * from {OUTLIERS_SQL} o
    order by max_abs_z desc nulls last, subject_id limit 20) z
    left join {SUBJECT_FLAG_SQL} f on z.subject_id = f.subject_id)"""


def _listed(spark, sf):
    return listed_outliers(spark, sf).join(_subject_flags(spark, sf), "subject_id", "left")


@query(
    "outlier_outcome_count",
    f"select count(*) as n_listed, count(*) filter (where flag = 1) as n_deceased from {_LISTED_SQL} l",
)
def _(spark, sf):
    return outlier_outcome_count(_listed(spark, sf), "flag")


@query(
    "representative_subjects",
    f"""with l as (select * from {_LISTED_SQL} x),
    b as (select v.subject_id, count(*) as n from {VITALS} v join {SUBJECT_FLAG_SQL} f
      on v.subject_id = f.subject_id where f.flag = 0 group by v.subject_id
      order by n desc, v.subject_id limit 4),
    c as (select subject_id, flag, 0 as source, max_abs_z as weight from l where flag is not null
      union all select subject_id, 0, 1, n from b
        where subject_id not in (select subject_id from l where flag = 0)),
    r as (select subject_id, flag, row_number() over (partition by flag
      order by source, weight desc, subject_id) as slot from c)
    select subject_id, case flag when 0 then 'Survived' else 'Deceased' end as outcome,
      cast(slot as integer) as slot from r where slot <= 2""",
)
def _(spark, sf):
    return K.representative_subjects(
        _listed(spark, sf), vitals(spark, sf), _subject_flags(spark, sf), "flag"
    )


_MODELS_SQL = """(select l_returnflag as model, round(avg(abs(l_quantity * 1500.0 - l_extendedprice)), 4)
    as mae, round(avg(l_discount), 6) as auroc from lineitem group by l_returnflag)"""


def _model_metrics(spark, sf):
    error = F.abs(F.col("l_quantity") * F.lit(1500.0) - F.col("l_extendedprice"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(
        F.round(F.avg(error), 4).alias("mae"), F.round(F.avg("l_discount"), 6).alias("auroc")
    )


@query(
    "best_model",
    f"select model, mae, auroc from {_MODELS_SQL} m order by auroc desc, model limit 1",
)
def _(spark, sf):
    return K.best_model(_model_metrics(spark, sf), "auroc")


@query(
    "best_model_excluding_baseline",
    f"select model, mae, auroc from {_MODELS_SQL} m where model <> 'A' order by mae, model limit 1",
)
def _(spark, sf):
    return K.best_model(_model_metrics(spark, sf), "mae", maximise=False, exclude=["A"])
