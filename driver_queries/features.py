"""The assembled feature matrix on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    ENCOUNTERS,
    LAB_WIDE,
    SCORE_TABLE,
    WIDE,
    codes,
    encounters,
    query,
    rounded,
    table,
)
from driver_queries.reshape import _MEDIANS, lab_wide
from driver_queries.safety import SCORES_SQL
from wardgrid.functions.columns import fill_flag, one_hot_fixed, safe_age
from wardgrid.operators.impute import median_impute
from wardgrid.operators.joins import assemble_features, join_subject_demographics
from wardgrid.operators.scoring import prefix_match_score
from wardgrid.session import staged

TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
IDS = ["hadm_id", "subject_id", "admittime"]


def order_matrix(spark, sf):
    """One row per order: label, age, category indicators, score and imputed window statistics.

    The customer's first order stands in for the birth date.
    """
    visits = encounters(spark, sf)
    births = visits.groupBy("subject_id").agg(F.min("admittime").alias("dob"))
    joined = join_subject_demographics(visits, births, "subject_id")
    age, imputed = safe_age("admittime", "dob", cutoff="1996-01-01")
    base = one_hot_fixed(
        joined.withColumns({"flag": fill_flag("flag"), "age": age, "age_imputed": imputed}),
        "admission_type", TYPES, prefix="type",
    ).drop("admission_type", "dob")
    person = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_acctbal").alias("balance")
    )
    score = prefix_match_score(codes(spark, sf), "hadm_id", "code", SCORE_TABLE, alias="comorbidity")
    statistics = median_impute(staged(lab_wide(spark, sf), "lab-windows"), LAB_WIDE)
    return assemble_features(
        base, [person, score, statistics], ["subject_id", "hadm_id", "hadm_id"], zero_fill=["comorbidity"]
    ).select(
        *IDS, "flag", "age", "age_imputed", *[f"type_{t}" for t in TYPES], "balance", "comorbidity", *LAB_WIDE
    )


@query(
    "admission_matrix",
    f"""with w as (select * from {WIDE} x), m as (select * from {_MEDIANS} y),
    i as (select w.hadm_id, """
    + ", ".join(f"coalesce(w.{c}, m.{c}) as {c}" for c in LAB_WIDE)
    + f""" from w cross join m),
    d as (select subject_id, min(admittime) as dob from {ENCOUNTERS} e group by subject_id)
    select e.hadm_id, e.subject_id, e.admittime, coalesce(e.flag, 0) as flag,
      round(case when dob >= timestamp '1996-01-01' then date_diff('day', dob, e.admittime) / 365.25
        else 91.0 end, 4) as age,
      case when dob >= timestamp '1996-01-01' then 0 else 1 end as age_imputed, """
    + ", ".join(f"case when admission_type = '{t}' then 1 else 0 end as \"type_{t}\"" for t in TYPES)
    + ", round(c_acctbal, 4) as balance, coalesce(s.score, 0) as comorbidity, "
    + ", ".join(f"round(i.{c}, 4) as {c}" for c in LAB_WIDE)
    + f""" from {ENCOUNTERS} e left join d on e.subject_id = d.subject_id
    left join customer c on e.subject_id = c.c_custkey
    left join {SCORES_SQL} s on e.hadm_id = s.hadm_id left join i on e.hadm_id = i.hadm_id""",
)
def _(spark, sf):
    return rounded(order_matrix(spark, sf), 4)
