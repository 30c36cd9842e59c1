"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    CODES,
    ENCOUNTERS,
    LABS,
    VITALS,
    WINDOW_HOURS,
    codes,
    encounters,
    labs,
    query,
    rounded,
    table,
    vitals,
)
from driver_queries.safety import GRADES_SQL, QUADRANTS_SQL, STAGES_SQL, grades, quadrants, stages
from wardgrid.functions.columns import outcome_label
from wardgrid.operators import joins as J
from wardgrid.operators.aggregates import peak_by_subject


@query(
    "join_subject_demographics",
    f"select hadm_id, e.subject_id, c_mktsegment as gender from {ENCOUNTERS} e left join "
    "(select c_custkey as subject_id, case when c_nationkey < 20 then c_mktsegment end as c_mktsegment from customer) c "
    "on e.subject_id = c.subject_id",
)
def _(spark, sf):
    gender = F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment"))
    subjects = table(spark, sf, "customer").select(F.col("c_custkey").alias("subject_id"), gender.alias("gender"))
    return J.join_subject_demographics(
        encounters(spark, sf).select("hadm_id", "subject_id"), subjects, "subject_id"
    ).select("hadm_id", "subject_id", "gender")


@query(
    "join_code_titles",
    "select l_orderkey, l_partkey as code, p_name as title from lineitem left join "
    "(select p_partkey, case when p_size < 25 then p_name end as p_name from part) t on l_partkey = p_partkey",
)
def _(spark, sf):
    coded = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("code"))
    title = F.when(F.col("p_size") < 25, F.col("p_name")).alias("title")
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("code"), title)
    return J.join_code_titles(coded, titles, "code").select("l_orderkey", "code", "title")


@query(
    "anchored_window_join",
    f"select l.hadm_id, l.itemid, l.charttime, l.valuenum from {LABS} l join {ENCOUNTERS} e "
    "on l.hadm_id = e.hadm_id where l.charttime >= e.admittime "
    "and l.charttime <= e.admittime + interval 365 day",
)
def _(spark, sf):
    anchors = encounters(spark, sf).select("hadm_id", "admittime")
    inside = J.anchored_window_join(
        labs(spark, sf), anchors, "hadm_id", "charttime", "admittime", 0, WINDOW_HOURS
    )
    return inside.select("hadm_id", "itemid", "charttime", "valuenum")


@query(
    "anchored_window_join_first_event",
    f"with v as (select * from {VITALS} e), a as (select subject_id, min(charttime) as t0 from v "
    "group by subject_id) select v.subject_id, itemid, charttime, valuenum from v join a "
    "on v.subject_id = a.subject_id where charttime >= t0 and charttime <= t0 + interval 24 hour",
)
def _(spark, sf):
    events = vitals(spark, sf)
    anchors = events.groupBy("subject_id").agg(F.min("charttime").alias("t0"))
    inside = J.anchored_window_join(events, anchors, "subject_id", "charttime", "t0")
    return inside.select("subject_id", "itemid", "charttime", "valuenum")


@query(
    "assemble_features",
    f"""select e.hadm_id, e.subject_id, c.c_mktsegment as segment,
    coalesce(k.n_codes, 0) as n_codes, round(q.mean_quantity, 6) as mean_quantity
    from {ENCOUNTERS} e
    left join customer c on e.subject_id = c.c_custkey
    left join (select hadm_id, count(code) as n_codes from {CODES} d group by hadm_id) k
      on e.hadm_id = k.hadm_id
    left join (select l_orderkey, avg(l_quantity) as mean_quantity from lineitem
      group by l_orderkey) q on e.hadm_id = q.l_orderkey""",
)
def _(spark, sf):
    person = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("segment")
    )
    counts = codes(spark, sf).groupBy("hadm_id").agg(F.count("code").alias("n_codes"))
    quantity = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("hadm_id"))
        .agg(F.avg("l_quantity").alias("mean_quantity"))
    )
    wide = J.assemble_features(
        encounters(spark, sf).select("hadm_id", "subject_id"),
        [person, counts, quantity],
        ["subject_id", "hadm_id", "hadm_id"],
        zero_fill=["n_codes"],
    )
    return rounded(wide.select("hadm_id", "subject_id", "segment", "n_codes", "mean_quantity"))


@query(
    "outer_align",
    f"""with c as (select subject_id, max(valuenum) as click_peak from {VITALS} v
      where itemid = 'click' group by subject_id),
    e as (select subject_id, max(valuenum) as error_peak from {VITALS} v
      where itemid = 'error' group by subject_id)
    select coalesce(c.subject_id, e.subject_id) as subject_id, click_peak, error_peak
    from c full outer join e on c.subject_id = e.subject_id""",
)
def _(spark, sf):
    events = vitals(spark, sf)
    parts = [
        peak_by_subject(events, "subject_id", "itemid", "valuenum", item, f"{item}_peak")
        for item in ("click", "error")
    ]
    return J.outer_align(parts, "subject_id")


@query(
    "inner_peaks",
    f"select subject_id, max(valuenum) filter (where itemid = 'click') as peak_a, "
    f"max(valuenum) filter (where itemid = 'error') as peak_b from {VITALS} v "
    "group by subject_id having peak_a is not null and peak_b is not null",
)
def _(spark, sf):
    return J.inner_peaks(vitals(spark, sf), "subject_id", "itemid", "valuenum", "click", "error")


@query(
    "join_safety_profile",
    f"select q.subject_id, q.quadrant, k.stage, g.click_grade, g.error_grade from {QUADRANTS_SQL} q "
    f"left join {STAGES_SQL} k on q.subject_id = k.subject_id "
    f"left join {GRADES_SQL} g on q.subject_id = g.subject_id",
)
def _(spark, sf):
    profile = J.join_safety_profile(
        quadrants(spark, sf), stages(spark, sf), grades(spark, sf), "subject_id"
    )
    return profile.select("subject_id", "quadrant", "stage", "click_grade", "error_grade")


@query(
    "join_first_outcome",
    f"""select c.c_custkey as subject_id,
    case f.flag when 0 then 'Survived' when 1 then 'Deceased' end as outcome from customer c left join (
      select subject_id, flag from {ENCOUNTERS} e
      qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1) f
    on c.c_custkey = f.subject_id""",
)
def _(spark, sf):
    subjects = table(spark, sf, "customer").select(F.col("c_custkey").alias("subject_id"))
    joined = J.join_first_outcome(
        subjects, encounters(spark, sf), "subject_id", ["admittime", "hadm_id"], "flag"
    )
    return joined.select("subject_id", outcome_label("flag").alias("outcome"))


@query(
    "join_any_outcome",
    "select c.c_custkey as subject_id, case f.flag when 0 then 'Survived' when 1 then 'Deceased' end "
    "as outcome from customer c left join (select subject_id, "
    f"max(flag) as flag from {ENCOUNTERS} e group by subject_id) f on c.c_custkey = f.subject_id",
)
def _(spark, sf):
    subjects = table(spark, sf, "customer").select(F.col("c_custkey").alias("subject_id"))
    joined = J.join_first_outcome(
        subjects, encounters(spark, sf), "subject_id", ["admittime"], "flag", mode="any"
    )
    return joined.select("subject_id", outcome_label("flag").alias("outcome"))


@query(
    "semi_membership",
    "select o_orderkey, o_custkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH') "
    "and o_custkey in (select c_custkey from customer where c_acctbal > 0)",
)
def _(spark, sf):
    urgent = J.semi_membership(
        table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )
    solvent = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("o_custkey")
    )
    return J.semi_membership(urgent, "o_custkey", solvent).select("o_orderkey", "o_custkey")
