"""Descriptive aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    CODES,
    ENCOUNTERS,
    STAYS,
    VITALS,
    WINDOW,
    WINDOW_HOURS,
    codes,
    encounters,
    labs,
    query,
    rounded,
    stays,
    table,
    vitals,
)
from wardgrid.operators import aggregates as A
from wardgrid.operators.joins import anchored_window_join
from wardgrid.operators.ranking import first_row_per_key
from wardgrid.session import staged

RATE_BY_CATEGORY_SQL = f"""select admission_type, count(flag) as total,
    cast(coalesce(sum(flag), 0) as bigint) as positive,
    round(coalesce(sum(flag), 0) * 100.0 / nullif(count(flag), 0), 6) as rate_pct
    from (select admission_type, coalesce(flag, 0) as flag from {ENCOUNTERS} e) f
    where admission_type is not null group by admission_type"""


@query(
    "overall_rate",
    "select count(*) as n_total, cast(sum(coalesce(flag, 0)) as bigint) as n_positive, "
    "count(*) - cast(sum(coalesce(flag, 0)) as bigint) as n_negative, "
    f"round(sum(coalesce(flag, 0)) * 100.0 / nullif(count(*), 0), 6) as rate_pct from {ENCOUNTERS} e",
)
def _(spark, sf):
    return rounded(A.overall_rate(encounters(spark, sf), "flag"))


@query("rate_by_category", RATE_BY_CATEGORY_SQL)
def rate_by_priority(spark, sf):
    filled = encounters(spark, sf).fillna({"flag": 0})
    return rounded(A.rate_by_category(filled, "admission_type", "flag"))


@query(
    "rate_by_category_normalised",
    """select category, count(*) as total, cast(sum(flag) as bigint) as positive,
    round(sum(flag) * 100.0 / count(*), 6) as rate_pct from (
      select upper(trim(coalesce(raw, 'nan'))) as category,
        cast(coalesce(try_cast(raw_flag as double), 0) as integer) as flag from (
        select case when o_totalprice >= 50000 then ' ' || lower(o_orderpriority) || '  ' end as raw,
          case o_orderstatus when 'F' then '1' when 'O' then '0' else 'x' end as raw_flag
        from orders) r) c group by category""",
)
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.when(
            F.col("o_totalprice") >= 50000, F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("  "))
        ).alias("category"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0")
        .otherwise("x").alias("flag"),
    )
    return rounded(A.rate_by_category(raw, "category", "flag", normalise=True))


@query(
    "top_k_labels",
    f"select code as label, count(hadm_id) as n from {CODES} d where code is not null group by code "
    "order by n desc, label limit 10",
)
def _(spark, sf):
    labelled = codes(spark, sf).withColumnRenamed("code", "label")
    return A.top_k_labels(labelled, "label", "hadm_id", 10)


@query(
    "top_k_titles",
    """select coalesce(p_name, cast(l_partkey as varchar)) as label, count(l_orderkey) as n
    from lineitem left join (select p_partkey, case when p_size < 25 then p_name end as p_name from part) t
    on l_partkey = p_partkey group by 1 order by n desc, label limit 10""",
)
def _(spark, sf):
    coded = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("code"))
    title = F.when(F.col("p_size") < 25, F.col("p_name")).alias("title")
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("code"), title)
    return A.top_k_titles(coded, titles, "code", "title", "l_orderkey", 10)


def _stay_sql(rows: str) -> str:
    return f"""with r as ({rows}) select unit, count(*) as n, min(los) as min, max(los) as max,
    round(avg(los), 6) as mean, round(stddev_samp(los), 6) as sd,
    round(quantile_cont(los, 0.25), 6) as q1, round(median(los), 6) as median,
    round(quantile_cont(los, 0.75), 6) as q3,
    round(least((select quantile_cont(los, 0.95) from r) * 1.2, 35.0), 6) as scale_ceiling
    from r group by unit"""


@query("stay_by_unit", _stay_sql(f"select unit, los from {STAYS} s where los > 0 and unit is not null"))
def _(spark, sf):
    return rounded(A.stay_by_unit(staged(stays(spark, sf)), "unit", "los"))


@query(
    "stay_by_unit_coerced",
    _stay_sql(
        """select trim(coalesce(raw_unit, 'nan')) as unit, try_cast(raw_los as double) as los from (
      select case when los < 1 then null when los < 2 then '  '
        else ' ' || unit || ' ' end as raw_unit,
        case when los > 20 then 'x' else cast(los as varchar) end as raw_los
      from """
        + STAYS
        + """ s) t where try_cast(raw_los as double) > 0 and trim(coalesce(raw_unit, 'nan')) <> ''"""
    ),
)
def _(spark, sf):
    los = F.col("los")
    raw = stays(spark, sf).select(
        F.when(los < 1, F.lit(None)).when(los < 2, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("unit"), F.lit(" "))).alias("unit"),
        F.when(los > 20, F.lit("x")).otherwise(los.cast("string")).alias("los"),
    )
    return rounded(A.stay_by_unit(staged(raw), "unit", "los", coerce=True))


HISTOGRAM = {"click": (0, 150, 10.0), "view": (0, 50, 2.0), "error": (5, 20, 0.5)}


@query(
    "bounded_histogram",
    "with s(itemid, lo, hi, w) as (values "
    + ", ".join(f"('{i}', {lo}.0, {hi}.0, {w})" for i, (lo, hi, w) in HISTOGRAM.items())
    + f"""), r as (select v.itemid, valuenum, lo, hi, w from {VITALS} v join s on v.itemid = s.itemid
      where valuenum > lo and valuenum <= hi),
    m as (select itemid, count(*) as n, round(avg(valuenum), 6) as mean,
      round(median(valuenum), 6) as median from r group by itemid)
    select r.itemid, round(cast(lo + least(floor((valuenum - lo) / w), ceil((hi - lo) / w) - 1) * w
      as double), 6) as bin_low, count(*) as bin_count, m.n, m.mean, m.median
    from r join m on r.itemid = m.itemid group by 1, 2, m.n, m.mean, m.median""",
)
def _(spark, sf):
    return rounded(A.bounded_histogram(vitals(spark, sf), "itemid", "valuenum", HISTOGRAM))


@query(
    "stay_histogram",
    f"""with r as (select los from {STAYS} s where los > 0),
    m as (select median(los) as median, avg(los) as mean, quantile_cont(los, 0.75) as p75,
      quantile_cont(los, 0.97) as upper_end from r)
    select floor(los / 0.5) * 0.5 as bin_low, count(*) as bin_count, round(any_value(median), 6) as median,
      round(any_value(mean), 6) as mean, round(any_value(p75), 6) as p75
    from r cross join m where floor(los / 0.5) * 0.5 < upper_end group by 1""",
)
def _(spark, sf):
    return rounded(A.stay_histogram(staged(stays(spark, sf)), "los"))


@query(
    "window_min_max_mean",
    f"select hadm_id, itemid, min(valuenum) as value_min, max(valuenum) as value_max, "
    f"round(avg(valuenum), 4) as value_mean from {WINDOW} w group by hadm_id, itemid",
)
def _(spark, sf):
    inside = anchored_window_join(
        labs(spark, sf), encounters(spark, sf).select("hadm_id", "admittime"), "hadm_id",
        "charttime", "admittime", 0, WINDOW_HOURS,
    )
    return rounded(A.window_min_max_mean(inside, "hadm_id", "itemid", "valuenum"), 4)


@query("code_count", f"select hadm_id, count(code) as diag_count from {CODES} d group by hadm_id")
def _(spark, sf):
    return A.code_count(codes(spark, sf), "hadm_id", "code")


@query(
    "peak_by_subject",
    f"select subject_id, max(valuenum) as peak from {VITALS} v where itemid = 'click' group by subject_id",
)
def _(spark, sf):
    return A.peak_by_subject(vitals(spark, sf), "subject_id", "itemid", "valuenum", "click")


@query(
    "nadir_by_subject",
    f"select subject_id, min(valuenum) as nadir from {VITALS} v where itemid = 'click' and valuenum > 0 "
    "group by subject_id",
)
def _(spark, sf):
    return A.nadir_by_subject(vitals(spark, sf), "subject_id", "itemid", "valuenum", "click")


@query(
    "baseline_peak_stats",
    "select subject_id, min(valuenum) as baseline, max(valuenum) as peak, "
    "round(max(valuenum) / min(valuenum), 6) as ratio, round(max(valuenum) - min(valuenum), 6) as delta "
    f"from {VITALS} v where valuenum > 0 and valuenum < 30 group by subject_id",
)
def _(spark, sf):
    return rounded(A.baseline_peak_stats(vitals(spark, sf), "subject_id", "valuenum"))


PEAKS_SQL = f"(select subject_id, itemid, max(valuenum) as peak from {VITALS} v group by subject_id, itemid)"


@query("peak_by_subject_item", f"select subject_id, itemid, peak from {PEAKS_SQL} p")
def _(spark, sf):
    return A.peak_by_subject_item(vitals(spark, sf), "subject_id", "itemid", "valuenum")


@query(
    "outcome_mean_peaks",
    f"""select f.flag, p.itemid, round(avg(p.peak), 6) as mean_peak, count(p.peak) as n_subjects
    from {PEAKS_SQL} p join (select subject_id, flag from {ENCOUNTERS} e
      qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1) f
    on p.subject_id = f.subject_id where f.flag is not null group by f.flag, p.itemid""",
)
def _(spark, sf):
    peaks = A.peak_by_subject_item(vitals(spark, sf), "subject_id", "itemid", "valuenum")
    outcomes = first_row_per_key(
        encounters(spark, sf).select("subject_id", "admittime", "hadm_id", "flag"),
        "subject_id", ["admittime", "hadm_id"],
    ).select("subject_id", "flag")
    return rounded(A.outcome_mean_peaks(peaks, outcomes, "subject_id", "itemid", "peak", "flag"))


@query(
    "records_per_subject",
    f"select subject_id, count(*) as n from {VITALS} v group by subject_id "
    "order by n desc, subject_id limit 4",
)
def _(spark, sf):
    return A.records_per_subject(vitals(spark, sf), "subject_id")
