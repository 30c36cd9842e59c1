"""Carried values, lags, rolling peaks and overlapping intervals over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import VITALS, query, rounded, table, vitals
from wardgrid.operators import overlap as O
from wardgrid.operators import sequences as Q

# Every third measurement is read as missing.
GAPPED = "(select event_id, user_id as subject_id, ts as charttime, event_type as itemid, case when event_id % 3 <> 0 then value end as valuenum from events)"


def gapped(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("subject_id"), F.col("ts").alias("charttime"), F.col("event_type").alias("itemid"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("valuenum"),
    )


@query(
    "forward_fill",
    f"select event_id, subject_id, charttime, itemid, last_value(valuenum ignore nulls) over (partition by subject_id, itemid "
    f"order by charttime, event_id rows unbounded preceding) as valuenum from {GAPPED} g",
)
def _(spark, sf):
    return Q.forward_fill(gapped(spark, sf), ["subject_id", "itemid"], ["charttime", "event_id"], ["valuenum"])


@query(
    "forward_fill_within",
    f"""select event_id, subject_id, charttime, itemid, coalesce(valuenum, case when epoch_us(charttime) - epoch_us(k.t) <= 24 * 3600000000 then k.v end) as valuenum
    from (select *, last_value(case when valuenum is not null then {{'v': valuenum, 't': charttime}} end ignore nulls) over (
      partition by subject_id, itemid order by charttime, event_id rows unbounded preceding) as k from {GAPPED} g) f""",
)
def _(spark, sf):
    """Values at most a day old."""
    return Q.forward_fill(gapped(spark, sf), ["subject_id", "itemid"], ["charttime", "event_id"], ["valuenum"], max_hours=24)


@query(
    "lagged_features",
    "select event_id, subject_id, charttime, itemid, valuenum, "
    + ", ".join(f"lag(valuenum, {k}) over w as valuenum_lag{k}, lag(charttime, {k}) over w as charttime_lag{k}" for k in (1, 2, 5))
    + f" from {GAPPED} g window w as (partition by subject_id order by charttime, event_id)",
)
def _(spark, sf):
    return Q.lagged_features(gapped(spark, sf), "subject_id", ["charttime", "event_id"], ["valuenum", "charttime"], (1, 2, 5))


@query(
    "lagged_by_time",
    f"""with g as (select * from {GAPPED} x),
    p as (select subject_id, charttime, arg_max(valuenum, event_id) as v from g where valuenum is not null group by 1, 2)
    select event_id, g.subject_id, g.charttime, itemid, valuenum, p.v as valuenum_24h_ago
    from g asof left join p on g.subject_id = p.subject_id and g.charttime - interval 24 hour >= p.charttime""",
)
def _(spark, sf):
    return Q.lagged_by_time(gapped(spark, sf), "subject_id", "charttime", ["valuenum"], 24, "event_id")


ROLLING = f"""(select distinct subject_id, charttime, max(case when itemid = 'click' then valuenum end) over w as a_peak,
    max(case when itemid = 'error' then valuenum end) over w as b_peak from {VITALS} v where itemid in ('click', 'error')
    window w as (partition by subject_id order by charttime range between interval 7 day preceding and current row))"""
_RAISED = "coalesce(a_peak / 40.0 > 3 and b_peak / 60.0 > 2, false)"


def _rolling(spark, sf):
    return Q.rolling_coelevation(vitals(spark, sf), "subject_id", "itemid", "valuenum", "charttime", "click", "error", uln_a=40.0, uln_b=60.0)


@query(
    "rolling_coelevation",
    f"""select subject_id, charttime, a_peak, b_peak, round(a_peak / 40.0, 6) as ratio_a, round(b_peak / 60.0, 6) as ratio_b,
    case when a_peak / 40.0 > 3 and b_peak / 60.0 > 2 then 'Hy''s Law' when b_peak / 60.0 > 2 then 'Temple''s Corollary'
      when a_peak / 40.0 > 3 then 'Hepatocellular' else 'Normal' end as quadrant, {_RAISED} as co_elevated from {ROLLING} r""",
)
def _(spark, sf):
    return rounded(_rolling(spark, sf))


@query(
    "first_coelevation",
    f"select subject_id, count(*) as n, count(*) filter (where {_RAISED}) as n_co_elevated, "
    f"min(charttime) filter (where {_RAISED}) as first_co_elevated from {ROLLING} r group by subject_id",
)
def _(spark, sf):
    return Q.first_coelevation(_rolling(spark, sf), "subject_id", "charttime")


# Signups and purchases as prescriptions, of length 0 to about 100 days by their properties; some never end.
_K = "cast(json_extract_string(props, '$.k') as integer)"
PRESCRIPTIONS = f"""(select user_id as subject_id, 'drug ' || ({_K} % 7) as drug, ts as starttime,
    case when {_K} % 10 <> 0 then ts + to_seconds({_K} * {_K} * 900) end as stoptime from events where event_type in ('signup', 'purchase'))"""


def prescriptions(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").where(F.col("event_type").isin("signup", "purchase")).select(
        F.col("user_id").alias("subject_id"), F.concat(F.lit("drug "), k % 7).alias("drug"), F.col("ts").alias("starttime"),
        F.when(k % 10 != 0, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.lit(900_000_000).cast("long") * k * k)).cast("timestamp_ntz").alias("stoptime"),
    )


LINKED = f"""(select p.subject_id, drug, starttime, stoptime, itemid, charttime, valuenum, valuenum / case itemid when 'click' then 40.0 else 60.0 end as ratio
    from {PRESCRIPTIONS} p join {VITALS} v on p.subject_id = v.subject_id and itemid in ('click', 'error')
    and charttime >= starttime and (stoptime is null or charttime <= stoptime))"""


def _linked(spark, sf, abnormal):
    return O.drug_lab_link(
        prescriptions(spark, sf), vitals(spark, sf), "subject_id", "drug", "starttime", "stoptime", "itemid", "valuenum", "charttime",
        "click", "error", 40.0, 60.0, abnormal,
    )


@query(
    "drug_lab_link",
    f"select subject_id, drug, starttime, stoptime, itemid, charttime, valuenum, round(ratio, 6) as ratio from {LINKED} l where ratio > 1",
)
def _(spark, sf):
    return rounded(_linked(spark, sf, True))


@query(
    "drug_quadrants",
    f"""select drug, case when a > 3 and b > 2 then 'Hy''s Law' when b > 2 then 'Temple''s Corollary'
      when a > 3 then 'Hepatocellular' else 'Normal' end as quadrant, count(*) as n_subjects from (
      select drug, subject_id, max(ratio) filter (where itemid = 'click') as a, max(ratio) filter (where itemid = 'error') as b
      from {LINKED} l group by drug, subject_id) p where a is not null and b is not null group by 1, 2""",
)
def _(spark, sf):
    return O.drug_quadrants(_linked(spark, sf, False), "subject_id", "drug", "itemid", "valuenum", "click", "error", 40.0, 60.0)


# Intervals on both sides: prescriptions of different drugs that ran at the same time.
@query(
    "overlap_join",
    f"""select a.subject_id, a.drug, b.drug as other_drug, a.starttime, a.stoptime, b.starttime as other_start, b.stoptime as other_stop
    from {PRESCRIPTIONS} a join {PRESCRIPTIONS} b on a.subject_id = b.subject_id and a.drug < b.drug
    and (b.stoptime is null or a.starttime <= b.stoptime) and (a.stoptime is null or b.starttime <= a.stoptime)""",
)
def _(spark, sf):
    given = prescriptions(spark, sf)
    other = given.select("subject_id", F.col("drug").alias("other_drug"), F.col("starttime").alias("other_start"), F.col("stoptime").alias("other_stop"))
    pairs = O.overlap_join(given, other, "subject_id", ("starttime", "stoptime"), ("other_start", "other_stop"))
    return pairs.where(F.col("drug") < F.col("other_drug"))
