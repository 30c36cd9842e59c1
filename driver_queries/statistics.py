"""Correlation, outliers, trajectories and prediction errors."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from driver_queries.registry import VITAL_ITEMS, VITALS, query, rounded, table, vitals
from wardgrid.operators import clusters as C
from wardgrid.operators import statistics as X
from wardgrid.operators.aggregates import peak_by_subject_item
from wardgrid.operators.ranking import top_outliers
from wardgrid.operators.reshape import min_non_null, pivot_peak_matrix


def vital_peaks(spark, sf):
    return peak_by_subject_item(vitals(spark, sf), "subject_id", "itemid", "valuenum")


PEAKS_SQL = f"(select subject_id, itemid, max(valuenum) as peak from {VITALS} v group by subject_id, itemid)"

OUTLIERS_SQL = f"""(select subject_id, max(z) as max_abs_z,
    arg_min(itemid, {{'nz': -z, 'item': itemid}}) filter (where z is not null) as extreme_item from (
      select p.subject_id, p.itemid, abs((p.peak - s.m) / nullif(s.sd, 0)) as z from {PEAKS_SQL} p
      join (select itemid, avg(peak) as m, stddev_samp(peak) as sd from {PEAKS_SQL} q group by itemid) s
      on p.itemid = s.itemid) t group by subject_id)"""


def outliers(spark, sf):
    return X.zscore_outliers(vital_peaks(spark, sf), "subject_id", "itemid", "peak", VITAL_ITEMS)


def listed_outliers(spark, sf):
    return top_outliers(outliers(spark, sf))


@query(
    "zscore_outliers",
    f"select subject_id, round(max_abs_z, 6) as max_abs_z, extreme_item from {OUTLIERS_SQL} z",
)
def _(spark, sf):
    return rounded(outliers(spark, sf))


@query(
    "outlier_threshold_flag",
    "select subject_id, round(max_abs_z, 6) as max_abs_z, extreme_item, "
    f"coalesce(max_abs_z > 2.5, false) as is_outlier from {OUTLIERS_SQL} z",
)
def _(spark, sf):
    return rounded(X.outlier_threshold_flag(outliers(spark, sf)))


CORR_COLS = [f"{i}_peak" for i in VITAL_ITEMS]


def _matrix(spark, sf):
    names = dict(zip(VITAL_ITEMS, CORR_COLS))
    wide = pivot_peak_matrix(vitals(spark, sf), "subject_id", "itemid", "valuenum", names)
    return min_non_null(wide, CORR_COLS, 3)


_MATRIX_SQL = (
    "(select * from (select subject_id, "
    + ", ".join(f"max(valuenum) filter (where itemid = '{i}') as {i}_peak" for i in VITAL_ITEMS)
    + f" from {VITALS} v group by subject_id) w where "
    + " + ".join(f"({c} is not null)::int" for c in CORR_COLS)
    + " >= 3)"
)
_CORR_SQL = " union all ".join(
    f"select '{a}' as marker_a, '{b}' as marker_b, "
    f"round(case when isnan(corr({a}, {b})) then null else corr({a}, {b}) end, 6) as r from m"
    for a, b in product(CORR_COLS, CORR_COLS)
)


@query("correlation_matrix", f"with m as (select * from {_MATRIX_SQL} x) {_CORR_SQL}")
def _(spark, sf):
    return rounded(X.correlation_matrix(_matrix(spark, sf), CORR_COLS))


@query(
    "strongest_pair",
    f"with m as (select * from {_MATRIX_SQL} x), c as ({_CORR_SQL}) select * from c "
    "where marker_a < marker_b order by abs(r) desc nulls last, marker_a, marker_b limit 1",
)
def _(spark, sf):
    return rounded(X.strongest_pair(X.correlation_matrix(_matrix(spark, sf), CORR_COLS)))


_SEGMENT = "case when h >= 72 then '72+' when h >= 24 then '24-72' when h >= 0 then '0-24' end"
_SEGMENTS = f"""with z as (select subject_id, min(charttime) as t0 from {VITALS} v group by subject_id),
    h as (select v.subject_id, itemid, valuenum, epoch_us(charttime - t0) / 3600000000.0 as h from {VITALS} v join z using (subject_id)),
    p as (select subject_id, {_SEGMENT} as segment, max(valuenum) filter (where itemid = 'click') as a,
      max(valuenum) filter (where itemid = 'error') as b from h where itemid in ('click', 'error') group by all),
    c as (select * from p where segment is not null and a is not null and b is not null)"""


@query(
    "correlation_by_hours",
    f"{_SEGMENTS} select segment, count(*) as n, round(corr(a, b), 6) as r from c group by segment "
    "union all select 'all', count(*), round(corr(a, b), 6) from c",
)
def _(spark, sf):
    events = vitals(spark, sf)
    anchors = events.groupBy("subject_id").agg(F.min("charttime").alias("intime"))
    return rounded(X.correlation_by_hours(events, anchors, "subject_id", "charttime", "intime", "itemid", "valuenum", "click", "error"))


# k-means unrolled: the start by hash, then a fixed number of steps.
CLUSTERS, STEPS = 4, 6
_POINTS = f"""(select subject_id, max(valuenum) filter (where itemid = 'click') as a, max(valuenum) filter (where itemid = 'error') as b,
    max(valuenum) filter (where itemid = 'view') as c from {VITALS} v group by subject_id)"""
_KMEANS = f"""with p as materialized (select * from {_POINTS} x where a is not null and b is not null and c is not null),
    c0 as materialized (select row_number() over (order by k) - 1 as j, a, b, c from (select a, b, c, min(md5('42:' || subject_id) || ':' || subject_id) as k
      from p group by a, b, c) s order by k limit {CLUSTERS})"""
for _step in range(STEPS + 1):
    _KMEANS += f""",
    a{_step} as materialized (select p.*, near.d, near.j from (select subject_id, min(struct_pack(
      d := (p.a - k.a) * (p.a - k.a) + (p.b - k.b) * (p.b - k.b) + (p.c - k.c) * (p.c - k.c), j := j)) as near
      from p cross join c{_step} k group by subject_id) n join p using (subject_id))"""
    if _step < STEPS:
        _KMEANS += f""",
    c{_step + 1} as materialized (select j, avg(a) as a, avg(b) as b, avg(c) as c from a{_step} group by j)"""


@query(
    "cluster_representatives",
    f"""{_KMEANS} select cast(j as integer) as cluster, count(*) as n, round(avg(sqrt(d)), 6) as mean_distance,
    min(struct_pack(d := d, s := subject_id)).s as subject_id, round(sqrt(min(d)), 6) as distance from a{STEPS} group by j""",
)
def _(spark, sf):
    names = {"click": "a", "error": "b", "view": "c"}
    wide = pivot_peak_matrix(vitals(spark, sf), "subject_id", "itemid", "valuenum", names)
    cols = list(names.values())
    centres = C.kmeans(wide, "subject_id", cols, CLUSTERS, STEPS)
    return rounded(C.cluster_representatives(C.assign_clusters(wide, "subject_id", cols, centres), "subject_id"))


@query(
    "aligned_trajectories",
    f"""with sel as (select subject_id from {OUTLIERS_SQL} o order by max_abs_z desc nulls last,
      subject_id limit 20),
    t1 as (select user_id as subject_id, min(ts) as t from events where event_type = 'signup'
      group by user_id),
    t2 as (select user_id as subject_id, min(ts) as t from events group by user_id),
    z as (select sel.subject_id, coalesce(t1.t, t2.t) as t0 from sel left join t1
      on sel.subject_id = t1.subject_id left join t2 on sel.subject_id = t2.subject_id)
    select v.subject_id, itemid, round(epoch_us(charttime - t0) / 3600000000.0, 6) as hours, valuenum
    from {VITALS} v join z on v.subject_id = z.subject_id
    where itemid in ('click', 'error', 'view')
      and epoch_us(charttime - t0) / 3600000000.0 between -6 and 120""",
)
def _(spark, sf):
    events = vitals(spark, sf)
    anchors = events.where(F.col("itemid") == "signup").select(
        "subject_id", F.col("charttime").alias("intime")
    )
    fallback = events.select("subject_id", F.col("charttime").alias("admittime"))
    return rounded(
        X.aligned_trajectories(
            events, listed_outliers(spark, sf), anchors, fallback, ["click", "error", "view"],
            selected_bound=20,
        )
    )


def _predictions(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity"
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_returnflag").alias("model"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted"),
    )


PREDICTIONS = """(select l_returnflag as model, l_extendedprice as actual,
    l_quantity * p_retailprice as predicted from lineitem join part on l_partkey = p_partkey)"""


@query(
    "predicted_vs_actual",
    f"with p as (select * from {PREDICTIONS} x) select model, actual, round(predicted, 4) as predicted, "
    "round(greatest((select max(actual) from p), (select max(predicted) from p)), 4) as axis_max from p",
)
def _(spark, sf):
    return rounded(X.predicted_vs_actual(_predictions(spark, sf), "model", "actual", "predicted"), 4)


@query(
    "prediction_error_histogram",
    f"""with e as (select model, predicted - actual as err from {PREDICTIONS} x),
    m as (select model, min(err) as lo, max(err) as hi from e group by model),
    b as (select e.model, cast(least(floor((err - lo) / (hi - lo) * 30.0), 29) as integer) as bin, lo, hi
      from e join m on e.model = m.model)
    select model, bin, round(lo + bin * (hi - lo) / 30.0, 4) as bin_low, count(*) as bin_count
    from b group by model, bin, lo, hi""",
)
def _(spark, sf):
    return rounded(
        X.prediction_error_histogram(
            _predictions(spark, sf), "model", "actual", "predicted", ["A", "N", "R"]
        ),
        4,
    )
