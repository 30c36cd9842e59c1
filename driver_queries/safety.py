"""Scores and classification ladders, and the safety tables built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import CODES, SCORE_TABLE, VITALS, codes, query, rounded, table, vitals
from wardgrid.operators import aggregates as A
from wardgrid.operators import scoring as S
from wardgrid.operators.joins import inner_peaks
from wardgrid.operators.reshape import pivot_peak_matrix

# -- code-prefix score ------------------------------------------------------------------------

_HIT = {
    name: " or ".join(f"starts_with(code, '{p}')" for p in prefixes)
    for name, (_, prefixes) in SCORE_TABLE.items()
}
_SCORE_SQL = " + ".join(
    f"case when coalesce(bool_or({_HIT[name]}), false) then {weight} else 0 end"
    for name, (weight, _) in SCORE_TABLE.items()
)
SCORES_SQL = f"(select hadm_id, cast({_SCORE_SQL} as integer) as score from {CODES} d group by hadm_id)"


@query("prefix_match_score", f"select hadm_id, score from {SCORES_SQL} s")
def _(spark, sf):
    return S.prefix_match_score(codes(spark, sf), "hadm_id", "code", SCORE_TABLE)


@query(
    "prefix_match_score_hierarchy",
    f"""select hadm_id, cast(case when a and not c then 1 else 0 end + case when b then 2 else 0 end
    + case when c then 3 else 0 end + case when d then 6 else 0 end as integer) as score from (
    select hadm_id, """
    + ", ".join(f"coalesce(bool_or({_HIT[n]}), false) as {n.lower()}" for n in SCORE_TABLE)
    + f" from {CODES} d group by hadm_id) h",
)
def _(spark, sf):
    return S.prefix_match_score(
        codes(spark, sf), "hadm_id", "code", SCORE_TABLE, hierarchy={"A": "C"}
    )


# -- quadrant ---------------------------------------------------------------------------------


def quadrants(spark, sf):
    peaks = inner_peaks(vitals(spark, sf), "subject_id", "itemid", "valuenum", "click", "error")
    return S.edish_quadrant(peaks, "peak_a", "peak_b", uln_a=40.0, uln_b=60.0)


QUADRANTS_SQL = f"""(select subject_id, peak_a, peak_b, ratio_a, ratio_b,
    case when ratio_a > 3 and ratio_b > 2 then 'Hy''s Law' when ratio_b > 2 then 'Temple''s Corollary'
      when ratio_a > 3 then 'Hepatocellular' else 'Normal' end as quadrant,
    ratio_a > 3 and ratio_b > 2 as hys_law
    from (select subject_id, max(valuenum) filter (where itemid = 'click') as peak_a,
      max(valuenum) filter (where itemid = 'error') as peak_b, peak_a / 40.0 as ratio_a,
      peak_b / 60.0 as ratio_b from {VITALS} v group by subject_id) p
    where peak_a is not null and peak_b is not null)"""


@query(
    "edish_quadrant",
    "select subject_id, peak_a, peak_b, round(ratio_a, 6) as ratio_a, round(ratio_b, 6) as ratio_b, "
    f"quadrant, hys_law from {QUADRANTS_SQL} q",
)
def _(spark, sf):
    return rounded(quadrants(spark, sf))


_THIRD = f"(select subject_id, max(valuenum) as peak_c from {VITALS} v where itemid = 'view' group by subject_id)"


@query(
    "cholestasis_exclusion",
    f"""select q.subject_id, peak_a, peak_b, round(ratio_a, 6) as ratio_a, round(ratio_b, 6) as ratio_b, quadrant, hys_law, peak_c,
    round(peak_c / 60.0, 6) as ratio_c, coalesce(peak_c >= 120.0, false) as cholestatic,
    hys_law and not coalesce(peak_c >= 120.0, false) as hys_law_confirmed
    from {QUADRANTS_SQL} q left join {_THIRD} t on q.subject_id = t.subject_id""",
)
def _(spark, sf):
    third = A.peak_by_subject(vitals(spark, sf), "subject_id", "itemid", "valuenum", "view")
    return rounded(S.cholestasis_exclusion(quadrants(spark, sf), third, "subject_id", "peak", uln=60.0))


# -- kidney stage -----------------------------------------------------------------------------

_STAGE = """case when peak / baseline >= 3 or peak >= {p} then 3 when peak / baseline >= 2 then 2
    when peak / baseline >= 1.5 or peak - baseline >= {d} then 1 else 0 end"""


@query(
    "kdigo_stage",
    f"""select hadm_id, baseline, peak, round(peak / baseline, 6) as ratio,
    round(peak - baseline, 6) as delta, {_STAGE.format(p=50, d=5)} as stage
    from (select l_orderkey as hadm_id, min(l_quantity) as baseline, max(l_quantity) as peak
      from lineitem where l_quantity > 0 and l_quantity < 60 group by l_orderkey) s""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("hadm_id"), "l_quantity")
    stats = A.baseline_peak_stats(rows, "hadm_id", "l_quantity", 0, 60)
    return rounded(S.kdigo_stage(stats, peak_limit=50.0, delta_limit=5.0))


def stages(spark, sf):
    rows = vitals(spark, sf).where(F.col("itemid") == "view")
    stats = A.baseline_peak_stats(rows, "subject_id", "valuenum", 2, 300)
    return S.kdigo_stage(stats, peak_limit=200.0, delta_limit=5.0).select("subject_id", "stage")


STAGES_SQL = f"""(select subject_id, {_STAGE.format(p=200, d=5)} as stage from (select subject_id,
    min(valuenum) as baseline, max(valuenum) as peak from {VITALS} v
    where itemid = 'view' and valuenum > 2 and valuenum < 300 group by subject_id) s)"""

# -- toxicity grade ---------------------------------------------------------------------------

LADDERS = {"click": [(3, 2.0), (4, 1.0)], "error": [(3, 2.0), (4, 1.0)]}
MARKERS = {"click": "click", "error": "error"}


def grades(spark, sf, mode="as_documented"):
    return S.blood_grades_wide(
        vitals(spark, sf), "subject_id", "itemid", "valuenum", MARKERS, LADDERS, mode
    )


_GRADE = "case when {v} < 1 then 4 when {v} < 2 then 3 when {v} > 0 then 0 end"
_GRADE_CODED = "case when {v} < 2 then 4 when {v} < 1 then 3 when {v} > 0 then 0 end"


def _grades_sql(grade: str) -> str:
    return f"""(select subject_id, click_nadir, error_nadir, {grade.format(v='click_nadir')} as click_grade,
    {grade.format(v='error_nadir')} as error_grade from (select subject_id,
      min(valuenum) filter (where itemid = 'click') as click_nadir,
      min(valuenum) filter (where itemid = 'error') as error_nadir
      from {VITALS} v where itemid in ('click', 'error') and valuenum > 0 group by subject_id) n)"""


GRADES_SQL = _grades_sql(_GRADE)
GRADE_COLS = ["subject_id", "click_nadir", "error_nadir", "click_grade", "error_grade"]


@query("blood_grades_wide", f"select {', '.join(GRADE_COLS)} from {GRADES_SQL} g")
def _(spark, sf):
    return grades(spark, sf).select(*GRADE_COLS)


@query(
    "blood_grades_wide_as_coded", f"select {', '.join(GRADE_COLS)} from {_grades_sql(_GRADE_CODED)} g"
)
def _(spark, sf):
    return grades(spark, sf, "as_coded").select(*GRADE_COLS)


_NADIRS_SQL = f"""(select subject_id, itemid as marker, min(valuenum) as nadir from {VITALS} v
    where itemid in ('click', 'error') and valuenum > 0 group by subject_id, itemid)"""


def _nadirs(spark, sf):
    rows = vitals(spark, sf).where(F.col("itemid").isin("click", "error") & (F.col("valuenum") > 0))
    return rows.groupBy("subject_id", F.col("itemid").alias("marker")).agg(
        F.min("valuenum").alias("nadir")
    )


@query(
    "ctcae_grade",
    f"select subject_id, marker, nadir, {_GRADE.format(v='nadir')} as grade from {_NADIRS_SQL} n",
)
def _(spark, sf):
    return S.ctcae_grade(_nadirs(spark, sf), "marker", "nadir", LADDERS)


@query(
    "ctcae_grade_as_coded",
    f"select subject_id, marker, nadir, {_GRADE_CODED.format(v='nadir')} as grade from {_NADIRS_SQL} n",
)
def _(spark, sf):
    return S.ctcae_grade(_nadirs(spark, sf), "marker", "nadir", LADDERS, mode="as_coded")


# -- tables built on them ---------------------------------------------------------------------


@query(
    "class_distribution",
    f"select quadrant, count(*) as n from {QUADRANTS_SQL} q group by quadrant",
)
def _(spark, sf):
    return A.class_distribution(quadrants(spark, sf), "quadrant")


@query(
    "grade_by_marker_counts",
    f"""with g as (select * from {GRADES_SQL} x),
    a as (select distinct grade from (select click_grade as grade from g union all
      select error_grade from g) u where grade is not null),
    m as (select unnest(['click_grade', 'error_grade']) as marker)
    select a.grade, m.marker, count(g.subject_id) as n from a cross join m left join g
      on (m.marker = 'click_grade' and g.click_grade = a.grade)
      or (m.marker = 'error_grade' and g.error_grade = a.grade)
    group by a.grade, m.marker""",
)
def _(spark, sf):
    return A.grade_by_marker_counts(grades(spark, sf), "subject_id", ["click_grade", "error_grade"])


@query(
    "unpivot_grades",
    f"""select subject_id, 'click_grade' as marker, click_grade as grade from {GRADES_SQL} g
    where click_grade is not null union all
    select subject_id, 'error_grade', error_grade from {GRADES_SQL} g where error_grade is not null""",
)
def _(spark, sf):
    return A.unpivot_grades(grades(spark, sf), "subject_id", ["click_grade", "error_grade"])


@query(
    "signal_summary",
    "select count(*) as n_total, count(*) filter (where hys_law) as n_flagged, "
    "round(count(*) filter (where hys_law) * 100.0 / nullif(count(*), 0), 6) as rate_pct "
    f"from {QUADRANTS_SQL} q",
)
def _(spark, sf):
    return rounded(A.signal_summary(quadrants(spark, sf), "hys_law"))


@query("signal_members", f"select subject_id from {QUADRANTS_SQL} q where hys_law")
def _(spark, sf):
    return A.signal_members(quadrants(spark, sf), "hys_law", "subject_id")


@query(
    "pivot_peak_matrix",
    "select subject_id, "
    + ", ".join(
        f"max(valuenum) filter (where itemid = '{i}') as {i}_peak" for i in ("click", "error", "view")
    )
    + f" from {VITALS} v where itemid in ('click', 'error', 'view') group by subject_id",
)
def _(spark, sf):
    names = {i: f"{i}_peak" for i in ("click", "error", "view")}
    return pivot_peak_matrix(vitals(spark, sf), "subject_id", "itemid", "valuenum", names)
