import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardgrid.config import COMORBIDITY_HIERARCHY
from wardgrid.operators import scoring as S
from wardgrid.operators.aggregates import baseline_peak_stats
from wardgrid.operators.joins import inner_peaks


def score(spark, codes, **kwargs):
    df = spark.createDataFrame([(1, c) for c in codes], "h int, code string")
    return S.prefix_match_score(df, "h", "code", **kwargs).first().score


@pytest.mark.parametrize(
    "codes, want",
    [
        (["41071", "412"], 1),  # one category counts once
        (["5712", "5722"], 1 + 3),  # mild and severe add up
        (["042"], 6),
        (["V420"], 2),
        ([None], 0),
        (["99999"], 0),
        ([" 428 "], 1),  # padded
        (["430", "4379"], 1),
        (["196", "185"], 6 + 2),
    ],
)
def test_prefix_score(spark, codes, want):
    assert score(spark, codes) == want


def test_prefix_score_hierarchy_and_absent_entities(spark):
    assert score(spark, ["5712", "5722"], hierarchy=COMORBIDITY_HIERARCHY) == 3
    df = spark.createDataFrame([(None, "428"), (2, "428")], "h int, code string")
    assert rows(S.prefix_match_score(df, "h", "code")) == [(2, 1)]


def test_quadrants_are_strict(spark):
    points = [(1, 3.0, 2.0), (2, 3.01, 2.01), (3, 3.0, 2.01), (4, 3.01, 2.0)]
    df = spark.createDataFrame(points, "s int, a double, b double")
    out = S.edish_quadrant(df, "a", "b", uln_a=1, uln_b=1).select("s", "quadrant", "hys_law")
    assert rows(out, "s") == [
        (1, "Normal", False), (2, "Hy's Law", True), (3, "Temple's Corollary", False),
        (4, "Hepatocellular", False),
    ]


def test_quadrant_needs_both_markers(spark):
    events = spark.createDataFrame([(1, "alt", 500.0), (2, "alt", 130.0), (2, "bili", 2.5)], "s int, i string, v double")
    peaks = inner_peaks(events, "s", "i", "v", "alt", "bili")
    assert rows(S.edish_quadrant(peaks, "peak_a", "peak_b").select("s", "quadrant")) == [(2, "Hy's Law")]


def test_kidney_stages(spark):
    pairs = {1: (1, 1.2), 2: (1, 1.5), 3: (1, 2), 4: (1, 3), 5: (3.5, 4.0), 6: (2, 2.4)}
    df = spark.createDataFrame(
        [(k, float(v)) for k, pair in pairs.items() for v in pair], "s int, v double"
    )
    out = S.kdigo_stage(baseline_peak_stats(df, "s", "v")).select("s", "stage")
    assert rows(out, "s") == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 3), (6, 1)]


def test_grades_in_both_modes(spark):
    df = spark.createDataFrame(
        [(1, "wbc", 0.5), (2, "wbc", 1.5), (3, "wbc", 2.0), (4, "plt", 30.0), (5, "hgb", None), (6, "x", 1.0)],
        "s int, marker string, v double",
    )
    documented = S.ctcae_grade(df, "marker", "v").select("s", "grade")
    assert rows(documented, "s") == [(1, 4), (2, 3), (3, 0), (4, 3), (5, None), (6, None)]
    coded = S.ctcae_grade(df, "marker", "v", mode="as_coded").select("s", "grade")
    assert rows(coded, "s") == [(1, 4), (2, 4), (3, 0), (4, 4), (5, None), (6, None)]


def test_grade_falls_as_the_value_rises(spark):
    df = spark.range(1, 400).select(F.lit("wbc").alias("marker"), (F.col("id") / 100).alias("v"))
    got = [r.grade for r in S.ctcae_grade(df, "marker", "v").orderBy("v").collect()]
    assert got == sorted(got, reverse=True) and set(got) == {0, 3, 4}


def test_wide_grades_align_markers(spark):
    df = spark.createDataFrame(
        [(1, 51301, 1.5), (1, 51301, 9.0), (1, 51301, 0.0), (2, 51265, 20.0)], "s int, item int, v double"
    )
    out = S.blood_grades_wide(df, "s", "item", "v").select("s", "wbc_nadir", "wbc_grade", "plt_grade")
    assert rows(out, "s") == [(1, 1.5, 3, None), (2, None, None, 4)]
