from conftest import rows
from pyspark.sql import functions as F

from wardgrid.operators import aggregates as A
from wardgrid.operators import profile as P
from wardgrid.sources.schemas import TABLES

ADM = "hadm_id int, t string, flag int"


def test_rates_with_missing_flags_and_categories(spark):
    df = spark.createDataFrame(
        [(1, "A", 1), (2, "A", 0), (3, "A", None), (4, None, 1), (5, " a", 1)], ADM
    )
    assert rows(A.overall_rate(df, "flag")) == [(5, 3, 2, 60.0)]
    assert rows(A.rate_by_category(df, "t", "flag"), "t") == [(" a", 1, 1, 100.0), ("A", 2, 1, 50.0)]
    clean = A.rate_by_category(df, "t", "flag", normalise=True)
    assert rows(clean.select("t", "total", "positive"), "t") == [("A", 4, 2), ("NAN", 1, 1)]
    empty = A.overall_rate(df.where("false"), "flag")
    assert rows(empty) == [(0, 0, 0, None)]


def test_flag_health_and_category_counts(spark):
    df = spark.createDataFrame([(1, "B", 1), (2, "A", None), (3, "B", 0), (4, None, 0)], ADM)
    assert rows(P.flag_health(df, "flag")) == [(4, 1, 1, 25.0)]
    assert [tuple(r) for r in P.category_counts(df, "t").collect()] == [("B", 2), ("A", 1)]


def test_top_k_ties_go_to_the_smaller_label(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1), ("c", 2), (None, 1)], "label string, h int")
    assert [tuple(r) for r in A.top_k_labels(df, "label", "h", 2).collect()] == [("c", 2), ("a", 1)]


def test_top_k_titles_falls_back_to_the_code(spark):
    codes = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), ("3", 4), (None, 5)], "code string, h int")
    titles = spark.createDataFrame([("1", "one"), ("3", "one")], "code string, title string")
    out = A.top_k_titles(codes, titles, "code", "title", "h", 3)
    assert [tuple(r) for r in out.collect()] == [("one", 3), ("2", 1), ("nan", 1)]


def test_stay_by_unit_coerced_quirks(spark):
    df = spark.createDataFrame(
        [(" A ", "1"), ("A", "3"), (None, "2"), ("  ", "9"), ("B", "x"), ("B", "-1"), ("B", None)],
        "unit string, los string",
    )
    out = A.stay_by_unit(df, "unit", "los", coerce=True).select("unit", "n", "median")
    assert rows(out, "unit") == [("A", 2, 2.0), ("nan", 1, 2.0)]


def test_stay_by_unit_plain_drops_missing_unit_but_not_from_the_ceiling(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("A", 0.0), (None, 100.0)], "unit string, los double")
    out = A.stay_by_unit(df, "unit", "los").select("unit", "n", "scale_ceiling").collect()
    assert [tuple(r) for r in out] == [("A", 2, 35.0)]


def test_bounded_histogram_counts_every_row_in_range(spark):
    values = [0.0, 0.4, 1.0, 1.9, 2.0, 2.1, None]
    df = spark.createDataFrame([("x", v) for v in values] + [("y", 1.0)], "item string, v double")
    out = A.bounded_histogram(df, "item", "v", {"x": (0, 2, 1.0)})
    got = {r.bin_low: (r.bin_count, r.n) for r in out.collect()}
    assert got == {0.0: (1, 4), 1.0: (3, 4)}


def test_stay_histogram_markers(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1.2, 1.4, 2, 50]], "los double")
    out = A.stay_histogram(df, "los", width=0.5)
    got = {r.bin_low: r.bin_count for r in out.collect()}
    first = out.first()
    assert first["median"] == 1.4 and got[1.0] == 3 and got[2.0] == 1 and 50.0 not in got


def test_peaks_nadirs_and_baselines(spark):
    df = spark.createDataFrame(
        [(1, "a", 4.0), (1, "a", 2.0), (1, "a", 0.0), (1, "a", 99.0), (2, "a", None), (None, "a", 5.0)],
        "s int, item string, v double",
    )
    assert rows(A.peak_by_subject(df, "s", "item", "v", "a"), "s") == [(1, 99.0), (2, None)]
    assert rows(A.nadir_by_subject(df, "s", "item", "v", "a"), "s") == [(1, 2.0)]
    assert rows(A.baseline_peak_stats(df, "s", "v", 0, 30)) == [(1, 2.0, 4.0, 2.0, 2.0)]
    assert rows(A.window_min_max_mean(df, "s", "item", "v"), "s") == [(1, "a", 0.0, 99.0, 26.25), (2, "a", None, None, None)]


def test_code_count_ignores_missing_codes(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, None), (None, "x")], "h int, c string")
    assert rows(A.code_count(df, "h", "c"), "h") == [(1, 1), (2, 0)]


def test_grade_counts_cover_the_union_of_grades(spark):
    df = spark.createDataFrame([(1, 0, 4), (2, 0, None), (3, 3, 0)], "s int, wbc int, hgb int")
    out = A.grade_by_marker_counts(df, "s", ["wbc", "hgb"])
    assert rows(out, "grade", "marker") == [
        (0, "hgb", 1), (0, "wbc", 2), (3, "hgb", 0), (3, "wbc", 1), (4, "hgb", 1), (4, "wbc", 0)
    ]


def test_signal_summary_and_members(spark):
    df = spark.createDataFrame([(3, True), (1, True), (2, False)], "s int, hit boolean")
    total, flagged, rate = A.signal_summary(df, "hit").first()
    assert (total, flagged, round(rate, 4)) == (3, 2, 66.6667)
    assert [r.s for r in A.signal_members(df, "hit", "s").collect()] == [1, 3]


def test_outcome_means_drop_unknown_outcomes(spark):
    peaks = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, "a", 9.0)], "s int, item string, peak double")
    outcome = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "s int, flag int")
    assert rows(A.outcome_mean_peaks(peaks, outcome, "s", "item", "peak", "flag")) == [(0, "a", 3.0, 2)]


def test_required_columns(spark):
    import pytest

    df = spark.createDataFrame([(1, None)], "subject_id long, drug string")
    with pytest.raises(ValueError, match="hadm_id"):
        P.required_columns_check(df, TABLES["PRESCRIPTIONS"])
    out = P.required_columns_check(df.withColumn("hadm_id", F.lit(5)), TABLES["PRESCRIPTIONS"])
    assert rows(out.select("column_name", "n_missing"), "column_name") == [
        ("drug", 1), ("hadm_id", 0), ("subject_id", 0)
    ]


def test_table_counts_and_matrix_health(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 0), (0, 4.0, 5, 1)], "y int, los double, score int, imp int")
    assert rows(P.table_row_counts({"x": df})) == [("x", 2, 4)]
    health = P.matrix_health(df, "y", "los", "score", "imp").first()
    assert (health.n_positive, health.label_rate_pct, health.median_target, health.n_imputed) == (1, 50.0, 3.0, 1)
    assert rows(P.stay_health(df, "los")) == [(2, 3.0)]


def test_records_and_outlier_outcomes(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "s int")
    assert [tuple(r) for r in A.records_per_subject(df, "s", 2).collect()] == [(2, 2), (1, 1)]
    listed = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "s int, flag int")
    assert rows(A.outlier_outcome_count(listed, "flag")) == [(3, 1)]
