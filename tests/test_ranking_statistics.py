from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardgrid.operators import ranking as K
from wardgrid.operators import statistics as X

T0 = datetime(2100, 1, 1)


def test_first_row_goes_by_time_not_by_id(spark):
    df = spark.createDataFrame(
        [(1, 5, T0 + timedelta(1), None), (1, 9, T0, "x"), (2, 7, None, "y"), (None, 1, T0, "z")],
        "s int, h int, t timestamp, note string",
    )
    assert rows(K.first_row_per_key(df, "s", ["t", "h"]).select("s", "h", "note"), "s") == [(1, 9, "x"), (2, 7, "y")]


def test_z_scores_ignore_constant_and_single_items(spark):
    peaks = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 2.0), (3, "a", 9.0), (1, "c", 5.0), (2, "c", 5.0), (3, "d", 7.0), (4, "c", 5.0)],
        "s int, item string, peak double",
    )
    for items in (["a", "c", "d"], None):
        out = X.zscore_outliers(peaks, "s", "item", "peak", items)
        got = {r.s: (r.max_abs_z and round(r.max_abs_z, 6), r.extreme_item) for r in out.collect()}
        assert got == {1: (0.688247, "a"), 2: (0.458831, "a"), 3: (1.147079, "a"), 4: (None, None)}
    ranked = K.top_outliers(out, "s", 20).collect()
    assert [r.s for r in ranked] == [3, 1, 2, 4]
    flagged = X.outlier_threshold_flag(out, 1.0)
    assert rows(flagged.where("is_outlier").select("s")) == [(3,)]


def test_extreme_item_tie_takes_the_lower_code(spark):
    peaks = spark.createDataFrame([(s, i, float(s)) for s in (1, 2) for i in (20, 10)], "s int, item int, peak double")
    assert {r.extreme_item for r in X.extreme_item(peaks, "s", "item", "peak", [10, 20]).collect()} == {10}


def test_correlation_is_pairwise_complete_and_survives_constants(spark):
    wide = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (4.0, None, 5.0)], "a double, b double, c double"
    )
    out = {(r.marker_a, r.marker_b): r.r for r in X.correlation_matrix(wide, ["a", "b", "c"]).collect()}
    assert out["a", "b"] == out["b", "a"] == pytest.approx(1.95 / 3.81**0.5)
    assert out["a", "a"] == pytest.approx(1.0) and out["a", "c"] is None and out["c", "c"] is None
    best = X.strongest_pair(X.correlation_matrix(wide, ["a", "b", "c"])).first()
    assert (best.marker_a, best.marker_b) == ("a", "b")
    single = X.correlation_matrix(wide.limit(1), ["a", "b"]).collect()
    assert all(r.r is None for r in single)


def test_representatives_fill_open_survivor_slots(spark):
    outliers = spark.createDataFrame(
        [(1, 9.0, 1), (2, 8.0, 1), (3, 7.0, 0), (4, 6.0, 1), (9, 5.0, None)], "subject_id int, max_abs_z double, flag int"
    )
    visits = spark.createDataFrame([(3, 0), (5, 0), (6, 0), (7, 1)], "subject_id int, flag int")
    events = spark.createDataFrame([(7,)] * 9 + [(3,)] * 8 + [(6,)] * 5 + [(5,)] * 4, "subject_id int")
    out = K.representative_subjects(outliers, events, visits, "flag")
    assert rows(out, "outcome", "slot") == [
        (1, "Deceased", 1), (2, "Deceased", 2), (3, "Survived", 1), (6, "Survived", 2)
    ]


def test_trajectories_window_and_fallback(spark):
    hours = [-6.01, -6, 0, 120, 120.01]
    labs = [(s, 1, T0 + timedelta(hours=h), float(h)) for s in (1, 2) for h in hours] + [(3, 1, T0, 0.0), (1, 2, T0, 0.0)]
    events = spark.createDataFrame(labs, "subject_id int, itemid int, charttime timestamp, valuenum double")
    icu = spark.createDataFrame([(1, T0), (1, T0 + timedelta(days=9))], "subject_id int, intime timestamp")
    adm = spark.createDataFrame([(2, T0), (1, T0 - timedelta(days=3))], "subject_id int, admittime timestamp")
    chosen = spark.createDataFrame([(1,), (2,)], "subject_id int")
    out = X.aligned_trajectories(events, chosen, icu, adm, [1], selected_bound=4)
    assert [(r.subject_id, r.hours) for r in out.collect()] == [(s, float(h)) for s in (1, 2) for h in (-6, 0, 120)]


def test_error_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.range(0, 101).select(F.lit("m").alias("model"), F.lit(0.0).alias("y"), F.col("id").cast("double").alias("p"))
    out = X.prediction_error_histogram(df, "model", "y", "p", ["m"], 30)
    got = {r.bin: r.bin_count for r in out.collect()}
    assert sum(got.values()) == 101 and max(got) == 29
    flat = df.withColumn("p", F.lit(1.0))
    assert rows(X.prediction_error_histogram(flat, "model", "y", "p", ["m"]).select("bin", "bin_count")) == [(0, 101)]


def test_best_model_rules(spark):
    df = spark.createDataFrame([("base", 1.0), ("b", 2.0), ("a", 2.0), ("c", None)], "model string, mae double")
    assert K.best_model(df, "mae", maximise=False, exclude=["base"]).first().model == "a"
    assert K.best_model(df, "mae").first().model == "a"
    assert [r.model for r in K.sort_rows(df, ["model"]).collect()] == ["a", "b", "base", "c"]


def test_predicted_vs_actual_axis(spark):
    df = spark.createDataFrame([("m", 1.0, 7.0), ("n", 3.0, 2.0)], "model string, y double, p double")
    assert {r.axis_max for r in X.predicted_vs_actual(df, "model", "y", "p").collect()} == {7.0}


def test_first_row_prefers_dated_rows_and_whole_keys(spark):
    data = [(1, 1, None, "undated"), (1, 1, 5, "dated"), (1, None, 1, "no key"), (2, 1, None, "only")]
    df = spark.createDataFrame(data, "a int, b int, t int, note string")
    first = K.first_row_per_key(df, ["a", "b"], ["t"])
    assert rows(first.select("a", "note"), "a") == [(1, "dated"), (2, "only")]
    again = K.first_row_per_key(df.union(df), ["a", "b"], ["t"])
    assert rows(again.select("a", "note"), "a") == [(1, "dated"), (2, "only")]
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
