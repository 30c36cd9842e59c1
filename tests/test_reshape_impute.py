import pytest
from conftest import rows

from wardgrid.operators import impute as I
from wardgrid.operators import reshape as R

EVENTS = "h int, item int, v double"


def test_pivot_keeps_entities_whose_values_are_all_missing(spark):
    df = spark.createDataFrame(
        [(1, 10, 1.0), (1, 10, 3.0), (1, 11, 5.0), (2, 11, None), (3, 99, 7.0), (None, 10, 1.0)], EVENTS
    )
    out = R.pivot_stats_wide(df, "h", "item", "v", {10: "a", 11: "b"})
    assert rows(out, "h") == [(1, 1.0, 3.0, 2.0, 5.0, 5.0, 5.0), (2, None, None, None, None, None, None)]


def test_pivot_merges_codes_that_share_a_signal(spark):
    df = spark.createDataFrame([(1, 10, 1.0), (1, 11, 3.0)], EVENTS)
    assert rows(R.pivot_stats_wide(df, "h", "item", "v", {10: "a", 11: "a"})) == [(1, 1.0, 3.0, 2.0)]


def test_both_missing_entities_get_the_median_of_the_rest(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 4.0, None), (3, None, None), (4, 9.0, 3.0)], "h int, a double, b double")
    out = I.median_impute(df, ["a", "b"])
    assert rows(out, "h") == [(1, 2.0, 1.0), (2, 4.0, 2.0), (3, 4.0, 2.0), (4, 9.0, 3.0)]


def test_fit_on_training_rows_only(spark):
    df = spark.createDataFrame([(1, 2.0, 0), (2, 100.0, 1), (3, None, 1)], "h int, a double, is_test int")
    out = I.residual_impute(df, ["a"], fit_on=df.where("is_test = 0"))
    assert rows(out.select("h", "a"), "h") == [(1, 2.0), (2, 100.0), (3, 2.0)]


def test_filling_leaves_no_missing_value(spark):
    df = spark.range(500).selectExpr(
        "id", "case when rand(3) < 0.7 then rand(4) end as a", "case when rand(5) < 0.2 then id end as b"
    )
    filled = I.median_impute(df, ["a", "b"])
    assert filled.where("a is null or b is null").count() == 0


def test_min_non_null(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, None), (2, 1.0, 2.0, 3.0)], "s int, a double, b double, c double")
    assert rows(R.min_non_null(df, ["a", "b", "c"], 3).select("s")) == [(2,)]


def test_append_project_zero_fill(spark):
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, k int")
    assert rows(R.append_rows([a, b]), "k") == [(1, "x"), (2, "y")]
    out = R.project_columns(a, keep=["k", "t"], drop=["t"], rename={"k": "key"})
    assert out.columns == ["key"]
    c = spark.createDataFrame([(1, None)], "k int, n int")
    assert rows(I.zero_fill(c, ["n"])) == [(1, 0)]


@pytest.mark.parametrize("stat", ["min", "max", "mean"])
def test_single_statistic(spark, stat):
    df = spark.createDataFrame([(1, 10, 1.0), (1, 10, 2.0)], EVENTS)
    want = {"min": 1.0, "max": 2.0, "mean": 1.5}[stat]
    assert rows(R.pivot_stats_wide(df, "h", "item", "v", {10: "a"}, [stat])) == [(1, want)]


def test_medians_of_odd_columns(spark):
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, -7.5, 1e-300, 3.0]
    values = [(x, None, 4.0, -x if x else x, k) for k, x in enumerate(odd)] + [(None, None, 4.0, None, None)]
    df = spark.createDataFrame(values, "a double, `b.c` double, d double, e double, f int")
    # The order is -inf, -7.5, 0, 0, 1e-300, 3, inf.
    assert tuple(I.column_medians(df, df.columns).first()) == (0.0, None, 4.0, 0.0, 4.0)


def test_second_pass_over_the_columns_drops_values_far_from_the_median(spark):
    df = spark.range(1001).selectExpr("id + 0.0D as a", "-id * 1.0D as b")
    medians = I.column_medians(df, ["a", "b"])
    assert tuple(medians.first()) == (500.0, -500.0)
    plan = medians._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "500.0" in plan
