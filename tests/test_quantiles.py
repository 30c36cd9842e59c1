import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardgrid.operators.quantiles import exact_median, exact_quantiles


def exact(values, p):
    values = sorted(values)
    position = (len(values) - 1) * p
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("shape", ["uniform", "heavy_tail", "ties", "constant"])
def test_matches_sorting_for_every_shape(spark, shape):
    rng = random.Random(7)
    make = {
        "uniform": rng.random,
        "heavy_tail": lambda: rng.paretovariate(0.5),
        "ties": lambda: float(rng.randint(0, 4)),
        "constant": lambda: 3.0,
    }[shape]
    # One group holds most rows, one has a single row.
    data = [("hot", make()) for _ in range(4000)] + [("small", make()) for _ in range(37)] + [("one", 1.5)]
    df = spark.createDataFrame(data + [("hot", None), (None, 1.0)], "g string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p97": 0.97, "p100": 1.0}
    grouped = {r.g: r for r in exact_quantiles(df, "v", probs, by=["g"], max_groups=3).collect()}
    assert set(grouped) == {"hot", "small", "one"}
    for g, row in grouped.items():
        values = [v for k, v in data if k == g]
        for name, p in probs.items():
            assert row[name] == pytest.approx(exact(values, p), rel=1e-12), (g, name)
    whole = exact_quantiles(df, "v", probs).first()
    values = [v for _, v in data] + [1.0]
    for name, p in probs.items():
        assert whole[name] == pytest.approx(exact(values, p), rel=1e-12)


def test_unbounded_groups_are_staged_and_extras_kept(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    out = exact_quantiles(df, "v", {"m": 0.5}, by=["g"], extra=[F.count("v").alias("n")])
    assert rows(out, "g") == [("a", 2, 2.0)]


def test_no_values_gives_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}, extra=[F.count(F.lit(1)).alias("n")]).first() == (1, None)


def test_median_is_a_scalar_column(spark):
    values = [5.0, 1.0, 9.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.m for r in df.withColumn("m", exact_median(df, "v")).collect()}
    assert got == {statistics.median(values)}


def test_many_values_per_group_match_percentile(spark):
    spread = F.when(F.col("id") % 3 == 0, F.randn(1) * 1e6).otherwise(-F.exp(F.randn(2) * 20))
    df = spark.range(300_000).select((F.col("id") % 2).alias("g"), spread.alias("v")).cache()
    probs = {"p1": 0.01, "p50": 0.5, "p97": 0.97}
    got = exact_quantiles(df, "v", probs, by=["g"], max_groups=2)
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()])
    for a, b in zip(rows(got, "g"), rows(want, "g"), strict=True):
        assert a == pytest.approx(b, rel=1e-12)
    df.unpersist()


def test_nan_zero_signs_and_infinity(spark):
    values = [float("nan"), 0.0, -0.0, 5e-324, -5e-324, 1e308, float("inf"), float("-inf"), 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = exact_quantiles(df, "v", {"p0": 0.0, "p50": 0.5, "p100": 1.0}).first()
    assert tuple(out) == (float("-inf"), pytest.approx(0.0, abs=1e-300), float("inf"))


def test_no_task_gathers_a_group(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.rand(1).alias("v"))
    plan = exact_quantiles(df, "v", {"m": 0.5}, by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
