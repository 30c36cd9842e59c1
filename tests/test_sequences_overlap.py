"""Carried values, lags, rolling peaks and overlapping intervals next to plain Python, with a hot entity, ties and gaps."""

import datetime as dt
import random

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from wardgrid.operators import overlap, sequences

START = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def many_blocks(spark):
    """Keep small ranges apart, so that values cross the borders of blocks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")



def readings(n, seed=1, hot=0.4):
    """(row, entity, time, value): one entity holds a good third of the rows; times tie, values and entities are missing."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        entity = 7 if r.random() < hot else r.choice([1, 2, 3, None])
        hour = r.randrange(24 * 40)
        rows.append((k, entity, START + dt.timedelta(hours=hour), r.choice([None, float(r.randrange(100))])))
    return rows


SCHEMA = "row long, entity long, ts timestamp, value double"


@pytest.fixture(scope="module")
def rows():
    return readings(900)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


def by_entity(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.mark.parametrize("max_hours", [None, 5])
def test_forward_fill(df, rows, max_hours):
    got = {r.row: r.value for r in sequences.forward_fill(df, "entity", ["ts", "row"], ["value"], max_hours).collect()}
    for group in by_entity(rows).values():
        last = None
        for row, _, ts, value in group:
            last = (value, ts) if value is not None else last
            fresh = last is not None and (max_hours is None or ts - last[1] <= dt.timedelta(hours=max_hours))
            assert got[row] == (last[0] if fresh else None)


def test_forward_fill_keeps_columns_and_repeated_rows(spark):
    given = [(1, START, None, "x"), (1, START, 2.0, "x"), (1, None, 5.0, "y")] * 3
    df = spark.createDataFrame(given, "entity int, ts timestamp, `a.b` double, note string").withColumnRenamed("a.b", "v")
    out = sequences.forward_fill(df.withColumn("a.b", F.lit(1)), "entity", "ts", ["v"])
    assert out.columns == ["entity", "ts", "v", "note", "a.b"] and out.count() == 9 and all(r.v is not None for r in out.collect())
    assert sequences.forward_fill(df.limit(0), "entity", "ts", ["v"]).count() == 0


def test_hot_entity_lies_in_several_blocks(df):
    blocks = sequences.ordered_blocks(df, "entity", ["ts", "row"])
    assert blocks.where("entity = 7").select("_block").distinct().count() > 1


def test_equal_rows_lie_in_several_blocks(spark):
    df = spark.createDataFrame([(7, START, 1.0)] * 4000 + [(1, START, 2.0)] * 10, "entity int, ts timestamp, value double").repartition(4)
    sizes = sequences.ordered_blocks(df, "entity", "ts").groupBy("_block").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 3000


def test_lagged_features(df, rows):
    out = sequences.lagged_features(df, "entity", ["ts", "row"], ["value", "ts"], (1, 3, 40))
    got = {r.row: r for r in out.collect()}
    for group in by_entity(rows).values():
        for k, (row, *_) in enumerate(group):
            for lag in (1, 3, 40):
                back = group[k - lag] if k >= lag else (None,) * 4
                assert (got[row][f"value_lag{lag}"], got[row][f"ts_lag{lag}"]) == (back[3], back[2])


def test_lags_reach_over_short_blocks(spark):
    df = spark.createDataFrame([(1, START + dt.timedelta(hours=k), float(k)) for k in range(9)], "entity int, ts timestamp, value double")
    got = sorted((r.value, r.value_lag4) for r in sequences.lagged_features(df, "entity", "ts", ["value"], (4,)).collect())
    assert got == [(float(k), float(k - 4) if k >= 4 else None) for k in range(9)]


def test_lagged_by_time(df, rows):
    out = sequences.lagged_by_time(df, "entity", "ts", ["value"], 24, "row")
    got = {r.row: r.value_24h_ago for r in out.collect()}
    for group in by_entity(rows).values():
        for row, _, ts, _ in group:
            known = [v for _, _, t, v in group if v is not None and t <= ts - dt.timedelta(hours=24)]
            assert got[row] == (known[-1] if known else None)
    undated = df.limit(3).withColumn("ts", F.lit(None).cast("timestamp"))
    assert [r.value_24h_ago for r in sequences.lagged_by_time(undated, "entity", "ts", ["value"], 24).collect()] == [None] * 3


@pytest.mark.parametrize("hours", [1, 30, 168, 5000])
def test_rolling_peaks(df, rows, hours):
    points = df.withColumn("b", F.when(F.col("row") % 2 == 0, F.col("value")))
    got = {(r.entity, r.ts): (r.value_peak, r.b_peak) for r in sequences.rolling_peaks(points, "entity", "ts", ["value", "b"], hours).collect()}
    assert len(got) == len({(r[1], r[2]) for r in rows})
    most = lambda values: max((v for v in values if v is not None), default=None)
    for (entity, ts), peaks in got.items():
        seen = [r for r in rows if r[1] == entity and dt.timedelta(0) <= ts - r[2] <= dt.timedelta(hours=hours)]
        assert peaks == (most(r[3] for r in seen), most(r[3] for r in seen if r[0] % 2 == 0))


def test_coelevation_needs_one_window(spark):
    day = lambda d: START + dt.timedelta(days=d)
    rows = [(1, "alt", day(0), 500.0), (1, "bili", day(20), 9.0), (2, "alt", day(0), 500.0), (2, "bili", day(7), 9.0), (3, "bili", day(1), 9.0), (3, "alt", None, 900.0)]
    df = spark.createDataFrame(rows, "s int, item string, ts timestamp, v double")
    rolling = sequences.rolling_coelevation(df, "s", "item", "v", "ts", "alt", "bili")
    found = {r.s: (r.n, r.n_co_elevated, r.first_co_elevated) for r in sequences.first_coelevation(rolling, "s", "ts").collect()}
    assert found == {1: (2, 0, None), 2: (2, 1, day(7)), 3: (1, 0, None)}


def spans(n, seed):
    """(id, entity, start, end): lengths from an instant to years, open ends, missing starts and ends before the start."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        start = START + dt.timedelta(hours=r.randrange(24 * 60), minutes=r.choice([0, 0, 17]))
        length = r.choice([0, 0, 1, 5, 8, 9, 60, 400, 24 * 365, -3])
        end = None if r.random() < 0.05 else start + dt.timedelta(hours=length)
        out.append((k, r.choice([7, 7, 7, 1, 2, None]), None if r.random() < 0.03 else start, end))
    return out


def test_overlap_join_against_all_pairs(spark):
    one, two = spans(250, 1), spans(250, 2)
    left = spark.createDataFrame(one, "a long, entity long, s1 timestamp, e1 timestamp").repartition(3)
    right = spark.createDataFrame(two, "b long, entity long, s2 timestamp, e2 timestamp").repartition(3)
    far = dt.datetime(9999, 12, 31)
    want = sorted(
        (a, b)
        for a, x, s1, e1 in one
        for b, y, s2, e2 in two
        if x is not None and x == y and s1 and s2 and s1 <= (e1 or far) and s2 <= (e2 or far) and s1 <= (e2 or far) and s2 <= (e1 or far)
    )
    joined = overlap.overlap_join(left, right, "entity", ("s1", "e1"), ("s2", "e2"))
    assert joined.columns == ["entity", "a", "s1", "e1", "b", "s2", "e2"]
    assert sorted((r.a, r.b) for r in joined.collect()) == want
    plan = executed_plan(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert overlap.overlap_join(left.limit(0), right, "entity", ("s1", "e1"), ("s2", "e2")).count() == 0


def test_intervals_lie_in_few_buckets(spark):
    left = spark.createDataFrame(spans(400, 3), "a long, entity long, s1 timestamp, e1 timestamp")
    widths = overlap._widths(1.0)
    keyed = overlap._keyed(left, "s1", "e1", "l", widths)
    own = overlap._bucketed(keyed, "l", set(), widths).groupBy("a").count()
    assert own.agg(F.max("count")).first()[0] <= 2


def test_drug_lab_link(spark):
    day = lambda d: START + dt.timedelta(days=d)
    given = spark.createDataFrame(
        [(1, "x", day(0), day(10)), (1, "y", day(5), None), (2, "x", day(0), day(1)), (1, None, day(0), day(9))], "s int, drug string, t0 timestamp, t1 timestamp"
    )
    labs = spark.createDataFrame(
        [(1, "alt", day(6), 500.0), (1, "bili", day(30), 9.0), (1, "alt", day(9), 10.0), (2, "alt", day(2), 500.0), (1, "other", day(6), 1e6), (1, "bili", day(7), 0.5)],
        "s int, item string, ts timestamp, v double",
    )
    names = ("s", "drug", "t0", "t1", "item", "v", "ts", "alt", "bili")
    found = sorted((r.drug, r.item, r.ts, r.ratio) for r in overlap.drug_lab_link(given, labs, *names).collect())
    assert found == [("x", "alt", day(6), 12.5), ("y", "alt", day(6), 12.5), ("y", "bili", day(30), 7.5)]
    linked = overlap.drug_lab_link(given, labs, *names, abnormal=False)
    placed = {(r.drug, r.quadrant): r.n_subjects for r in overlap.drug_quadrants(linked, "s", "drug", "item", "v", "alt", "bili").collect()}
    assert placed == {("x", "Hepatocellular"): 1, ("y", "Hy's Law"): 1}
