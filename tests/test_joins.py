from datetime import datetime, timedelta

from conftest import executed_plan, rows
from pyspark.sql import functions as F

from wardgrid.operators import joins as J

T0 = datetime(2100, 5, 1, 8)


def test_window_includes_both_ends(spark):
    offsets = {1: timedelta(seconds=-1), 2: timedelta(0), 3: timedelta(hours=24), 4: timedelta(hours=24, seconds=1)}
    events = spark.createDataFrame(
        [(k, 7, T0 + o) for k, o in offsets.items()] + [(5, 8, T0), (6, None, T0), (7, 9, T0)],
        "id int, hadm_id long, charttime timestamp",
    )
    anchors = spark.createDataFrame([(7, T0), (9, None)], "hadm_id long, admittime timestamp")
    out = J.anchored_window_join(events, anchors, "hadm_id", "charttime", "admittime")
    assert rows(out.select("id"), "id") == [(2,), (3,)]


def test_left_joins_keep_unmatched_rows(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "hadm_id long, subject_id long")
    people = spark.createDataFrame([(10, "M")], "subject_id long, gender string")
    out = J.join_subject_demographics(base, people, "subject_id").select("hadm_id", "gender")
    assert rows(out, "hadm_id") == [(1, "M"), (2, None), (3, None)]


def test_assemble_zero_fills_only_named_columns(spark):
    base = spark.createDataFrame([(1, 5), (2, 6)], "hadm_id long, icu long")
    score = spark.createDataFrame([(1, 3)], "hadm_id long, score int")
    wide = spark.createDataFrame([(6, 1.5)], "icu long, hr_min double")
    out = J.assemble_features(base, [score, wide], ["hadm_id", "icu"], zero_fill=["score"])
    assert rows(out.select("hadm_id", "score", "hr_min"), "hadm_id") == [(1, 3, None), (2, 0, 1.5)]


def test_inner_peaks_drops_subjects_with_one_marker(spark):
    events = spark.createDataFrame(
        [(1, "a", 2.0), (1, "a", 5.0), (1, "b", 1.0), (2, "a", 9.0), (3, "b", 9.0), (None, "a", 1.0)],
        "s int, item string, v double",
    )
    assert rows(J.inner_peaks(events, "s", "item", "v", "a", "b")) == [(1, 5.0, 1.0)]


def test_outer_align(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "s int, a double")
    b = spark.createDataFrame([(2, 3.0), (3, 4.0)], "s int, b double")
    assert rows(J.outer_align([a, b], "s"), "s") == [(1, 1.0, None), (2, 2.0, 3.0), (3, None, 4.0)]


def test_first_outcome_goes_by_time_and_any_by_maximum(spark):
    visits = spark.createDataFrame(
        [(1, 9, T0, 0), (1, 2, T0 + timedelta(days=1), 1), (2, 3, T0, 1)],
        "subject_id int, hadm_id int, admittime timestamp, flag int",
    )
    people = spark.createDataFrame([(1,), (2,), (3,)], "subject_id int")
    first = J.join_first_outcome(people, visits, "subject_id", ["admittime", "hadm_id"], "flag")
    assert rows(first, "subject_id") == [(1, 0), (2, 1), (3, None)]
    anyhow = J.join_first_outcome(people, visits, "subject_id", ["admittime"], "flag", mode="any")
    assert rows(anyhow, "subject_id") == [(1, 1), (2, 1), (3, None)]


def test_semi_membership(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    assert rows(J.semi_membership(df, "k", [1, 2]), "k") == [(1,), (2,), (2,)]
    other = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(J.semi_membership(df, "k", other)) == [(2,), (2,)]


def test_hot_entity_is_split_by_the_adaptive_plan(spark):
    """One entity holds most events: its join partition is split although an aggregation follows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 60000, 1, 8)
        events = ids.select(
            F.when(F.col("id") < 40000, F.lit(1)).otherwise(F.col("id")).alias("hadm_id"),
            (F.col("id") % 3).alias("itemid"),
            F.timestamp_seconds(F.lit(1_000_000) + F.col("id") % 3600).alias("charttime"),
            F.rand(1).alias("v"),
        )
        anchors = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("hadm_id"), F.timestamp_seconds(F.lit(1_000_000)).alias("admittime")
        )
        joined = J.anchored_window_join(events, anchors, "hadm_id", "charttime", "admittime")
        out = joined.groupBy("hadm_id", "itemid").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v"))
        plan = executed_plan(out)
        assert "skew=true" in plan
        hot = {r.itemid: r.n for r in out.where("hadm_id = 1").collect()}
        assert sum(hot.values()) == 40000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
