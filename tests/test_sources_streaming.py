import pytest
from conftest import rows

from wardgrid.session import shared_folder, staged
from wardgrid.sources import scan as S
from wardgrid.sources.schemas import TABLES
from wardgrid.streaming.ingest import ingest_filtered_events

EVENTS = "subject_id long, hadm_id long, icustay_id long, itemid long, charttime timestamp, valuenum double, error int"
DATA = [(1, 1, 1, 211, None, 80.0, None), (1, 1, 1, 211, None, 81.0, 0), (1, 1, 1, 211, None, 999.0, 1), (1, 1, 1, 5, None, 1.0, None)]


def test_event_filters(spark):
    df = spark.createDataFrame(DATA, EVENTS)
    assert rows(S.scan_filtered_events(df, "itemid", [211], "error").select("valuenum"), "valuenum") == [(80.0,), (81.0,)]
    assert S.scan_filtered_events(df, "itemid", [7], "error").count() == 0
    values = spark.createDataFrame([(0.0,), (None,), (float("nan"),), (-1.0,), (2.0,)], "v double")
    assert rows(S.scan_valid_measurements(values, "v")) == [(2.0,)]


def test_missing_file_and_missing_column(spark, tmp_path):
    assert S.scan_table(spark, str(tmp_path / "nothing.csv"), TABLES["PATIENTS"]) is None
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="subject_id"):
        S.scan_table(spark, str(tmp_path / "x.csv"), TABLES["PATIENTS"])


def test_filters_and_projection_reach_the_parquet_scan(spark, sf_dir):
    lines = S.scan_table(spark, f"{sf_dir}/lineitem.parquet", columns=["l_orderkey", "l_linenumber", "l_quantity"])
    kept = S.scan_filtered_events(lines, "l_linenumber", [1, 2]).select("l_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "In(l_linenumber, [1,2])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_staging_uses_the_session_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    df = staged(spark.range(5), "t")
    assert df.count() == 5
    assert shared_folder(spark).removeprefix("file:") in df.inputFiles()[0]


def test_incremental_ingest_reads_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    df = spark.createDataFrame(DATA, EVENTS)
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(source)
        ingest_filtered_events(
            spark, source, target, mark, TABLES["CHARTEVENTS"], "itemid", [211], "error", max_files=1
        ).awaitTermination()
    assert spark.read.parquet(target).count() == 4
