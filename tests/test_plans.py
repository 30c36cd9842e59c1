"""Whole analyses on the hand-made hospital, checked against plain Python."""

from __future__ import annotations

import statistics
from functools import partial

import pytest
from hospital import tables
from pyspark.sql import functions as F

from wardgrid.config import COMORBIDITY_TABLE, LAB_BOUNDS, LAB_SIGNALS
from wardgrid.operators import models as M
from wardgrid.plans import descriptive, features, modelling, safety, story
from wardgrid.session import staged, staging_path
from wardgrid.sources.scan import load_tables, read_feature_matrix
from wardgrid.sources.sinks import write_feature_matrix, write_model_results


@pytest.fixture(scope="module")
def hospital(spark):
    return {name: staged(df, name.lower()) for name, df in tables(spark).items()}


@pytest.fixture(scope="module")
def matrix_a(hospital):
    return staged(
        features.admission_matrix(
            hospital["PATIENTS"], hospital["ADMISSIONS"], hospital["DIAGNOSES_ICD"], hospital["LABEVENTS"]
        )
    )


@pytest.fixture(scope="module")
def matrix_b(hospital):
    return staged(
        features.stay_matrix(
            hospital["PATIENTS"], hospital["ADMISSIONS"], hospital["ICUSTAYS"],
            hospital["DIAGNOSES_ICD"], hospital["CHARTEVENTS"],
        )
    )


def test_admission_matrix_against_plain_python(hospital, matrix_a):
    admissions = hospital["ADMISSIONS"].collect()
    admit = {a.hadm_id: a.admittime for a in admissions}
    inside: dict = {}
    for e in hospital["LABEVENTS"].collect():
        hours = (e.charttime - admit[e.hadm_id]).total_seconds() / 3600
        if e.itemid in LAB_SIGNALS and 0 <= hours <= 24:
            low, high = LAB_BOUNDS[e.itemid]
            cell = inside.setdefault(e.hadm_id, {}).setdefault(LAB_SIGNALS[e.itemid], [])
            if e.valuenum is not None:
                cell.append(min(max(e.valuenum, low), high))
    stats = {"min": min, "max": max, "mean": statistics.fmean}
    wide = {
        h: {f"{n}_{k}": f(v[n]) if v.get(n) else None for n in LAB_SIGNALS.values() for k, f in stats.items()}
        for h, v in inside.items()
    }
    medians = {c: statistics.median(w[c] for w in wide.values() if w[c] is not None) for c in features.LAB_COLUMNS}
    codes: dict = {}
    for d in hospital["DIAGNOSES_ICD"].collect():
        codes.setdefault(d.hadm_id, []).append((d.icd9_code or "").strip())
    got = matrix_a.collect()
    assert len(got) == len(admissions)
    for r in got:
        score = sum(
            w for w, prefixes in COMORBIDITY_TABLE.values()
            if any(c.startswith(p) for c in codes.get(r.hadm_id, []) if c for p in prefixes)
        )
        assert r.charlson_index == score
        for c in features.LAB_COLUMNS:
            if r.hadm_id not in wide:
                assert r[c] is None
            else:
                want = wide[r.hadm_id][c]
                assert r[c] == pytest.approx(medians[c] if want is None else want)
    assert matrix_a.columns[:11] == [
        "hadm_id", "subject_id", "admittime", "dischtime", "hospital_expire_flag", "age", "age_imputed",
        "gender_M", "adm_EMERGENCY", "adm_ELECTIVE", "adm_URGENT",
    ]
    assert len(matrix_a.columns) == 33


def test_stay_matrix_shape_and_temperature_modes(hospital, matrix_b):
    assert len(matrix_b.columns) == 31 and matrix_b.count() == hospital["ICUSTAYS"].count()
    temps = matrix_b.where("temp_min is not null").agg(F.min("temp_min"), F.max("temp_max")).first()
    assert 32 < temps[0] and temps[1] < 41
    old = features.vital_windows(hospital["CHARTEVENTS"], hospital["ICUSTAYS"], mode="as_coded")
    seen = {v for r in old.select("temp_min", "temp_max").collect() for v in r if v is not None}
    assert seen <= {25.0, 45.0}
    assert matrix_b.where("diag_count = 0").count() > 0


def test_descriptive_and_health_reports(hospital):
    report = {**descriptive.health_report(hospital), **descriptive.descriptive_report(hospital)}
    frames = {name: df.collect() for name, df in report.items()}
    assert all(frames.values())
    assert {r.table_name for r in frames["row_counts"]} == set(hospital)
    assert "NAN" in {r.admission_type for r in frames["mortality_by_type"]}
    assert "CCU" in {r.first_careunit for r in frames["stay_by_unit"]}
    rate = frames["mortality"][0]
    assert rate.n_positive + rate.n_negative == rate.n_total == hospital["ADMISSIONS"].count()


def test_safety_report(hospital):
    report = {name: df.collect() for name, df in safety.safety_report(hospital["LABEVENTS"]).items()}
    profile = report["profile"]
    assert len(profile) == sum(r.n for r in report["quadrants"])
    assert report["signal"][0].n_flagged == len(report["signal_members"])
    for r in profile:
        assert (r.quadrant == "Hy's Law") == (r.alt_peak > 120 and r.bili_peak > 2.4) == r.hys_law
    coded = safety.safety_report(hospital["LABEVENTS"], mode="as_coded")["blood_grades"].collect()
    assert 3 not in {r.grade for r in coded}


def test_cohort_story(hospital):
    report = {
        name: df.collect()
        for name, df in story.cohort_story(
            hospital["LABEVENTS"], hospital["ADMISSIONS"], hospital["ICUSTAYS"]
        ).items()
    }
    assert len(report["correlation"]) == 36 and len(report["outliers"]) == 20
    scores = [r.max_abs_z for r in sorted(report["outliers"], key=lambda r: -r.max_abs_z)]
    assert scores == sorted(scores, reverse=True)
    assert 2 <= len(report["representatives"]) <= 4
    assert {r.subject_id for r in report["trajectories"]} <= {r.subject_id for r in report["representatives"]}
    assert all(-6 <= r.hours <= 120 for r in report["trajectories"])
    first_flags = {}
    for a in sorted(hospital["ADMISSIONS"].collect(), key=lambda a: a.admittime):
        first_flags.setdefault(a.subject_id, a.hospital_expire_flag or 0)
    assert all(first_flags[r.subject_id] == r.hospital_expire_flag for r in report["outliers"])


DROP_A = ["hadm_id", "subject_id", "admittime", "dischtime"]


def test_mortality_study(spark, matrix_a):
    small = {
        "logistic": M.fit_logistic,
        "forest": partial(M.fit_random_forest, trees=8, depth=3),
        "boosted": partial(M.fit_gbt_classifier, rounds=4, depth=2),
    }
    out = modelling.mortality_study(matrix_a, "hospital_expire_flag", DROP_A, "hadm_id", small, k=2)
    metrics = {r.model: r for r in out["metrics"].collect()}
    assert set(metrics) == set(small)
    for r in metrics.values():
        assert 0 <= r.auroc <= 1 and 0 <= r.cv_auroc <= 1 and r.cv_auroc_sd >= 0
    assert out["best"].first().auroc == max(r.auroc for r in metrics.values())
    test_rows = out["predictions"].where("model = 'logistic'").count()
    assert out["confusion"].where("model = 'logistic'").agg(F.sum("n")).first()[0] == test_rows
    assert out["importance"]["forest"].count() == 28
    path = write_model_results(
        {"metrics": out["metrics"], "model": out["models"]["logistic"]}, staging_path(spark, "results")
    )
    assert spark.read.parquet(f"{path}/metrics").count() == 3


def test_stay_study(matrix_b):
    small = {"boosted": partial(M.fit_gbt_regressor, rounds=4, depth=2)}
    drop = ["icustay_id", "hadm_id", "subject_id", "admittime"]
    out = modelling.stay_study(matrix_b, "los", drop, "icustay_id", small, k=2, fit_on_train=True)
    metrics = {r.model: r for r in out["metrics"].collect()}
    assert set(metrics) == {"baseline", "boosted"}
    assert metrics["boosted"].cv_mae_log < metrics["boosted"].cv_mae_days
    assert metrics["baseline"].cv_mae_log is None
    assert out["best"].first().model == "boosted"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_matrix_round_trip(spark, matrix_a, fmt):
    path = write_feature_matrix(matrix_a, staging_path(spark, "matrix"), fmt)
    back = read_feature_matrix(spark, path, "hospital_expire_flag", DROP_A, matrix_a.schema, fmt)
    assert len(back.features) == 28 and back.data.count() == matrix_a.count()
    want = matrix_a.agg(F.sum("age"), F.count("bun_mean")).first()
    assert back.data.agg(F.sum("age"), F.count("bun_mean")).first() == pytest.approx(want)


def test_tables_load_from_csv_by_name(spark, hospital, tmp_path):
    # A file with more columns than declared, in another order, with text that must keep its zeros.
    (tmp_path / "DIAGNOSES_ICD.csv").write_text("row_id,icd9_code,hadm_id,subject_id\n1,042,7,3\n2,,8,3\n")
    (tmp_path / "LABEVENTS.csv").write_text(
        "row_id,subject_id,hadm_id,itemid,charttime,value,valuenum\n1,3,,50912,2164-10-23 21:09:00,x,NaN\n"
    )
    loaded = load_tables(spark, str(tmp_path), "csv")
    assert set(loaded) == {"DIAGNOSES_ICD", "LABEVENTS"}
    assert [tuple(r) for r in loaded["DIAGNOSES_ICD"].orderBy("hadm_id").collect()] == [(3, 7, "042"), (3, 8, None)]
    lab = loaded["LABEVENTS"].first()
    assert (lab.hadm_id, lab.valuenum, lab.charttime.year) == (None, None, 2164)
