"""Feature matrices: one row per admission (mortality) and one row per intensive-care stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.config import (
    ADMISSION_TYPES,
    COMORBIDITY_TABLE,
    FAHRENHEIT_CODES,
    FAHRENHEIT_CODES_AS_CODED,
    LAB_BOUNDS,
    LAB_SIGNALS,
    VITAL_BOUNDS,
    VITAL_SIGNALS,
)
from wardgrid.functions.columns import (
    clip_by_code,
    coalesce_codes,
    convert_unit_for_code,
    fill_flag,
    one_hot_fixed,
    safe_age,
)
from wardgrid.operators.aggregates import code_count
from wardgrid.operators.impute import median_impute
from wardgrid.operators.joins import (
    anchored_window_join,
    assemble_features,
    join_subject_demographics,
)
from wardgrid.operators.reshape import pivot_stats_wide, project_columns
from wardgrid.operators.scoring import prefix_match_score
from wardgrid.session import staged
from wardgrid.sources.scan import scan_filtered_events

STATS = ("min", "max", "mean")
LAB_COLUMNS = [f"{name}_{stat}" for name in LAB_SIGNALS.values() for stat in STATS]
VITAL_COLUMNS = [f"{name}_{stat}" for name in VITAL_BOUNDS for stat in STATS]


def demographics(patients: DataFrame, admissions: DataFrame) -> DataFrame:
    """One row per admission: label, age with its flag, gender and admission type indicators."""
    joined = join_subject_demographics(
        admissions.select(
            "hadm_id", "subject_id", "admittime", "dischtime", "admission_type", "hospital_expire_flag"
        ),
        patients.select("subject_id", "dob", "gender"),
        "subject_id",
    )
    age, imputed = safe_age("admittime", "dob")
    rows = joined.withColumns(
        {
            "hospital_expire_flag": fill_flag("hospital_expire_flag"),
            "age": age,
            "age_imputed": imputed,
            "gender_M": F.col("gender").eqNullSafe(F.lit("M")).cast("int"),
        }
    )
    rows = one_hot_fixed(rows, "admission_type", ADMISSION_TYPES, prefix="adm")
    return rows.select(
        "hadm_id", "subject_id", "admittime", "dischtime", "hospital_expire_flag", "age",
        "age_imputed", "gender_M", *[f"adm_{t}" for t in ADMISSION_TYPES],
    )


def lab_windows(labevents: DataFrame, admissions: DataFrame) -> DataFrame:
    """Clipped lab statistics of the first 24 hours per admission, before imputation."""
    labs = scan_filtered_events(labevents, "itemid", LAB_SIGNALS).select(
        "hadm_id", "itemid", "charttime", "valuenum"
    )
    inside = anchored_window_join(
        labs, admissions.select("hadm_id", "admittime"), "hadm_id", "charttime", "admittime"
    )
    clipped = clip_by_code(inside, "itemid", "valuenum", LAB_BOUNDS)
    return pivot_stats_wide(clipped, "hadm_id", "itemid", "valuenum", LAB_SIGNALS, STATS)


def vital_windows(
    chartevents: DataFrame, icustays: DataFrame, mode: str = "as_documented"
) -> DataFrame:
    """Clipped vital-sign statistics of the first 24 hours per stay, before imputation."""
    chart = scan_filtered_events(chartevents, "itemid", VITAL_SIGNALS, "error").select(
        "icustay_id", "itemid", "charttime", "valuenum"
    )
    inside = anchored_window_join(
        chart, icustays.select("icustay_id", "intime"), "icustay_id", "charttime", "intime"
    )
    low, high = VITAL_BOUNDS["temp"]
    celsius = convert_unit_for_code(
        inside,
        "itemid",
        "valuenum",
        FAHRENHEIT_CODES_AS_CODED if mode == "as_coded" else FAHRENHEIT_CODES,
        among=[code for code, name in VITAL_SIGNALS.items() if name == "temp"],
        low=low,
        high=high,
        mode=mode,
    )
    named = coalesce_codes(celsius, "itemid", VITAL_SIGNALS)
    clipped = clip_by_code(named, "signal", "valuenum", VITAL_BOUNDS)
    return pivot_stats_wide(
        clipped, "icustay_id", "signal", "valuenum", {name: name for name in VITAL_BOUNDS}, STATS
    )


def admission_matrix(
    patients: DataFrame, admissions: DataFrame, diagnoses: DataFrame, labevents: DataFrame
) -> DataFrame:
    """Mortality matrix: demographics, comorbidity score, imputed lab statistics per admission.

    The lab statistics are staged once: they are read for their medians and again for filling.
    Admissions without any lab row keep missing values for the residual fill at modelling time.
    """
    labs = staged(lab_windows(labevents, admissions), "lab-windows")
    score = prefix_match_score(
        diagnoses, "hadm_id", "icd9_code", COMORBIDITY_TABLE, alias="charlson_index"
    )
    return assemble_features(
        demographics(patients, admissions),
        [score, median_impute(labs, LAB_COLUMNS)],
        "hadm_id",
        zero_fill=["charlson_index"],
    )


def stay_matrix(
    patients: DataFrame,
    admissions: DataFrame,
    icustays: DataFrame,
    diagnoses: DataFrame,
    chartevents: DataFrame,
    mode: str = "as_documented",
) -> DataFrame:
    """Length-of-stay matrix: admission features, code count, imputed vital statistics per stay."""
    vitals = staged(vital_windows(chartevents, icustays, mode), "vital-windows")
    base = icustays.select("icustay_id", "hadm_id", "subject_id", "los")
    person = project_columns(
        demographics(patients, admissions), drop=["subject_id", "dischtime", "hospital_expire_flag"]
    )
    score = prefix_match_score(
        diagnoses, "hadm_id", "icd9_code", COMORBIDITY_TABLE, alias="charlson_index"
    )
    counts = code_count(diagnoses, "hadm_id", "icd9_code")
    wide = assemble_features(
        base,
        [person, score, counts, median_impute(vitals, VITAL_COLUMNS)],
        ["hadm_id", "hadm_id", "hadm_id", "icustay_id"],
        zero_fill=["charlson_index", "diag_count"],
    )
    return wide.select(
        "icustay_id", "hadm_id", "subject_id", "los", "admittime",
        *[c for c in person.columns if c not in ("hadm_id", "admittime")],
        "charlson_index", "diag_count", *VITAL_COLUMNS,
    )
