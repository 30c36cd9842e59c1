"""Cohort description: the tables behind the descriptive charts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wardgrid.config import HISTOGRAM_SPEC
from wardgrid.operators.aggregates import (
    bounded_histogram,
    overall_rate,
    rate_by_category,
    stay_by_unit,
    stay_histogram,
    top_k_titles,
)
from wardgrid.operators.profile import category_counts, flag_health, stay_health, table_row_counts


def health_report(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Load validation: row counts and the checks of the encounter and stay tables."""
    report = {"row_counts": table_row_counts(tables)}
    if "ADMISSIONS" in tables:
        report["flag_health"] = flag_health(tables["ADMISSIONS"], "hospital_expire_flag")
        report["admission_types"] = category_counts(tables["ADMISSIONS"], "admission_type")
    if "ICUSTAYS" in tables:
        report["stay_health"] = stay_health(tables["ICUSTAYS"], "los")
        report["care_units"] = category_counts(tables["ICUSTAYS"], "first_careunit")
    return report


def descriptive_report(tables: Mapping[str, DataFrame], coerce: bool = True) -> dict[str, DataFrame]:
    """The six descriptive tables; ``coerce`` cleans category text and numbers first."""
    return {
        "mortality": overall_rate(tables["ADMISSIONS"], "hospital_expire_flag"),
        "top_diagnoses": top_k_titles(
            tables["DIAGNOSES_ICD"], tables["D_ICD_DIAGNOSES"], "icd9_code", "long_title", "hadm_id"
        ),
        "stay_by_unit": stay_by_unit(tables["ICUSTAYS"], "first_careunit", "los", coerce),
        "mortality_by_type": rate_by_category(
            tables["ADMISSIONS"], "admission_type", "hospital_expire_flag", coerce
        ),
        "lab_distributions": bounded_histogram(
            tables["LABEVENTS"], "itemid", "valuenum", HISTOGRAM_SPEC
        ),
        "stay_distribution": stay_histogram(tables["ICUSTAYS"], "los"),
    }
