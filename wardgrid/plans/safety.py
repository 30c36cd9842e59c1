"""Drug-safety signals from laboratory values: liver quadrant, kidney stage, blood grades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.config import ITEM_ALT, ITEM_BILIRUBIN, ITEM_CREATININE
from wardgrid.operators.aggregates import (
    baseline_peak_stats,
    class_distribution,
    grade_by_marker_counts,
    signal_members,
    signal_summary,
)
from wardgrid.operators.joins import inner_peaks, join_safety_profile
from wardgrid.operators.scoring import blood_grades_wide, edish_quadrant, kdigo_stage
from wardgrid.sources.scan import scan_valid_measurements


def safety_report(labevents: DataFrame, mode: str = "as_documented") -> dict[str, DataFrame]:
    """Per-subject profile and the distributions behind the safety charts."""
    labs = scan_valid_measurements(
        labevents.select("subject_id", "itemid", "valuenum"), "valuenum"
    )
    peaks = inner_peaks(
        labs, "subject_id", "itemid", "valuenum", ITEM_ALT, ITEM_BILIRUBIN, "alt_peak", "bili_peak"
    )
    quadrants = edish_quadrant(peaks, "alt_peak", "bili_peak").withColumnsRenamed(
        {"ratio_a": "alt_uln", "ratio_b": "bili_uln"}
    )
    kidney = kdigo_stage(
        baseline_peak_stats(labs.where(F.col("itemid") == ITEM_CREATININE), "subject_id", "valuenum"),
        alias="kdigo_stage",
    )
    grades = blood_grades_wide(labs, "subject_id", "itemid", "valuenum", mode=mode)
    return {
        "profile": join_safety_profile(quadrants, kidney, grades, "subject_id"),
        "quadrants": class_distribution(quadrants, "quadrant"),
        "kidney_stages": class_distribution(kidney, "kdigo_stage"),
        "blood_grades": grade_by_marker_counts(
            grades, "subject_id", ["wbc_grade", "hgb_grade", "plt_grade"]
        ),
        "signal": signal_summary(quadrants, "hys_law"),
        "signal_members": signal_members(quadrants, "hys_law", "subject_id"),
    }
