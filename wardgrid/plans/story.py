"""Cohort story: peak correlation, outcome comparison, outliers and aligned trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardgrid.config import STORY_BOUNDS, STORY_MARKERS, TRAJECTORY_ITEMS
from wardgrid.functions.columns import clip_by_code, fill_flag, outcome_label
from wardgrid.operators.aggregates import outcome_mean_peaks, outlier_outcome_count, peak_by_subject_item
from wardgrid.operators.joins import join_first_outcome
from wardgrid.operators.ranking import representative_subjects, top_outliers
from wardgrid.operators.reshape import min_non_null, pivot_peak_matrix
from wardgrid.operators.statistics import (
    aligned_trajectories,
    correlation_matrix,
    outlier_threshold_flag,
    strongest_pair,
    zscore_outliers,
)
from wardgrid.session import staged
from wardgrid.sources.scan import scan_filtered_events, scan_valid_measurements

FLAG = "hospital_expire_flag"


def cohort_story(
    labevents: DataFrame, admissions: DataFrame, icustays: DataFrame, outcome: str = "first"
) -> dict[str, DataFrame]:
    """All story tables.

    The (subject, item) peaks feed every chart, so they are staged once instead of scanning the
    events again for each of them.
    """
    markers = list(STORY_MARKERS)
    labs = scan_valid_measurements(scan_filtered_events(labevents, "itemid", markers), "valuenum")
    labs = clip_by_code(labs, "itemid", "valuenum", STORY_BOUNDS)
    peaks = staged(peak_by_subject_item(labs, "subject_id", "itemid", "valuenum"), "peaks")
    encounters = admissions.withColumn(FLAG, fill_flag(FLAG))

    def with_outcome(subjects: DataFrame) -> DataFrame:
        return join_first_outcome(
            subjects, encounters, "subject_id", ["admittime", "hadm_id"], FLAG, outcome
        )

    wide = pivot_peak_matrix(peaks, "subject_id", "itemid", "peak", STORY_MARKERS)
    correlation = correlation_matrix(
        min_non_null(wide, STORY_MARKERS.values(), 3), STORY_MARKERS.values()
    )
    outcomes = with_outcome(peaks.select("subject_id").distinct())
    listed = top_outliers(zscore_outliers(peaks, "subject_id", "itemid", "peak", markers), "subject_id")
    # A list of at most 20 subjects; staged because four outputs start from it.
    outliers = staged(
        outlier_threshold_flag(with_outcome(listed)).withColumn("outcome", outcome_label(FLAG)),
        "outliers",
    )
    chosen = representative_subjects(outliers, labs, encounters, FLAG)
    return {
        "correlation": correlation,
        "strongest_pair": strongest_pair(correlation),
        "outcome_mean_peaks": outcome_mean_peaks(peaks, outcomes, "subject_id", "itemid", "peak", FLAG),
        "outliers": outliers,
        "outlier_outcomes": outlier_outcome_count(outliers, FLAG),
        "representatives": chosen,
        "trajectories": aligned_trajectories(
            labs, chosen, icustays, encounters, TRAJECTORY_ITEMS, selected_bound=4
        ),
    }
