"""Column expressions and row-local cleaning steps."""

from wardgrid.functions.columns import (
    clip_by_code,
    clip_value,
    coalesce_codes,
    coerce_numeric,
    convert_unit_for_code,
    expm1,
    fill_flag,
    filter_half_open_range,
    filter_positive_target,
    hours_between,
    label_or_code,
    log1p_target,
    normalise_category,
    one_hot_fixed,
    outcome_label,
    safe_age,
    uln_ratio,
)

__all__ = [
    "clip_by_code",
    "clip_value",
    "coalesce_codes",
    "coerce_numeric",
    "convert_unit_for_code",
    "expm1",
    "fill_flag",
    "filter_half_open_range",
    "filter_positive_target",
    "hours_between",
    "label_or_code",
    "log1p_target",
    "normalise_category",
    "one_hot_fixed",
    "outcome_label",
    "safe_age",
    "uln_ratio",
]
