"""Cleaning scalars.  All of them are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.config import AGE_SENTINEL, BIRTH_CUTOFF

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_flag(flag: ColumnOrName) -> Column:
    """Missing flag becomes 0; integer result."""
    return F.coalesce(_col(flag), F.lit(0)).cast("int")


def clip_value(value: ColumnOrName, low: float, high: float) -> Column:
    """Clip to [low, high]; a missing value stays missing (plain greatest/least would invent a bound)."""
    value = _col(value)
    return F.when(
        value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value.cast("double")))
    )


def _switch(cases: list[tuple[Column, Column]], default: Column) -> Column:
    if not cases:
        return default
    first, *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*first)).otherwise(default)


def clip_by_code(df: DataFrame, item: str, value: str, bounds: Mapping) -> DataFrame:
    """Clip each item's value to that item's bounds; items without bounds are left alone."""
    cases = [(F.col(item) == code, clip_value(value, lo, hi)) for code, (lo, hi) in bounds.items()]
    return df.withColumn(value, _switch(cases, F.col(value)))


def filter_positive_target(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose target is above zero."""
    return df.where(F.col(col) > 0)


def filter_half_open_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Keep low < value <= high."""
    return df.where((F.col(col) > low) & (F.col(col) <= high))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Exact seconds (microsecond decimals) from start to end, for zoned and zoneless timestamps."""
    return (_col(end) - _col(start)).cast("interval second").cast("decimal(20,6)")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Hours from start to end as a double."""
    return seconds_between(start, end).cast("double") / F.lit(3600.0)


def safe_age(
    admit: ColumnOrName,
    birth: ColumnOrName,
    cutoff: str = BIRTH_CUTOFF,
    sentinel: float = AGE_SENTINEL,
) -> tuple[Column, Column]:
    """Age in years and its flag.

    Whole days / 365.25.  A birth date before the cutoff, or none, gives the sentinel age and flag 1.
    """
    known = F.coalesce(_col(birth) >= F.lit(cutoff).cast("timestamp_ntz"), F.lit(False))
    days = F.floor(seconds_between(birth, admit).cast("double") / F.lit(86400.0))
    age = F.when(known, days / F.lit(365.25)).otherwise(F.lit(float(sentinel)))
    return age, (~known).cast("int")


def one_hot_fixed(df: DataFrame, col: str, values: Iterable[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per listed value; unknown or missing gives all zeros."""
    stem = prefix if prefix is not None else col
    return df.withColumns({f"{stem}_{v}": F.col(col).eqNullSafe(F.lit(v)).cast("int") for v in values})


def measured_flags(df: DataFrame, cols: Iterable[str], suffix: str = "_measured") -> DataFrame:
    """One 0/1 column per listed column: was it measured at all.  Take these before any filling."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNotNull().cast("int") for c in cols})


def convert_unit_for_code(
    df: DataFrame,
    item: str,
    value: str,
    codes: Iterable,
    among: Iterable | None = None,
    low: float = 25.0,
    high: float = 45.0,
    mode: str = "as_documented",
) -> DataFrame:
    """Fahrenheit codes to Celsius, then clip; ``among`` limits the step to one signal's codes.

    ``as_documented`` converts before clipping.  ``as_coded`` clips first, which squeezes every
    Fahrenheit reading to the lower bound; it exists only to reproduce published matrices.
    """
    v = clip_value(value, low, high) if mode == "as_coded" else F.col(value).cast("double")
    celsius = (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
    result = clip_value(F.when(F.col(item).isin(list(codes)), celsius).otherwise(v), low, high)
    if among is not None:
        result = F.when(F.col(item).isin(list(among)), result).otherwise(F.col(value))
    return df.withColumn(value, result)


def coalesce_codes(df: DataFrame, item: str, mapping: Mapping, out: str = "signal") -> DataFrame:
    """Name the signal behind each device code; codes outside the mapping give NULL."""
    cases = [(F.col(item) == code, F.lit(name)) for code, name in mapping.items()]
    return df.withColumn(out, _switch(cases, F.lit(None).cast("string")))


def normalise_category(col: ColumnOrName, upper: bool = True) -> Column:
    """Trimmed (and upper-cased) text; a missing category is kept as the text ``nan``."""
    text = F.trim(F.coalesce(_col(col).cast("string"), F.lit("nan")))
    return F.upper(text) if upper else text


def coerce_numeric(col: ColumnOrName) -> Column:
    """Number, or NULL when the text is not a number."""
    number = _col(col).try_cast("double")
    return F.when(~F.isnan(number), number)


def label_or_code(title: ColumnOrName, code: ColumnOrName) -> Column:
    """Lookup title, else the code itself; a missing code shows as the text ``nan``."""
    return F.coalesce(_col(title), _col(code).cast("string"), F.lit("nan"))


def log1p_target(col: ColumnOrName) -> Column:
    return F.log1p(_col(col))


def expm1(col: ColumnOrName) -> Column:
    return F.expm1(_col(col))


def uln_ratio(value: ColumnOrName, upper_limit: float) -> Column:
    """Value as a multiple of the upper limit of normal."""
    return _col(value) / F.lit(float(upper_limit))


def outcome_label(flag: ColumnOrName) -> Column:
    """0/1 as Survived/Deceased; anything else stays missing."""
    return F.when(_col(flag) == 0, F.lit("Survived")).when(_col(flag) == 1, F.lit("Deceased"))
