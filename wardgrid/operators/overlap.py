"""Joins of intervals that overlap, as equi joins on time buckets.

An interval is put into buckets as wide as itself, of a fixed hierarchy of widths, so it lies in at most two of them however
long it is.  Two intervals meet at the wider one's level: each side is keyed at its own level and at those
wider levels that the other side uses.  The equality keys are (entity, level, bucket), so a busy entity is spread over
its buckets; a pair that shares two buckets is kept in the one where its overlap begins, so nothing has to be made distinct.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.config import ALT_MULTIPLE, BILIRUBIN_MULTIPLE, ULN_ALT, ULN_BILIRUBIN
from wardgrid.operators.scoring import edish_quadrant

HOUR = 3_600_000_000  # microseconds
FACTOR = 8  # from one width to the next
LEVELS = 11  # of hours the widest is longer than the range of timestamps
OPEN_END = 253_402_300_799_999_999  # the last microsecond of the year 9999


def _widths(finest_hours: float) -> list[int]:
    return [int(finest_hours * HOUR) * FACTOR**k for k in range(LEVELS)]


def _keyed(df: DataFrame, start: str, end: str, side: str, widths: list[int]) -> DataFrame:
    first = F.unix_micros(F.col(start).cast("timestamp"))
    last = F.coalesce(F.unix_micros(F.col(end).cast("timestamp")), F.lit(OPEN_END))
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(F.col(f"_{side}1") - F.col(f"_{side}0") <= widths[k], k).otherwise(level)
    timed = df.withColumns({f"_{side}0": first, f"_{side}1": last})
    # A missing start and an end before the start overlap with nothing.
    return timed.where(F.col(f"_{side}0") <= F.col(f"_{side}1")).withColumn(f"_{side}_level", level)


def _levels(keyed: DataFrame, side: str) -> set[int]:
    return {r[0] for r in keyed.select(f"_{side}_level").distinct().collect()}  # at most LEVELS


def _bucket(micros: Column, width: Column | int) -> Column:
    return F.floor(micros / width)


def _at_level(k: int) -> Callable[[Column], Column]:
    return lambda bucket: F.struct(F.lit(k).alias("level"), bucket.alias("bucket"))


def _bucketed(keyed: DataFrame, side: str, others: set[int], widths: list[int]) -> DataFrame:
    own = F.col(f"_{side}_level")
    entries = [
        F.when(
            (own == k) | (own < k) & F.lit(k in others),
            F.transform(
                F.sequence(_bucket(F.col(f"_{side}0"), widths[k]), _bucket(F.col(f"_{side}1"), widths[k])),
                _at_level(k),
            ),
        ).otherwise(F.array().cast("array<struct<level:int,bucket:bigint>>"))
        for k in range(LEVELS)
    ]
    return keyed.withColumn("_key", F.explode(F.flatten(F.array(*entries)))).withColumns({"_level": F.col("_key.level"), "_bucket": F.col("_key.bucket")}).drop("_key")


def overlap_join(
    left: DataFrame, right: DataFrame, on: str | Iterable[str], left_span: tuple[str, str], right_span: tuple[str, str],
    finest_hours: float = 1.0,
) -> DataFrame:
    """Every pair of rows with equal ``on`` columns whose closed intervals share an instant, once.

    A span names the start and end columns (one column twice for instants).  A missing end is open; a missing start
    or key, and an end before its start, match nothing.  Column names other than the keys must differ.  The levels in use are
    read first, at most ``LEVELS`` numbers per side.
    """
    keys, widths = [on] if isinstance(on, str) else list(on), _widths(finest_hours)
    a, b = _keyed(left, *left_span, "l", widths), _keyed(right, *right_span, "r", widths)
    used_a, used_b = _levels(a, "l"), _levels(b, "r")
    pairs = _bucketed(a, "l", used_b, widths).join(_bucketed(b, "r", used_a, widths), [*keys, "_level", "_bucket"])
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("_level") + 1)
    begins = F.greatest("_l0", "_r0")
    kept = pairs.where(
        (F.greatest("_l_level", "_r_level") == F.col("_level"))
        & (F.col("_l0") <= F.col("_r1")) & (F.col("_r0") <= F.col("_l1"))
        & (F.col("_bucket") == _bucket(begins, width))
    )
    return kept.select(*keys, *[f"`{c}`" for c in [*left.columns, *right.columns] if c not in keys])


def drug_lab_link(
    prescriptions: DataFrame, labs: DataFrame, subject: str, drug: str, start: str, stop: str,
    item: str, value: str, ts: str, item_a, item_b, uln_a: float = ULN_ALT, uln_b: float = ULN_BILIRUBIN, abnormal: bool = True,
) -> DataFrame:
    """Liver measurements taken while a drug was prescribed, with their multiple of the upper limit (``ratio``).

    ``abnormal`` keeps only those above the limit.  A prescription without an end runs on; a measurement under several
    prescriptions appears with each.
    """
    limit = F.when(F.col(item) == item_a, F.lit(float(uln_a))).otherwise(F.lit(float(uln_b)))
    marked = labs.where(F.col(item).isin(item_a, item_b)).select(subject, item, ts, value, (F.col(value) / limit).alias("ratio"))
    if abnormal:
        marked = marked.where(F.col("ratio") > 1)
    given = prescriptions.where(F.col(drug).isNotNull()).select(subject, drug, start, stop)
    return overlap_join(given, marked, subject, (start, stop), (ts, ts))


def drug_quadrants(
    linked: DataFrame, subject: str, drug: str, item: str, value: str, item_a, item_b, uln_a: float = ULN_ALT, uln_b: float = ULN_BILIRUBIN,
    x_a: float = ALT_MULTIPLE, x_b: float = BILIRUBIN_MULTIPLE,
) -> DataFrame:
    """Per drug and quadrant the subjects that have both markers under the drug; link with ``abnormal=False``."""
    peaks = linked.groupBy(drug, subject).agg(
        F.max(F.when(F.col(item) == item_a, F.col(value))).alias("peak_a"), F.max(F.when(F.col(item) == item_b, F.col(value))).alias("peak_b")
    )
    both = peaks.where(F.col("peak_a").isNotNull() & F.col("peak_b").isNotNull())
    placed = edish_quadrant(both, "peak_a", "peak_b", uln_a, uln_b, x_a, x_b)
    return placed.groupBy(drug, "quadrant").agg(F.count(F.lit(1)).alias("n_subjects"))
