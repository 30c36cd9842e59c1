"""Deciding whether a derived side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.session import staged

MAX_BROADCAST_ROWS = 100_000


def sized(df: DataFrame, bound: int | None = None, name: str = "side") -> DataFrame:
    """Prepare a small derived side of a join.

    With a row bound the caller can prove (keys limited to a fixed list) the side is broadcast.
    Without one it is staged: the written size then decides between a broadcast and a shuffled join.
    """
    if bound is None:
        return staged(df, name)
    return F.broadcast(df) if bound <= MAX_BROADCAST_ROWS else df
