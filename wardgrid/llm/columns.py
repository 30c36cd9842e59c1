"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often (or in whatever lambda) the body uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Runs of characters other than space and 09-0D; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def null_safe(left: list[Column], right: list[Column]) -> Column:
    """Equality of key lists in which NULL equals NULL."""
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & a.eqNullSafe(b)
    return condition


def shielded(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns an operator doesn't use under names that clash with nothing, and the way back."""
    own = {c: f"own {k}" for k, c in enumerate(docs.columns) if c not in used}

    def restored(result: DataFrame) -> DataFrame:
        return result.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])

    return docs.withColumnsRenamed(own), restored
