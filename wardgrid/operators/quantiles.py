"""Exact quantiles with linear interpolation, without gathering a group's values in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here selection works from coarse to fine, one route for every size:

1. values are counted in ordered cells (a fixed number per power of two of the value), with map-side
   combine, so a task passes on a few counters per group however many rows it reads; running totals
   over the cells show which ones hold a wanted rank;
2. only values of those cells are counted one by one, inside finer cells of equal width.  Totals of
   the finer cells narrow the rank down again, and a running count over just that cell reads the
   order statistics off.

``column_quantiles`` does the same for the columns of a wide table, where nearly all values can be left out of step 2 by
comparing them with the bounds of the cells that step 1 found.

Cells are functions of the value alone, so the result is exact and repeatable, and no sketch can miss.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import ident, literal, order_cell
from wardgrid.session import staged

# Coarse cells per power of two, and finer cells in each coarse cell that holds a wanted rank.
OCTAVE_CELLS = 256
CELLS = 4096
# Groups up to this many broadcast safely: a target row holds a few numbers.
MAX_BROADCAST_GROUPS = 10_000


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    by: Iterable[str] = (),
    max_groups: int | None = None,
    extra: Iterable[Column] = (),
) -> DataFrame:
    """One row per group with a column per named probability, plus any ``extra`` aggregates.

    ``max_groups`` is a bound the caller can prove (keys filtered to a fixed list) and allows a
    broadcast.  The input is scanned twice, and once more for extras.  Missing values and NaN are
    skipped and rows with a missing key dropped; a group without any value has no row (without keys:
    one row of NULLs).
    """
    by, extra = list(by), list(extra)
    keyed = df.na.drop(subset=by) if by else df
    rows = keyed.selectExpr(
        *[ident(k) for k in by], f"cast({ident(value)} as double) as _v"
    ).where("_v is not null and not isnan(_v)")
    probs = [float(p) for p in probabilities.values()]
    found = _read_off(_finest(rows, _coarse(rows, by, probs), by, probs, max_groups), by, probabilities)
    if not extra:
        return found
    # Columns in the order: keys, extras, quantiles.
    names = list(probabilities)
    extras = keyed.groupBy(*by).agg(*extra)
    if by:
        own = [c for c in extras.columns if c not in by]
        return extras.join(found, by).select(*by, *own, *names)
    whole = found.select(F.struct(*names).alias("_q")).scalar()
    own = extras.columns
    return extras.withColumn("_q", whole).select(*own, *[f"_q.{c}" for c in names])


def _read_off(placed: DataFrame, by: list[str], probabilities: Mapping[str, float]) -> DataFrame:
    """The quantiles, interpolated between the order statistics next to each wanted position."""
    picks, out = [F.expr("max(_n) as _n")], []
    for name, p in probabilities.items():
        position = f"((_n - 1) * {literal(float(p))})"
        for side, rank in (("a", f"floor{position}"), ("b", f"ceil{position}")):
            here = f"{rank} >= _upto - _c and {rank} < _upto"
            picks.append(F.expr(f"min(case when {here} then _v end) as {ident(f'_{side}_{name}')}"))
        a, b = ident(f"_a_{name}"), ident(f"_b_{name}")
        # Between equal neighbours nothing is interpolated (infinite values stay what they are).
        between = f"{a} + ({b} - {a}) * ({position} - floor{position})"
        out.append(F.expr(f"case when {a} = {b} then {a} else {between} end as {ident(name)}"))
    return placed.groupBy(*by).agg(*picks).select(*by, *out)


def column_quantiles(df: DataFrame, cols: Iterable[str], p: float) -> DataFrame:
    """One row holding the exact quantile of every column; NULL for a column without any value.

    The cells that hold the wanted ranks (two rows per column at most) are found first and written.  Their bounds then
    stand in the second scan as constants: a column's other values are compared with two numbers and go no further.
    """
    cols = list(cols)
    numbers = [F.col(ident(c)).cast("double") for c in cols]

    def long(values: list[Column]) -> DataFrame:
        return df.select(F.posexplode(F.array(*values)).alias("_column", "_v")).where("_v is not null and not isnan(_v)")

    coarse = staged(_coarse(long(numbers), ["_column"], [p]), "cells")
    # The two ranks are neighbours, so no value lies between their cells.  Equal bounds are the quantile itself.
    found = coarse.groupBy("_column").agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).collect()
    known = {r["_column"]: F.lit(r["lo"]) for r in found if r["lo"] == r["hi"]}
    open_ = {r["_column"]: (F.lit(r["lo"]), F.lit(r["hi"])) for r in found if r["lo"] != r["hi"]}
    near = [F.when(v.between(*open_[k]), v) if k in open_ else F.lit(None).cast("double") for k, v in enumerate(numbers)]
    # Ties with the quantile may be most of the rows (filled gaps), so values are counted before anything else.
    counted = long(near).groupBy("_column", "_v").agg(F.expr("count(1) as _times"))
    rows = _read_off(_finest(counted, coarse, ["_column"], [p], len(cols), "_times"), ["_column"], {"_quantile": p})
    read = [F.expr(f"max(case when _column = {k} then _quantile end)") for k in range(len(cols))]
    return rows.agg(*[known.get(k, read[k]).alias(c) for k, c in enumerate(cols)])


def _wanted(probs: list[float]) -> str:
    """Whether a cell holds a wanted rank."""
    ranks = [f"{side}((_n - 1) * {literal(p)})" for p in probs for side in ("floor", "ceil")]
    return " or ".join(f"({r} >= _upto - _c and {r} < _upto)" for r in ranks)


def _running(partition: list[str], order: str, total: bool = False) -> str:
    within = f"partition by {', '.join(partition)} " if partition else ""
    return f"sum(_c) over ({within}" + (")" if total else f"order by {order} rows between unbounded preceding and current row)")


def _coarse(rows: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """The coarse cells that hold a wanted rank, with the number of values before each."""
    keys = [ident(k) for k in by]
    # A few thousand cells per group at most reach this window.
    return (
        rows.selectExpr("*", f"{order_cell('_v', OCTAVE_CELLS)} as _coarse")
        .groupBy(*by, "_coarse")
        .agg(F.expr("count(1) as _c"), F.expr("min(_v) as _lo"), F.expr("max(_v) as _hi"))
        .selectExpr("*", f"{_running(keys, '_coarse')} as _upto", f"{_running(keys, '', total=True)} as _n")
        .where(_wanted(probs))
        .selectExpr(*keys, "_coarse", "_n", "_lo", "_hi", "_upto - _c as _before")
    )


def _finest(
    rows: DataFrame, coarse: DataFrame, by: list[str], probs: list[float], max_groups: int | None,
    times: str | None = None,
) -> DataFrame:
    """The values of the finest cells that hold a wanted rank, with the number of values up to each.

    ``times`` names the column that says how often a row's value occurs, if rows are counted already.
    """
    own, count = ([], "count(1)") if times is None else ([times], f"sum({times})")
    keys = [ident(k) for k in by]
    wanted = _wanted(probs)
    bounded = not by or (max_groups is not None and max_groups <= MAX_BROADCAST_GROUPS)
    share = f"nanvl((_v - _lo) / (_hi - _lo) * {CELLS}, 0)"
    fine = f"cast(case when _hi > _lo then least({CELLS - 1}, floor({share})) else 0 end as int)"
    values = (
        rows.selectExpr("*", f"{order_cell('_v', OCTAVE_CELLS)} as _coarse")
        .join(F.broadcast(coarse) if bounded else coarse, [*by, "_coarse"])
        .selectExpr(*keys, "_n", "_coarse", "_before", f"{fine} as _fine", "_v", *own)
        .groupBy(*by, "_n", "_coarse", "_before", "_fine", "_v")
        .agg(F.expr(f"{count} as _c"))
    )
    cell = [*keys, "_coarse"]
    targets = (
        values.groupBy(*by, "_n", "_coarse", "_before", "_fine")
        .agg(F.expr("sum(_c) as _c"))
        .selectExpr(*keys, "_n", "_coarse", "_fine", "_c", f"_before + {_running(cell, '_fine')} as _upto")
        .where(wanted)
        .selectExpr(*keys, "_coarse", "_fine", "_upto - _c as _start")
    )
    return values.join(F.broadcast(targets) if bounded else targets, [*by, "_coarse", "_fine"]).selectExpr(
        *keys, "_n", "_v", "_c", f"_start + {_running([*cell, '_fine'], '_v')} as _upto"
    )


def exact_median(df: DataFrame, value: str, alias: str = "median") -> Column:
    """The exact median of a column as a scalar subquery."""
    return exact_quantiles(df, value, {alias: 0.5}).select(alias).scalar()
