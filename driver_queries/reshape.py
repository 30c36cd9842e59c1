"""Reshaping and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    ENCOUNTERS,
    LAB_NAMES,
    LAB_WIDE,
    VITALS,
    WIDE,
    WINDOW_HOURS,
    encounters,
    labs,
    query,
    round_list,
    rounded,
    table,
    vitals,
)
from wardgrid.functions.columns import measured_flags
from wardgrid.operators import impute as I
from wardgrid.operators import reshape as R
from wardgrid.operators.joins import anchored_window_join
from wardgrid.operators.statistics import segmented_correlation
from wardgrid.session import staged


def lab_wide(spark, sf):
    """Window statistics per order: the driver-table form of the admission lab matrix."""
    inside = anchored_window_join(
        labs(spark, sf), encounters(spark, sf).select("hadm_id", "admittime"), "hadm_id",
        "charttime", "admittime", 0, WINDOW_HOURS,
    )
    return R.pivot_stats_wide(inside, "hadm_id", "itemid", "valuenum", LAB_NAMES)


@query("pivot_stats_wide", f"select hadm_id, {round_list(LAB_WIDE)} from {WIDE} w")
def _(spark, sf):
    return rounded(lab_wide(spark, sf), 4)


@query(
    "measured_flags",
    "select hadm_id, " + ", ".join(f"(lab{i}_mean is not null)::int as lab{i}_mean_measured" for i in range(1, 8))
    + f" from {WIDE} w",
)
def _(spark, sf):
    cols = [f"lab{i}_mean" for i in range(1, 8)]
    return measured_flags(lab_wide(spark, sf), cols).select("hadm_id", *[f"{c}_measured" for c in cols])


@query(
    "segmented_correlation",
    f"""select admission_type, count(lab1_mean + lab2_mean) as n, round(corr(lab1_mean, lab2_mean), 6) as r
    from {WIDE} w join {ENCOUNTERS} e on w.hadm_id = e.hadm_id group by admission_type""",
)
def _(spark, sf):
    typed = lab_wide(spark, sf).join(encounters(spark, sf).select("hadm_id", "admission_type"), "hadm_id")
    return rounded(segmented_correlation(typed, "admission_type", "lab1_mean", "lab2_mean"))


@query(
    "min_non_null",
    "select hadm_id, lab1_max, lab2_max, lab3_max, lab4_max "
    f"from {WIDE} w where (lab1_max is not null)::int + (lab2_max is not null)::int "
    "+ (lab3_max is not null)::int + (lab4_max is not null)::int >= 2",
)
def _(spark, sf):
    cols = [f"lab{i}_max" for i in range(1, 5)]
    return R.min_non_null(lab_wide(spark, sf).select("hadm_id", *cols), cols, 2)


@query(
    "append_rows",
    f"select subject_id, itemid, valuenum from {VITALS} v where itemid in ('click', 'view') union all "
    f"select subject_id, itemid, valuenum from {VITALS} v where itemid = 'error' union all "
    f"select subject_id, itemid, valuenum from {VITALS} v where itemid not in ('click', 'view', 'error')",
)
def _(spark, sf):
    rows = vitals(spark, sf).select("subject_id", "itemid", "valuenum")
    first, second = F.col("itemid").isin("click", "view"), F.col("itemid") == "error"
    return R.append_rows([rows.where(first), rows.where(second), rows.where(~first & ~second)])


@query(
    "project_columns",
    "select o_orderkey as encounter, o_totalprice as amount from orders",
)
def _(spark, sf):
    return R.project_columns(
        table(spark, sf, "orders"),
        keep=["o_orderkey", "o_totalprice", "o_orderdate"],
        drop=["o_orderdate"],
        rename={"o_orderkey": "encounter", "o_totalprice": "amount"},
    )


_MEDIANS = "(select " + ", ".join(f"median({c}) as {c}" for c in LAB_WIDE) + f" from {WIDE} w)"


@query(
    "median_impute",
    f"with w as (select * from {WIDE} x), m as (select * from {_MEDIANS} y) select w.hadm_id, "
    + ", ".join(f"round(coalesce(w.{c}, m.{c}), 4) as {c}" for c in LAB_WIDE)
    + " from w cross join m",
)
def _(spark, sf):
    wide = staged(lab_wide(spark, sf), "lab-windows")
    return rounded(I.median_impute(wide, LAB_WIDE), 4)


_PAIR = ["lab1_mean", "lab2_mean"]
_SPARSE = f"""(select e.o_orderkey as hadm_id, lab1_mean, lab2_mean, o_orderstatus from orders e
    left join {WIDE} w on e.o_orderkey = w.hadm_id)"""


def _sparse(spark, sf):
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("hadm_id"), "o_orderstatus")
    return staged(
        base.join(lab_wide(spark, sf).select("hadm_id", *_PAIR), "hadm_id", "left"), "sparse"
    )


@query(
    "residual_impute",
    f"""with s as (select * from {_SPARSE} x), m as (select median(lab1_mean) as a,
      median(lab2_mean) as b from s)
    select hadm_id, round(coalesce(lab1_mean, a), 4) as lab1_mean,
      round(coalesce(lab2_mean, b), 4) as lab2_mean from s cross join m""",
)
def _(spark, sf):
    filled = I.residual_impute(_sparse(spark, sf), _PAIR)
    return rounded(filled.select("hadm_id", *_PAIR), 4)


@query(
    "residual_impute_train_medians",
    f"""with s as (select * from {_SPARSE} x), m as (select median(lab1_mean) as a,
      median(lab2_mean) as b from s where o_orderstatus = 'F')
    select hadm_id, round(coalesce(lab1_mean, a), 4) as lab1_mean,
      round(coalesce(lab2_mean, b), 4) as lab2_mean from s cross join m""",
)
def _(spark, sf):
    sparse = _sparse(spark, sf)
    train = sparse.where(F.col("o_orderstatus") == "F")
    return rounded(I.residual_impute(sparse, _PAIR, fit_on=train).select("hadm_id", *_PAIR), 4)


@query(
    "zero_fill",
    "select o_orderkey, case o_orderstatus when 'F' then 1 else 0 end as flag from orders",
)
def _(spark, sf):
    flag = F.when(F.col("o_orderstatus") == "F", 1).alias("flag")
    return I.zero_fill(table(spark, sf, "orders").select("o_orderkey", flag), ["flag"])
