"""Projections, filters and cleaning scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    ENCOUNTERS,
    FLAG_SQL,
    LABS,
    STAYS,
    VITALS,
    encounters,
    labs,
    query,
    rounded,
    stays,
    table,
    vitals,
)
from wardgrid.functions import columns as C

BOUNDS = {1: (10000, 50000), 2: (20000, 60000), 3: (0, 40000)}


@query("fill_flag", f"select hadm_id, coalesce(flag, 0) as flag from {ENCOUNTERS} e")
def _(spark, sf):
    return encounters(spark, sf).select("hadm_id", C.fill_flag("flag").alias("flag"))


@query("filter_positive_target", f"select hadm_id, los from {STAYS} s where los > 0")
def _(spark, sf):
    return C.filter_positive_target(stays(spark, sf), "los").select("hadm_id", "los")


@query(
    "filter_half_open_range",
    f"select subject_id, itemid, valuenum from {VITALS} v where valuenum > 5 and valuenum <= 60",
)
def _(spark, sf):
    kept = C.filter_half_open_range(vitals(spark, sf), "valuenum", 5.0, 60.0)
    return kept.select("subject_id", "itemid", "valuenum")


@query(
    "clip_by_code",
    "select hadm_id, itemid, case "
    + " ".join(
        f"when itemid = {i} and valuenum is not null then greatest({lo}.0, least({hi}.0, valuenum))"
        for i, (lo, hi) in BOUNDS.items()
    )
    + f" else valuenum end as valuenum from {LABS} l",
)
def _(spark, sf):
    clipped = C.clip_by_code(labs(spark, sf), "itemid", "valuenum", BOUNDS)
    return clipped.select("hadm_id", "itemid", "valuenum")


@query(
    "safe_age",
    """select l_orderkey, l_linenumber,
    round(case when birth >= timestamp '1996-01-01'
      then date_diff('day', birth, o_orderdate) / 365.25 else 91.0 end, 6) as age,
    case when birth >= timestamp '1996-01-01' then 0 else 1 end as age_imputed
    from (select l_orderkey, l_linenumber, o_orderdate,
      case when l_discount <> 0 then l_shipdate end as birth
      from lineitem join orders on l_orderkey = o_orderkey) b""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") != 0, F.col("l_shipdate")).alias("birth"),
    )
    joined = lines.join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"),
        "l_orderkey",
    )
    age, imputed = C.safe_age("o_orderdate", "birth", cutoff="1996-01-01")
    return rounded(joined.select("l_orderkey", "l_linenumber", age.alias("age"), imputed.alias("age_imputed")))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@query(
    "one_hot_fixed",
    "select hadm_id, "
    + ", ".join(
        f"case when admission_type = '{p}' then 1 else 0 end as \"type_{p}\"" for p in PRIORITIES
    )
    + f" from {ENCOUNTERS} e",
)
def _(spark, sf):
    wide = C.one_hot_fixed(encounters(spark, sf), "admission_type", PRIORITIES, prefix="type")
    return wide.select("hadm_id", *[f"type_{p}" for p in PRIORITIES])


UNITS = ("MAIL", "SHIP", "AIR", "RAIL")


@query(
    "unit_one_hot",
    "select hadm_id, " + ", ".join(f"case when unit = '{u}' then 1 else 0 end as \"unit_{u}\"" for u in UNITS)
    + " from (select l_orderkey as hadm_id, case when l_linenumber = 1 then 'MAIL' when l_linenumber = 2 then 'SHIP' "
    "when l_linenumber = 3 then 'AIR' when l_linenumber = 4 then 'RAIL' end as unit from lineitem) u",
)
def _(spark, sf):
    number = F.col("l_linenumber")
    unit = F.when(number == 1, "MAIL").when(number == 2, "SHIP").when(number == 3, "AIR").when(number == 4, "RAIL")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("hadm_id"), unit.alias("unit"))
    return C.one_hot_fixed(rows, "unit", UNITS).drop("unit")


CLIPPED = "greatest(25.0, least(45.0, {v}))"


@query(
    "convert_unit_for_code",
    "select event_id, round(" + CLIPPED.format(
        v="case when event_type = 'click' then (value - 32.0) * 5.0 / 9.0 else value end"
    ) + ", 6) as value from events",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    out = C.convert_unit_for_code(events, "event_type", "value", ["click"])
    return rounded(out.select("event_id", "value"))


@query(
    "convert_unit_for_code_as_coded",
    "select event_id, round(" + CLIPPED.format(
        v="case when event_type = 'click' then (" + CLIPPED.format(v="value")
        + " - 32.0) * 5.0 / 9.0 else " + CLIPPED.format(v="value") + " end"
    ) + ", 6) as value from events",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    out = C.convert_unit_for_code(events, "event_type", "value", ["click"], mode="as_coded")
    return rounded(out.select("event_id", "value"))


SIGNALS = {"click": "touch", "view": "touch", "purchase": "sale"}


@query(
    "coalesce_codes",
    "select event_id, case event_type when 'click' then 'touch' when 'view' then 'touch' "
    "when 'purchase' then 'sale' end as signal from events",
)
def _(spark, sf):
    out = C.coalesce_codes(table(spark, sf, "events"), "event_type", SIGNALS)
    return out.select("event_id", "signal")


@query(
    "normalise_category",
    "select o_orderkey, upper(trim(coalesce(category, 'nan'))) as category from (select o_orderkey, "
    "case when o_orderstatus <> 'P' then '  ' || lower(o_orderpriority) || ' ' end as category "
    "from orders) c",
)
def _(spark, sf):
    raw = F.when(
        F.col("o_orderstatus") != "P", F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", C.normalise_category(raw).alias("category")
    )


@query(
    "coerce_numeric",
    "select o_orderkey, try_cast(case when o_orderstatus = 'P' then 'x' || o_custkey "
    "else cast(o_custkey as varchar) end as double) as number from orders",
)
def _(spark, sf):
    text = F.col("o_custkey").cast("string")
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), text)).otherwise(text)
    return table(spark, sf, "orders").select("o_orderkey", C.coerce_numeric(raw).alias("number"))


@query(
    "label_or_code",
    "select p_partkey, coalesce(case when p_size < 25 then p_name end, "
    "case when p_size < 45 then p_brand end, 'nan') as label from part",
)
def _(spark, sf):
    title = F.when(F.col("p_size") < 25, F.col("p_name"))
    code = F.when(F.col("p_size") < 45, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", C.label_or_code(title, code).alias("label"))


@query(
    "log1p_target",
    "select event_id, round(ln(1 + value), 6) as log_value from events",
)
def _(spark, sf):
    return rounded(
        table(spark, sf, "events").select("event_id", C.log1p_target("value").alias("log_value"))
    )


@query(
    "expm1",
    "select l_orderkey, l_linenumber, round(exp(l_discount) - 1, 6) as back from lineitem",
)
def _(spark, sf):
    return rounded(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", C.expm1("l_discount").alias("back")
        )
    )


@query(
    "uln_ratio",
    f"select subject_id, itemid, charttime, round(valuenum / 40.0, 6) as ratio from {VITALS} v",
)
def _(spark, sf):
    return rounded(
        vitals(spark, sf).select(
            "subject_id", "itemid", "charttime", C.uln_ratio("valuenum", 40.0).alias("ratio")
        )
    )


@query(
    "outcome_label",
    f"select o_orderkey, case {FLAG_SQL} when 0 then 'Survived' when 1 then 'Deceased' end as outcome "
    "from orders",
)
def _(spark, sf):
    return encounters(spark, sf).select(
        F.col("hadm_id").alias("o_orderkey"), C.outcome_label("flag").alias("outcome")
    )
