"""Repeatable exact splits and folds.

Rows are ordered by a hash of their id inside each class.  The wanted cut ranks are located with a
histogram over hash prefixes, so no class is ever sorted as a whole and the table itself is never
shuffled: each row only compares its own hash with the handful of cut values of its class.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardgrid.operators.sizing import sized
from wardgrid.session import staged

_PREFIX = 4  # hex digits: 65,536 evenly filled cells per class


def hash_key(id_col: str | list[str], seed: int) -> Column:
    """Sort key of a row: hash of seed and id, then the id itself.  A missing id counts as an empty text."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids]
    text = parts[0] if len(parts) == 1 else F.concat_ws(":", *parts)
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text)), F.lit(":"), text)


def _cuts(keyed: DataFrame, ranks: list[Column]) -> DataFrame:
    """Per class, the sort keys at the given ranks (ascending; rank 0 gives the empty text)."""
    # At most 65,536 cells per class; staged so that the steps below do not scan the rows again.
    cells = staged(keyed.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("_c")), "cells")
    mine = W.partitionBy("_class")
    placed = cells.withColumns(
        {
            "_n": F.sum("_c").over(mine),
            "_upto": F.sum("_c").over(
                mine.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
            ),
        }
    )
    wanted = F.explode(F.array(*[r.cast("long") for r in ranks])).alias("_rank")
    targets = (
        placed.select("_class", "_cell", "_upto", "_c", wanted)
        .where((F.col("_rank") > F.col("_upto") - F.col("_c")) & (F.col("_rank") <= F.col("_upto")))
        .select("_class", "_cell", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_need"))
    )
    # Only the cells that hold a cut are ranked row by row.  Cells that hold several cuts come once.
    needs = staged(
        targets.groupBy("_class", "_cell").agg(F.collect_list("_need").alias("_needs")), "cut-cells"
    )
    order = W.partitionBy("_class", "_cell").orderBy("_key")
    ranked = keyed.join(needs, ["_class", "_cell"]).withColumns(
        {"_rank": F.row_number().over(order), "_next": F.lead("_key").over(order)}
    )
    # Rows of one id stay together, so a cut inside them could not give the promised sizes.
    repeated = F.raise_error(F.lit("ids repeat at a cut of the split; give a list of columns that is unique"))
    sound = F.when(F.col("_next") == F.col("_key"), repeated.cast("boolean")).otherwise(F.lit(True))
    hits = F.filter("_needs", lambda need: (need == F.col("_rank")) & sound)
    found = ranked.select("_class", "_key", F.explode(hits)).select("_class", "_key")
    # A cut at rank 0 lies before every row.
    before_all = (
        placed.select("_class", "_n").distinct().select("_class", wanted).where(F.col("_rank") == 0)
    ).select("_class", F.lit("").alias("_key"))
    # One key per cut.
    return found.unionByName(before_all).groupBy("_class").agg(F.collect_list("_key").alias("_cuts"))


def _assign(
    df: DataFrame, id_col: str | list[str], strata: str | None, ranks: list[Column], seed: int,
    classes: Iterable | None = None,
) -> DataFrame:
    """``df`` with ``_part``: how many of its class's cut keys lie before each row."""
    # Without strata there is one class; a missing class forms a class of its own.
    cls = F.lit("all") if strata is None else F.coalesce(F.col(strata).cast("string"), F.lit(""))
    known = None if classes is None else [str(c) for c in classes]
    if known is not None and strata is not None:
        cls = F.when(cls.isin(known), cls).otherwise(F.lit(""))
    keyed = df.withColumns({"_class": cls, "_key": hash_key(id_col, seed)})
    narrow = keyed.select("_class", "_key", F.substring("_key", 1, _PREFIX).alias("_cell"))
    cuts = _cuts(narrow, ranks)
    if strata is None:
        keyed = keyed.withColumn("_cuts", cuts.select("_cuts").scalar())
    else:
        keyed = keyed.join(sized(cuts, None if known is None else len(known) + 1, "cuts"), "_class")
    # One term per cut: inside a lambda over the cuts the key would be hashed again for every one of them.
    part = sum(F.when(F.col("_key") > F.get("_cuts", F.lit(i)), 1).otherwise(0) for i in range(len(ranks)))
    return keyed.withColumn("_part", part).drop("_class", "_key", "_cuts")


def stratified_split(
    df: DataFrame,
    id_col: str | list[str],
    label: str,
    test: float = 0.2,
    seed: int = 42,
    classes: Iterable | None = None,
    out: str = "is_test",
) -> DataFrame:
    """Mark the test rows: in every class the share nearest to ``test``.

    ``id_col`` names the column, or the columns, that tell rows apart.  ``classes`` lists the class
    values when they are known and only proves a broadcast bound: rows with another value stay and
    share one further class.
    """
    return _split(df, id_col, label, test, seed, classes, out)


def random_split(
    df: DataFrame, id_col: str | list[str], test: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark the test rows: the share of all rows nearest to ``test``."""
    ranks = [F.floor(F.col("_n") * F.lit(float(test)) + F.lit(0.5))]
    marked = _assign(df, id_col, None, ranks, seed)
    return marked.withColumn(out, (F.col("_part") == 0).cast("int")).drop("_part")


def _split(df, id_col, label, test, seed, classes, out) -> DataFrame:
    ranks = [F.floor(F.col("_n") * F.lit(float(test)) + F.lit(0.5))]
    marked = _assign(df, id_col, label, ranks, seed, classes)
    return marked.withColumn(out, (F.col("_part") == 0).cast("int")).drop("_part")


def folds(
    df: DataFrame,
    id_col: str | list[str],
    label: str | None = None,
    k: int = 5,
    seed: int = 42,
    classes: Iterable | None = None,
    out: str = "fold",
) -> DataFrame:
    """Fold number 0..k-1 per row; fold sizes inside a class (or overall) differ by at most one."""
    ranks = [F.floor(F.col("_n") * F.lit(i) / F.lit(k)) for i in range(1, k)]
    if label is None:
        marked = _assign(df, id_col, None, ranks, seed)
    else:
        marked = _assign(df, id_col, label, ranks, seed, classes)
    return marked.withColumnRenamed("_part", out)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, balanced weight n / (k * n_class), and negatives per positive."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = df.where(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_distinct(label).alias("_classes"),
        F.count_if(F.col(label) == 1).alias("_pos"),
        F.count_if(F.col(label) == 0).alias("_neg"),
    )
    return (
        counts.withColumn("_t", totals.select(F.struct("*").alias("_t")).scalar())
        .withColumn("weight", F.col("_t._rows") / (F.col("_t._classes") * F.col("n")))
        .withColumn("scale_pos_weight", F.try_divide(F.col("_t._neg") * F.lit(1.0), F.col("_t._pos")))
        .drop("_t")
    )
