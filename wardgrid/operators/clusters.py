"""k-means and the subject nearest to each centre.

A step is one aggregation: every row finds its nearest centre among ``k`` constants, and sums per cluster combine
on the map side, so only ``k`` rows reach the driver.  The start is repeatable: the rows with the smallest hash of
their id.  Representatives are one minimum of (distance, id) per cluster, combined on the map side too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import ident, literal
from wardgrid.operators.splits import hash_key
from wardgrid.session import staged

Centres = list[list[float]]


def _complete(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
    for c in cols:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c))
    return rows


def _nearest(cols: Sequence[str], centres: Centres) -> Column:
    """(squared distance, cluster) of the nearest centre; ties go to the lower number."""
    entries = []
    for k, centre in enumerate(centres):
        square = " + ".join(f"({ident(c)} - {literal(float(x))}) * ({ident(c)} - {literal(float(x))})" for c, x in zip(cols, centre))
        entries.append(f"named_struct('square', {square}, 'cluster', {k})")
    return F.expr(f"array_min(array({', '.join(entries)}))")


def start_centres(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int = 42) -> Centres:
    """The rows with the k smallest hashes of their id, as centres; equal rows are taken once."""
    rows = _complete(df, id_col, cols).withColumn("_key", hash_key(id_col, seed))
    # Of equal points the smallest hash counts, so that no two centres coincide.
    points = rows.groupBy(*cols).agg(F.min("_key").alias("_key"))
    return [[float(r[c]) for c in cols] for r in points.orderBy("_key", *cols).limit(k).collect()]


def kmeans(
    df: DataFrame, id_col: str, cols: Sequence[str], k: int, iterations: int = 20, seed: int = 42, start: Centres | None = None
) -> Centres:
    """Centres after at most ``iterations`` Lloyd steps, or fewer when nothing moves.

    Rows with a missing value are left out; fewer distinct points than ``k`` give fewer centres; a cluster that loses
    all its rows keeps its centre.  Scale the columns first if their units differ.
    """
    rows = staged(_complete(df, id_col, cols), "points")
    centres = [list(map(float, c)) for c in start] if start is not None else start_centres(rows, id_col, cols, k, seed)
    for _ in range(iterations if centres else 0):
        found = rows.withColumn("_near", _nearest(cols, centres)).groupBy("_near.cluster").agg(*[F.avg(c).alias(c) for c in cols])
        moved = list(centres)
        for r in found.collect():
            moved[r["cluster"]] = [float(r[c]) for c in cols]
        if moved == centres:
            break
        centres = moved
    return centres


def assign_clusters(df: DataFrame, id_col: str, cols: Sequence[str], centres: Centres) -> DataFrame:
    """(id, columns, ``cluster``, ``distance``) of the rows without missing values."""
    rows = _complete(df, id_col, cols)
    if not centres:
        return rows.select("*", F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")).limit(0)
    placed = rows.withColumn("_near", _nearest(cols, centres))
    return placed.select(id_col, *cols, F.col("_near.cluster").alias("cluster"), F.sqrt("_near.square").alias("distance"))


def cluster_representatives(assigned: DataFrame, id_col: str) -> DataFrame:
    """Per cluster its size, its mean distance, and the row nearest to the centre (ties: smallest id)."""
    nearest = F.min(F.struct("distance", id_col))
    return (
        assigned.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("distance").alias("mean_distance"), nearest.alias("_first"))
        .select("cluster", "n", "mean_distance", F.col(f"_first.{ident(id_col)}").alias(id_col), F.col("_first.distance").alias("distance"))
    )
