"""Every operator as a query over the star-schema tables, with an SQL equivalent where one exists."""

from driver_queries import (  # noqa: F401  (importing registers the queries)
    aggregates,
    cleaning,
    features,
    joins,
    modelling,
    profile,
    ranking,
    reshape,
    safety,
    sequences,
    sources,
    statistics,
)
from driver_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
