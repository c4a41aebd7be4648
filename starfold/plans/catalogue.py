"""Queries of the light-curve operators over the driver's tables, each with its SQL oracle where SQL can say it.

The tables play these parts: events are an irregular series for each user (band = event type); lineitem with orders is forced
photometry of suppliers' objects with a visit table; customers and suppliers are objects with positions; orders are predictions of two
models.  Oracles round as the queries do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and its oracle if there is one."""

    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


from starfold.plans import acquisition_queries, cadence_queries, curation_queries, model_queries, network_queries, period_queries, photometry_queries, spatial_queries  # noqa: E402, F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit join, flags, magnitudes, thinning, minimum count and statistics in one chain."""
    return photometry_queries.flagship(spark, sf_dir)
