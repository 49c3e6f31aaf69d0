"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import basins, features, grids, layers, ledger, normal, records, review, scoring, surfaces, tracks

_MODULES = (tracks, layers, records, surfaces, basins, grids, scoring, review, ledger, features, normal)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.intake(spark, sf_dir)
