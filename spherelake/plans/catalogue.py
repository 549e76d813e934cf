"""The query catalogue: what the driver runs, and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spherelake.plans import aggregates, geometry, joins, scalars, tables  # noqa: F401  (they fill the registry)
from spherelake.plans.fixtures import REGISTRY


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["R7_pyramid"].run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: e.run for name, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.sql for name, e in REGISTRY.items() if e.sql}
