"""Driver loops over variables, work items and datasets: each step is a Spark job of its own."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from spherelake.operators import pyramid
from spherelake.sources.readers import path_exists
from spherelake.streaming.incremental import Progress


def bare_name(name: str) -> str:
    """A name for a path: ``functions.text.sanitise`` for a single value."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", name).strip("._") or "source"


def write_variables(spark: SparkSession, tables: dict[str, DataFrame], source: pyramid.Source, batch: list[str], root: str, rebuild: bool = False, **more) -> dict[str, str]:
    """A store of levels for each variable, under a path of its name: what was done with each.

    Finished variables are skipped; ``rebuild`` writes all of them anew.  A variable is
    recorded when all of its levels are there, so a run that broke off goes on with it.
    """
    progress = Progress(spark, f"{root.rstrip('/')}/progress")
    least = more.get("min_level", 0)
    out = {}
    for name, data in tables.items():
        if not rebuild and progress.next_index(name, least):
            out[name] = "skipped"
            continue
        pyramid.write_pyramid(data, source, [name], batch, f"{root.rstrip('/')}/{bare_name(name)}", **more)
        progress.record(name, least, 1, True)
        out[name] = "written"
    return out


def item_pyramid(data: DataFrame, source: pyramid.Source, variables: list[str], batch: list[str], staging: str, item: int, **more) -> dict[int, str]:
    """One work item's levels in a staging folder of its own, and their paths; written anew if there is something already."""
    root = f"{staging.rstrip('/')}/item_{item:06d}"
    return {level: f"{root}/level_{level}" for level in pyramid.write_pyramid(data, source, variables, batch, root, **more)}


def copy_datasets(spark: SparkSession, paths: dict[str, str], root: str, overwrite: bool = False) -> dict[str, str]:
    """Copy tables into a store under their names made fit for paths; those that are there stay unless ``overwrite``."""
    out = {}
    for name, path in paths.items():
        out[name] = f"{root.rstrip('/')}/{bare_name(name)}"
        if overwrite or not path_exists(spark, f"{out[name]}/_SUCCESS"):
            spark.read.parquet(path).write.mode("overwrite").parquet(out[name])
    if len(set(out.values())) < len(out):
        raise ValueError(f"names {sorted(out)} meet in one path")
    return out
