"""Command line: regrid a Parquet field to a pyramid of levels."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import functions as F

from spherelake.operators import pyramid
from spherelake.session import get_session
from spherelake.sources import store

LEVELS = (logging.WARNING, logging.INFO, logging.DEBUG)


def verbosity(count: int) -> int:
    """-v is INFO, -vv DEBUG, more the same."""
    return LEVELS[max(0, min(count, len(LEVELS) - 1))]


def configure_logging(count: int) -> logging.Logger:
    logger = logging.getLogger("spherelake")
    logger.setLevel(verbosity(count))
    if not logger.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        logger.addHandler(handler)
    return logger


def cache_dir(environment: dict[str, str] | None = None) -> str:
    """Where weights are kept: SPHERELAKE_CACHE, else a folder in the user's cache."""
    env = os.environ if environment is None else environment
    return env.get("SPHERELAKE_CACHE") or os.path.join(env.get("XDG_CACHE_HOME") or os.path.join(os.path.expanduser("~"), ".cache"), "spherelake")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spherelake", description=__doc__)
    p.add_argument("field", help="Parquet table with batch columns, src and variables")
    p.add_argument("grid", help="Parquet table of grid points: y and x, or a dimension of cells, and coordinates")
    p.add_argument("root", help="where the levels are written")
    p.add_argument("--variables", nargs="+", required=True)
    p.add_argument("--time-index", default="time_idx")
    p.add_argument("--kind", default="auto", choices=["auto", "regular", "curvilinear", "unstructured"])
    p.add_argument("--units", default="auto", choices=["auto", "deg", "rad"])
    p.add_argument("--method", default="conservative", choices=["nearest", "conservative"])
    p.add_argument("--max-level", type=int)
    p.add_argument("--min-level", type=int, default=0)
    p.add_argument("--mode", default="w", choices=sorted(store.MODES))
    p.add_argument("-v", "--verbose", action="count", default=0)
    return p


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    log = configure_logging(a.verbose)
    spark = get_session()
    spark.sparkContext.setLogLevel("INFO" if a.verbose > 1 else "WARN")
    data = spark.read.parquet(a.field).withColumnRenamed(a.time_index, "time_idx").withColumn("time_idx", F.col("time_idx").cast("long"))
    source = pyramid.Source.of(spark.read.parquet(a.grid), a.kind, units=a.units)
    levels = pyramid.write_pyramid(data, source, a.variables, ["time_idx"], a.root, a.max_level, a.min_level, a.method, mode=a.mode)
    log.info("wrote levels %s to %s", sorted(levels), a.root)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
