"""Reading files, with a cache of what was read, and fetching them."""

from __future__ import annotations

import logging
import os
import urllib.request
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from spherelake.functions.names import NUISANCE
from spherelake.functions.text import digest

log = logging.getLogger(__name__)


def dataset_key(paths: Iterable[str]) -> str:
    """A key of a set of files: order and repetition don't matter."""
    return digest(sorted(set(paths)), size=64)


def open_dataset(spark: SparkSession, paths: Iterable[str], fmt: str = "parquet", preprocess: Callable[[DataFrame], DataFrame] | None = None, **options: str) -> DataFrame:
    """Files as one table; a preprocessing step is applied to the whole."""
    df = spark.read.format(fmt).options(**options).load(sorted(set(paths)))
    return df.transform(preprocess) if preprocess else df


def cached_open(spark: SparkSession, paths: Iterable[str], cache: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The same, kept as Parquet under a key of the paths.  A cache that can't be read is made anew."""
    paths = sorted(set(paths))
    place = f"{cache.rstrip('/')}/{dataset_key(paths)}"
    if path_exists(spark, f"{place}/_SUCCESS"):
        try:
            df = spark.read.parquet(place)
            df.limit(1).collect()
            return df
        except Exception as broken:  # whatever is wrong with it, it can be made anew
            log.warning("the cache at %s can't be read (%s); making it anew", place, type(broken).__name__)
    open_dataset(spark, paths, fmt, **options).write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def open_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """A store's table, or None if there is none."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def drop_nuisance(df: DataFrame) -> DataFrame:
    return df.drop(*NUISANCE)


def rename_points(df: DataFrame) -> DataFrame:
    """``values`` is the cell dimension of some files; their one unnamed variable is ``unknown``."""
    return df.withColumnsRenamed({"values": "cell", "unknown": "value"})


def grid_from(spark: SparkSession, grid: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """A source grid: the one that is given, else the one in a file."""
    if grid is not None:
        return grid
    if path is not None:
        return spark.read.parquet(path)
    raise ValueError("a grid or the path of one is needed")


def download(url: str, path: str, chunk: int = 1 << 20, timeout: float = 30.0, overwrite: bool = False) -> bool:
    """Fetch a file unless it is there: written beside its place and moved there.  True if it was fetched.

    HTTP errors raise.  For driver-side preparation; data are read by Spark.
    """
    if os.path.exists(path) and not overwrite:
        return False
    part = f"{path}.part"
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with urllib.request.urlopen(url, timeout=timeout) as got, open(part, "wb") as out:  # noqa: S310
        while block := got.read(chunk):
            out.write(block)
    os.replace(part, path)
    return True
