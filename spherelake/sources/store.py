"""Stores of pyramids: one Parquet dataset per level, partitioned by blocks of time.

A level's dataset is ``<root>/level_<L>``, its metadata ``<root>/level_<L>.json`` (a
one-row text dataset, written last).  Blocks of times are partitions, so rewriting some
times touches only their blocks.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions.sizing import chunk_sizes, rows_per_file
from spherelake.functions.sphere import npix
from spherelake.functions.text import parse_time, store_name
from spherelake.sources import merge
from spherelake.sources.readers import open_existing, path_exists

MODES = {"a": "append", "w": "overwrite", "r+": "region"}
#: Times in a block (fixed value of the slice protocol; slices are multiples of it).
BLOCK = 48


def with_block(df: DataFrame, time_index: str = "time_idx", block: int = BLOCK) -> DataFrame:
    return df.withColumn("time_block", F.floor(F.col(time_index) / block).cast("long"))


def write_metadata(spark: SparkSession, root: str, level: int, metadata: dict) -> None:
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{store_name(root, level)}.json")


def read_metadata(spark: SparkSession, root: str, level: int) -> dict:
    return json.loads(spark.read.text(f"{store_name(root, level)}.json").first()["value"])


def save_level(df: DataFrame, root: str, level: int, mode: str = "a", region: tuple[int, int] | None = None, time_index: str = "time_idx", encoding: dict[str, str] | None = None, metadata: dict | None = None) -> None:
    """Write a level's table.

    "w" replaces it, "a" appends, "r+" replaces the blocks of the times in ``region``
    (begin, end), of which all of a block's times must be given: a region begins with a
    block, and ends with one or where the store's times end.  Columns without the time
    index aren't part of a region.  ``encoding`` are writer options.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {sorted(MODES)}")
    spark = df.sparkSession
    if region is not None:
        df = df.where((F.col(time_index) >= region[0]) & (F.col(time_index) < region[1]))
    own = with_block(df, time_index)
    chunks = chunk_sizes(level)
    # A block's rows go to tasks by block and cell range, so files are whole and sorted.
    own = own.repartition("time_block", F.floor(F.col("cell") / chunks["cell"])).sortWithinPartitions("time_block", time_index, "cell")
    writer = own.write.partitionBy("time_block").option("maxRecordsPerFile", rows_per_file(chunks)).options(**(encoding or {}))
    if mode == "r+":
        if region is None:
            raise ValueError("mode 'r+' needs a region")
        if region[0] % BLOCK or region[1] <= region[0]:
            raise ValueError(f"a region must begin at multiples of {BLOCK} times")
        path = store_name(root, level)
        if region[1] % BLOCK and path_exists(spark, path):
            rest = spark.read.parquet(path).where((F.col("time_block") == region[1] // BLOCK) & (F.col(time_index) >= region[1]))
            if not rest.isEmpty():
                raise ValueError(f"a region that ends within a block of {BLOCK} times must end with the store's times")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(store_name(root, level))
    else:
        writer.mode("append" if mode == "a" else "overwrite").parquet(store_name(root, level))
    if metadata is not None:
        write_metadata(spark, root, level, metadata)


def save_pyramid(levels: dict[int, DataFrame], root: str, mode: str = "a", region: tuple[int, int] | None = None, time_index: str = "time_idx", encoding: dict[int, dict[str, str]] | None = None, metadata: dict[int, dict] | None = None) -> None:
    """Write all levels, each with its own encoding and metadata."""
    for level, df in sorted(levels.items()):
        save_level(df, root, level, mode, region, time_index, (encoding or {}).get(level), (metadata or {}).get(level))


def init_store(template: DataFrame, root: str, level: int, coordinates: DataFrame | None = None, metadata: dict | None = None) -> None:
    """An empty table with its schema, and the coordinates, for slices that are written later."""
    empty = with_block(template.limit(0))
    empty.write.mode("overwrite").parquet(store_name(root, level))
    if coordinates is not None:
        coordinates.write.mode("overwrite").parquet(f"{store_name(root, level)}.coords")
    write_metadata(template.sparkSession, root, level, metadata or {})


def slices(n_times: int, size: int) -> list[tuple[int, int]]:
    """(begin, end) of independent slice jobs; the size must be whole blocks."""
    if size <= 0 or size % BLOCK:
        raise ValueError(f"a slice must be a multiple of {BLOCK} times")
    return [(a, min(a + size, n_times)) for a in range(0, n_times, size)]


def read_level(spark: SparkSession, root: str, level: int) -> DataFrame:
    return spark.read.parquet(store_name(root, level)).drop("time_block")


def check_axis(existing: DataFrame, wanted: DataFrame, time: str = "time") -> None:
    """Fail if a store's time axis isn't the wanted one."""
    if not merge.same_axis(existing, wanted, time):
        row = merge.first_difference(existing, wanted, time).first()
        raise ValueError(f"the time axes differ, first at {row['first_difference']} ({row['n_a']} and {row['n_b']} times)")


def merge_level(candidate: DataFrame, spark: SparkSession, path: str, keys: list[str], time: str = "time", replace: bool = False, overwrite_static: bool = False) -> DataFrame:
    """Merge a candidate into the table at ``path``: a one-row summary.

    Appending writes new rows alone.  Anything that changes old rows is written beside
    the table and moved into its place.
    """
    existing = open_existing(spark, path)
    out, done = merge.merge(existing, candidate, keys, time, replace, overwrite_static)
    if existing is None:
        candidate.write.parquet(path)
    elif done["missing_variables_added"] or done["overlapping_times_rewritten"] or done["static_writes"]:
        swap(out, path)
    elif done["time_slices_written"]:
        merge.pad(existing, merge.unseen(existing, candidate, time)).write.mode("append").parquet(path)
    return spark.createDataFrame([(path, *done.values())], "target_path string, " + ", ".join(f"{k} long" for k in done))


def swap(df: DataFrame, path: str) -> None:
    """Write a table beside its place, then move it there; the old one stays until then."""
    spark = df.sparkSession
    hadoop = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(hadoop(path)):
        fs.delete(hadoop(f"{path}.old"), True)
        fs.rename(hadoop(path), hadoop(f"{path}.old"))
    fs.rename(hadoop(f"{path}.new"), hadoop(path))
    fs.delete(hadoop(f"{path}.old"), True)


def copy_store(spark: SparkSession, root: str, to: str, levels: list[int], cells_per_file: int | None = None) -> None:
    """Copy levels, laid out anew as one time by so many cells per group of rows."""
    for level in levels:
        df = spark.read.parquet(store_name(root, level))
        if cells_per_file:
            df = df.repartitionByRange(F.col("time_block"), F.floor(F.col("cell") / cells_per_file)).sortWithinPartitions("time_block", "cell")
        df.write.mode("overwrite").partitionBy("time_block").parquet(store_name(to, level))
        if path_exists(spark, f"{store_name(root, level)}.json"):
            write_metadata(spark, to, level, read_metadata(spark, root, level))


def save_mesh(nodes: DataFrame, faces: DataFrame, root: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{root}/nodes")
    faces.write.mode("overwrite").parquet(f"{root}/faces")


def time_storage(df: DataFrame, time: str = "time") -> tuple[DataFrame, dict[str, str]]:
    """A time column as whole seconds since 1970 if all times are, else as nanoseconds; and its attributes."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    whole = df.agg(F.bool_and(micros % 1_000_000 == 0).alias("w")).first()["w"]
    unit, value = ("seconds", F.floor(micros / 1_000_000).cast("long")) if whole in (True, None) else ("nanoseconds", micros * 1000)
    return df.withColumn(time, value), {"units": f"{unit} since 1970-01-01 00:00:00", "calendar": "proleptic_gregorian", "axis": "T"}


def decode_time(value, units: str):
    """Numeric times by their units ("<unit> since <origin>") as timestamps; decimals below a microsecond go."""
    unit, _, origin = units.partition(" since ")
    per = {"seconds": 1_000_000, "minutes": 60_000_000, "hours": 3_600_000_000, "days": 86_400_000_000, "milliseconds": 1000, "microseconds": 1}
    base = F.unix_micros(parse_time(F.lit(origin)))
    micros = F.floor(value / 1000) if unit == "nanoseconds" else F.round(value * per[unit])
    return F.timestamp_micros(base + micros.cast("long"))


def layout_level(level: int, access: str = "map", **more) -> dict[str, int]:
    """A level's chunks and rows per file."""
    chunks = chunk_sizes(level, access=access, **more)
    return chunks | {"rows_per_file": rows_per_file(chunks), "npix": npix(level)}
