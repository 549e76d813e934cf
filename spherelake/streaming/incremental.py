"""Incremental work: resumable time steps, and streams into a store.

The batch forms are idempotent appends and a progress table.  The streaming forms run
them in ``foreachBatch``, so a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions.healpix import with_cell
from spherelake.sources import merge
from spherelake.sources.readers import open_existing
from spherelake.sources.store import swap

PROGRESS = "variable string, min_level int, next_time_index int, completed boolean"


def time_block(index, block: int = 48):
    return F.floor(index / block).cast("long")


class Progress:
    """How far each (variable, min_level) has come: a small table that is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        got = open_existing(self.spark, self.path)
        return got if got is not None else self.spark.createDataFrame([], PROGRESS)

    def next_index(self, variable: str, min_level: int) -> int:
        row = self.table().where((F.col("variable") == variable) & (F.col("min_level") == min_level)).first()
        return row["next_time_index"] if row else 0

    def record(self, variable: str, min_level: int, next_time_index: int, completed: bool) -> None:
        rest = self.table().where(~((F.col("variable") == variable) & (F.col("min_level") == min_level)))
        now = self.spark.createDataFrame([(variable, min_level, next_time_index, completed)], PROGRESS)
        swap(rest.unionByName(now).coalesce(1), self.path)


def run_resumable(progress: Progress, variable: str, min_level: int, n_times: int, step: Callable[[int, int], None], block: int = 48) -> list[tuple[int, int]]:
    """Do the blocks of times that are left, recording each when it is done; the blocks done now.

    ``step(begin, end)`` must replace what it wrote before, as a block that failed half-way is done again.
    """
    done = []
    begin = progress.next_index(variable, min_level)
    while begin < n_times:
        end = min(n_times, (begin // block + 1) * block)
        step(begin, end)
        progress.record(variable, min_level, end, end >= n_times)
        done.append((begin, end))
        begin = end
    return done


def append_stream(stream: DataFrame, path: str, checkpoint: str, time: str = "time", replace: bool = False, keys: list[str] | None = None):
    """A stream into a table: unseen times are appended; with ``replace`` existing ones are rewritten."""
    spark = stream.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        existing = open_existing(spark, path)
        if existing is None:
            batch.write.parquet(path)
        elif replace:
            swap(merge.merge(existing, batch, keys or [time], time, replace=True)[0], path)
        else:
            merge.pad(existing, merge.unseen(existing, batch, time)).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def fresh_periods(items: DataFrame) -> DataFrame:
    """Items that end after what their variable has (existing_max_time); late, finished periods aren't opened again."""
    return items.where(F.col("existing_max_time").isNull() | (F.col("period_end") > F.col("existing_max_time")))


def first_by_time(stream: DataFrame, time: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """A stream with one row for each key and time, the first to come, within a watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([*keys, time])


def binned_stream(stream: DataFrame, level: int, time: str = "ts", lon: str = "lon", lat: str = "lat", value: str = "value", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """An extension: means of a stream of point observations by cell and tumbling window."""
    cells = with_cell(stream, level, lon, lat).withWatermark(time, delay)
    got = cells.groupBy(F.window(time, width), "cell").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias(value))
    return got.select(F.col("window.start").alias("window_start"), "cell", "n", value)
