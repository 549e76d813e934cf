"""Chunk sizes of stored pyramids, and what they mean for Spark's files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spherelake.functions.sphere import npix

MIB = 1024 * 1024


def chunk_sizes(
    level: int,
    itemsize: int = 4,
    stored_mib: float = 16.0,
    ratio: float = 2.0,
    access: str = "map",
    ntime: int | None = None,
    max_time: int | None = None,
    max_cell: int | None = None,
) -> dict[str, int]:
    """(time, cell) chunk sizes for an approximate stored size.

    "map" fills a chunk with cells first, "time_series" with times first; the largest
    time chunk wins over the number of times, which then bounds it.
    """
    values = int(int(stored_mib * MIB) * ratio) // itemsize  # that fit into a chunk
    cells = [npix(level), *([] if max_cell is None else [max_cell])]
    times = [x for x in (max_time, ntime) if x is not None]
    if access == "map":
        first = min(cells)
        return {"time": max(1, values // first), "cell": first}
    if access != "time_series" or not times:
        raise ValueError(f"unknown access {access!r}" if access != "time_series" else "time_series access needs ntime or max_time")
    first = min(times)
    return {"time": first, "cell": min(max(1, values // first), *cells)}


def map_time_chunk(level: Column, itemsize: int = 4, stored_mib: float = 16.0, ratio: float = 2.0) -> Column:
    """The time chunk of "map" access as an expression over levels."""
    budget = int(int(stored_mib * MIB) * ratio) // itemsize
    return F.greatest(F.lit(1), F.floor(F.lit(budget) / (12 * F.pow(F.lit(4.0), level)))).cast("long")


def rows_per_file(chunks: dict[str, int], row_bytes: int = 16, file_mib: int = 128) -> int:
    """Whole chunks per file, for maxRecordsPerFile; one chunk at least."""
    chunk = chunks["time"] * chunks["cell"]
    return chunk * max(1, file_mib * MIB // (chunk * row_bytes))
