"""Source grids as tables: axes, bounds, coverage, resolution, corners.

Axis tables (idx, deg) have as many rows as an axis has points, so windows over a whole
axis stay small; everything that has a row per grid point is partitioned or row-wise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherelake.functions.sphere import lonlat, xyz

GLOBAL_LON, GLOBAL_LAT = 350.0, 170.0


def regular(lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """(src, y, x, lat, lon) of axis tables (idx, deg): their product, src row-major."""
    nx = F.broadcast(lon_axis.agg(F.count(F.lit(1)).alias("nx")))
    y = lat_axis.select(F.col("idx").alias("y"), F.col("deg").alias("lat"))
    x = lon_axis.select(F.col("idx").alias("x"), F.col("deg").alias("lon"))
    return y.crossJoin(x).crossJoin(nx).select((F.col("y").cast("long") * F.col("nx") + F.col("x")).alias("src"), "y", "x", "lat", "lon")


def differences(axis: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(…, idx, step): each value less the one before it; the first has none."""
    w = Window.partitionBy(*(by or [])).orderBy("idx")
    return axis.withColumn("step", F.col("deg") - F.lag("deg").over(w))


def bounds(axis: DataFrame, clamp: float | None = None) -> DataFrame:
    """(idx, lower, upper): midpoints between neighbours, half a step beyond the ends.

    ``clamp`` keeps latitude bounds within the poles.  An axis of one point is an error.
    """
    w = Window.orderBy("idx")
    own = axis.withColumns({"before": F.lag("deg").over(w), "after": F.lead("deg").over(w)})
    # One value: no step to extrapolate by.
    back = F.coalesce((F.col("deg") - F.col("before")) / 2, (F.col("after") - F.col("deg")) / 2)
    ahead = F.coalesce((F.col("after") - F.col("deg")) / 2, (F.col("deg") - F.col("before")) / 2)
    back = F.when(back.isNull(), F.raise_error(F.lit("an axis needs two points for bounds")).cast("double")).otherwise(back)
    out = own.select("idx", (F.col("deg") - back).alias("lower"), (F.col("deg") + ahead).alias("upper"))
    if clamp is None:
        return out
    cut = lambda c: F.greatest(F.lit(-clamp), F.least(F.lit(clamp), F.col(c))).alias(c)
    return out.select("idx", cut("lower"), cut("upper"))


#: Degrees are put into so many bins each for sorting: a bin is a task's work, and all bins are few thousand rows.
BINS = 10


def gaps(values: DataFrame, column: str) -> DataFrame:
    """(gap): the differences between neighbours among the distinct values, which are in degrees.

    Values are sorted within bins, and the bins' ends with each other, so no task gets them all.
    """
    own = values.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL").distinct().withColumn("bin", F.floor(F.col("v") * BINS))
    within = own.select((F.col("v") - F.lag("v").over(Window.partitionBy("bin").orderBy("v"))).alias("gap"))
    ends = own.groupBy("bin").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    between = ends.select((F.col("lo") - F.lag("hi").over(Window.orderBy("bin"))).alias("gap"))
    return within.unionByName(between).where("gap IS NOT NULL")


def median_step(values: DataFrame, column: str) -> DataFrame:
    """One row (step): the median positive difference of the sorted distinct values, 0 if none."""
    return gaps(values, column).where("gap > 0").agg(F.coalesce(F.median("gap"), F.lit(0.0)).alias("step"))


def lon_coverage(values: DataFrame, column: str = "lon") -> DataFrame:
    """One row (coverage): 360 less the largest gap round the circle, plus the median step, in [0, 360]."""
    own = values.select(F.pmod(F.col(column), F.lit(360.0)).alias("v")).where("v IS NOT NULL").distinct()
    ends = own.agg(F.count(F.lit(1)).alias("n"), (F.min("v") + 360.0 - F.max("v")).alias("last"))
    widest = gaps(own, "v").agg(F.max("gap").alias("gap")).crossJoin(ends).select("n", F.greatest("gap", "last").alias("gap"))
    reach = F.greatest(F.lit(0.0), F.least(F.lit(360.0), 360.0 - F.col("gap") + F.col("step")))
    return widest.crossJoin(median_step(own, "v")).select(F.when(F.col("n") < 2, 0.0).otherwise(reach).alias("coverage"))


def lat_coverage(values: DataFrame, column: str = "lat") -> DataFrame:
    """One row (coverage): the span plus the median step, in [0, 180]."""
    span = values.agg((F.max(column) - F.min(column)).alias("span"))
    reach = F.greatest(F.lit(0.0), F.least(F.lit(180.0), F.col("span") + F.col("step")))
    return span.crossJoin(median_step(values, column)).select(F.coalesce(reach, F.lit(0.0)).alias("coverage"))


def coverage(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """One row (lon_coverage, lat_coverage, is_global)."""
    a = lon_coverage(points, lon).withColumnRenamed("coverage", "lon_coverage")
    b = lat_coverage(points, lat).withColumnRenamed("coverage", "lat_coverage")
    both = a.crossJoin(b)
    return both.withColumn("is_global", (F.col("lon_coverage") >= GLOBAL_LON) & (F.col("lat_coverage") >= GLOBAL_LAT))


def resolution_regular(lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """One row (resolution): the least absolute step of either axis."""
    steps = differences(lat_axis).select("step").unionByName(differences(lon_axis).select("step"))
    return steps.agg(F.min(F.abs("step")).alias("resolution"))


def resolution_curvilinear(grid: DataFrame) -> DataFrame:
    """One row (resolution): the lesser of the mean absolute steps of lat along y and of lon along x."""
    down = F.abs(F.col("lat") - F.lag("lat").over(Window.partitionBy("x").orderBy("y")))
    along = F.abs(F.col("lon") - F.lag("lon").over(Window.partitionBy("y").orderBy("x")))
    return grid.select(down.alias("a"), along.alias("b")).agg(F.least(F.avg("a"), F.avg("b")).alias("resolution"))


def resolution_unstructured(grid: DataFrame) -> DataFrame:
    """One row (resolution): the side of a mean cell, if the grid covers the sphere."""
    return grid.agg(F.degrees(F.sqrt(F.lit(4 * math.pi) / F.count(F.lit(1)))).alias("resolution"))


def corners(grid: DataFrame) -> DataFrame:
    """(cy, cx, lon, lat): corners of a curvilinear grid, the mean directions of the up to four centres around."""
    x, y, z = xyz(F.col("lon"), F.col("lat"))
    offsets = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    spread = grid.select("y", "x", x.alias("vx"), y.alias("vy"), z.alias("vz"), offsets.alias("o"))
    around = spread.groupBy((F.col("y") + F.col("o.a")).alias("cy"), (F.col("x") + F.col("o.b")).alias("cx"))
    mean = around.agg(F.avg("vx").alias("vx"), F.avg("vy").alias("vy"), F.avg("vz").alias("vz"))
    lon, lat = lonlat(F.col("vx"), F.col("vy"), F.col("vz"))
    return mean.select("cy", "cx", lon.alias("lon"), lat.alias("lat"))
