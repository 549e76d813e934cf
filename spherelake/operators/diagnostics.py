"""Checks and summaries of fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherelake.functions.sphere import valid


def conservation(source: DataFrame, target: DataFrame, value: str, area: str) -> DataFrame:
    """One row: both integrals of value x area and their relative difference, NULL if a value isn't finite."""

    def total(df: DataFrame, name: str) -> DataFrame:
        bad = F.count_if(~valid(F.col(value)))
        return df.agg(F.when(bad == 0, F.sum(F.col(value) * F.col(area))).alias(name))

    both = total(source, "source_integral").crossJoin(total(target, "target_integral"))
    return both.withColumn("relative_difference", F.try_divide(F.col("target_integral") - F.col("source_integral"), F.abs("source_integral")))


def statistics(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """(by..., v_min, v_max, v_mean, n) of valid values."""
    own = F.when(valid(F.col(value)), F.col(value))
    return df.groupBy(*by).agg(F.min(own).alias(f"{value}_min"), F.max(own).alias(f"{value}_max"), F.avg(own).alias(f"{value}_mean"), F.count(own).alias("n"))


def raster(points: DataFrame, value: str, nx: int, ny: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(iy, ix, value, n): means of points in nx x ny bins of longitude -180..180 and latitude -90..90."""
    clip = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(c))).cast("int")
    iy, ix = clip((F.col(lat) + 90) / (180 / ny), ny), clip((F.col(lon) + 180) / (360 / nx), nx)
    return points.groupBy(iy.alias("iy"), ix.alias("ix")).agg(F.avg(F.when(valid(F.col(value)), F.col(value))).alias(value), F.count(F.lit(1)).alias("n"))


def percentile_range(df: DataFrame, value: str, by: list[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(by..., low, high): the percentiles of valid values, or the extremes where they coincide."""
    own = F.when(valid(F.col(value)), F.col(value).cast("double"))
    got = df.groupBy(*by).agg(F.percentile(own, F.array(F.lit(low), F.lit(high))).alias("p"), F.min(own).alias("a"), F.max(own).alias("b"))
    flat = F.get("p", F.lit(0)) == F.get("p", F.lit(1))
    return got.select(*by, F.when(flat, F.col("a")).otherwise(F.get("p", F.lit(0))).alias("low"), F.when(flat, F.col("b")).otherwise(F.get("p", F.lit(1))).alias("high"))


def bad_faces(faces: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: faces there were, kept and dropped."""
    a, b = faces.agg(F.count(F.lit(1)).alias("n_faces")), kept.agg(F.count(F.lit(1)).alias("n_kept"))
    return a.crossJoin(b).withColumn("n_bad", F.col("n_faces") - F.col("n_kept"))


def difference(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """One row: rows of both, rows on one side only, and the largest absolute difference."""
    met = a.select(*key, F.col(value).alias("_a"), F.lit(1).alias("_ia")).join(b.select(*key, F.col(value).alias("_b"), F.lit(1).alias("_ib")), key, "full_outer")
    return met.agg(F.count_if(F.col("_ia").isNotNull() & F.col("_ib").isNotNull()).alias("n_both"), F.count_if(F.col("_ia").isNull() | F.col("_ib").isNull()).alias("n_one"), F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_difference"))
