"""Coarser levels of nested cells: one aggregation on the parent index.

Parents are ``cell >> 2 levels``, so the partial aggregation in every task already does
most of the work; only partial results are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherelake.functions.healpix import parent
from spherelake.functions.sphere import npix, valid

MODES = ("auto", "mean", "mode")
#: Aggregators by name; of the first group a NaN or absent child makes the parent missing.
BLOCK = ("mean", "sum", "min", "max", "first")
SKIPPING = ("nanmean", "nansum", "nanmin", "nanmax")


def needed(factor: int, fraction: float) -> int:
    """How many valid children a parent needs."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"min_valid_fraction must be in [0, 1], not {fraction}")
    return max(1, math.ceil(fraction * factor))


def resolve_mode(mode: str, method: str | None) -> str:
    """auto is mode for nearest weights and mean for all others, unknown ones included."""
    if mode not in MODES:
        raise ValueError(f"unknown coarsen mode {mode!r}; use one of {MODES}")
    return mode if mode != "auto" else "mode" if method == "nearest" else "mean"


def _dense(got: DataFrame, source: DataFrame, batch: list[str], level: int) -> DataFrame:
    """Every batch key with every cell of the level."""
    if not batch:
        keys = source.sparkSession.range(npix(level)).withColumnRenamed("id", "cell")
        return keys.join(got, "cell", "left")
    frame = source.select(*batch).distinct().crossJoin(source.sparkSession.range(npix(level)).withColumnRenamed("id", "cell"))
    return frame.join(got, [*batch, "cell"], "left")


def mean(df: DataFrame, values: list[str], batch: list[str], levels: int, fraction: float = 0.5) -> DataFrame:
    """(batch..., cell, values...): the mean of valid children, NULL below the threshold."""
    need = needed(4**levels, fraction)
    sums = []
    for v in values:
        own = F.when(valid(F.col(v)), F.col(v).cast("double"))
        sums.append(F.when(F.count(own) >= need, F.avg(own)).alias(v))
    return df.groupBy(*batch, parent(F.col("cell"), levels).alias("cell")).agg(*sums)


def mode(df: DataFrame, value: str, batch: list[str], levels: int, fraction: float = 0.5) -> DataFrame:
    """(batch..., cell, value): the most frequent valid child value, of equals the one of the lowest child."""
    need = needed(4**levels, fraction)
    own = df.select(*batch, parent(F.col("cell"), levels).alias("_p"), F.when(valid(F.col(value)), F.col(value)).alias("_v"), F.col("cell").alias("_c"))
    counted = own.groupBy(*batch, "_p", "_v").agg(F.count("_v").alias("_n"), F.min("_c").alias("_first"))
    # A parent without a valid child stays, with nothing to choose from.
    rank = F.when(F.col("_v").isNotNull(), F.struct(F.col("_n"), -F.col("_first")))
    best = counted.groupBy(*batch, "_p").agg(F.sum("_n").alias("_all"), F.max_by("_v", rank).alias("_v"))
    return best.select(*batch, F.col("_p").alias("cell"), F.when(F.col("_all") >= need, F.col("_v")).alias(value))


def coarsen(
    df: DataFrame,
    values: list[str],
    batch: list[str],
    level: int,
    target: int,
    how: str = "auto",
    fraction: float = 0.5,
    method: str | None = None,
    order: str = "nested",
    dense: bool = False,
) -> DataFrame:
    """Coarsen straight from one level to another (over all 4^n children at once); dense.

    ``dense`` says that the input has every batch key with every cell already; then the
    parents are all there too, and nothing is filled up.  Ring-ordered cells can't be
    coarsened; regrid them to the other level instead.
    """
    if order != "nested":
        raise ValueError("only nested cells can be coarsened; regrid ring-ordered data to the level instead")
    if not 0 <= target < level:
        raise ValueError(f"the target level must be in [0, {level}), not {target}")
    if resolve_mode(how, method) == "mean":
        out = mean(df, values, batch, level - target, fraction)
        return out if dense else _dense(out, df, batch, target)
    out = None
    for v in values:
        own = mode(df, v, batch, level - target, fraction)
        out = own if out is None else out.join(own, [*batch, "cell"], "full_outer")
    return out if dense else _dense(out, df, batch, target)


def aggregator(name: str, v: Column, cell: Column, factor: int = 4) -> Column:
    """A block aggregate by name.  Here only NULL and NaN are missing; infinities are values.

    nanmean alone leaves infinities out too.  nansum of nothing is 0.
    """
    there = v.isNotNull() & ~F.isnan(v)
    own = F.when(there, v)
    whole = F.count(own) == factor
    if name in ("mean", "sum", "min", "max"):
        return F.when(whole, {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[name](own))
    if name == "first":
        first = F.min_by(v, cell)
        return F.when(~F.isnan(first), first)
    if name == "nansum":
        return F.coalesce(F.sum(own), F.lit(0.0))
    if name == "nanmean":
        return F.avg(F.when(valid(v), v))
    if name in ("nanmin", "nanmax"):
        return (F.min if name == "nanmin" else F.max)(own)
    raise ValueError(f"unknown aggregator {name!r}")


def degrade(df: DataFrame, value: str, batch: list[str], level: int, target: int, how: str | Callable[[Column, Column], Column] = "nanmean") -> DataFrame:
    """(batch..., cell, value), four children at a time down to the target, by a named or own aggregate."""
    for _ in range(level - target):
        made = aggregator(how, F.col(value).cast("double"), F.col("cell")) if isinstance(how, str) else how(F.col(value), F.col("cell"))
        df = df.groupBy(*batch, parent(F.col("cell")).alias("_p")).agg(made.alias(value)).withColumnRenamed("_p", "cell")
    return df


def degrade_mean(df: DataFrame, value: str, batch: list[str], levels: int) -> DataFrame:
    """The mean over all 4^levels children at once; missing if one child is."""
    made = aggregator("mean", F.col(value).cast("double"), F.col("cell"), 4**levels)
    return df.groupBy(*batch, parent(F.col("cell"), levels).alias("_p")).agg(made.alias(value)).withColumnRenamed("_p", "cell")
