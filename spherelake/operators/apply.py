"""Weights applied to fields: a join on the source point and one aggregation.

Fields are long tables: batch columns (time, level, ...), the source index, and one
column per variable.  Only present, valid values meet the weights; what is absent is
counted from the weights alone.  So the join has no row for a missing value, and the
result is made dense at the end: every batch key has every target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.functions.sphere import valid

POLICIES = ("renormalize", "propagate")
#: How the weights are moved: by size at run time, to every executor, or by a shuffle.
STRATEGIES = ("auto", "broadcast", "shuffle")
#: Rows of weights that may be sent to every executor on request.
BROADCAST_ROWS = 20_000_000


def apply_weights(
    field: DataFrame,
    weights: DataFrame,
    variables: list[str],
    batch: list[str],
    n_target: int | None = None,
    policy: str = "renormalize",
    src: str = "src",
    strategy: str = "auto",
    targets: DataFrame | None = None,
) -> DataFrame:
    """(batch..., dst, variables...): regridded values, NULL where missing.

    *renormalize* divides the weighted sum by the weight of valid sources, and is missing
    where that is not positive.  *propagate* is the plain weighted sum: missing if a
    source with a positive weight is missing, 0 for a target without weights.  Weights
    are not negative, and a pair may occur several times.  Targets are 0 to
    ``n_target`` - 1, or column dst of ``targets``, or those with a weight.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; use one of {POLICIES}")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")
    spark = field.sparkSession
    w = weights.select("dst", F.col("src").alias("_src"), "w")
    if strategy == "broadcast":
        if w.count() > BROADCAST_ROWS:
            raise ValueError(f"more than {BROADCAST_ROWS} weights; use strategy 'auto' or 'shuffle'")
        w = F.broadcast(w)
    elif strategy == "shuffle":
        w = w.hint("shuffle_hash")
    values = {v: F.when(valid(F.col(v)), F.col(v).cast("double")) for v in variables}
    some = F.coalesce(*values.values()).isNotNull() if len(values) > 1 else next(iter(values.values())).isNotNull()
    own = field.where(some).select(*batch, F.col(src).alias("_src"), *[e.alias(v) for v, e in values.items()])
    met = own.join(w, "_src")
    sums = []
    for v in variables:
        there = F.col(v).isNotNull()
        sums.append(F.sum(F.col("w") * F.col(v)).alias(f"_n_{v}"))
        if policy == "renormalize":
            sums.append(F.sum(F.when(there, F.col("w"))).alias(f"_d_{v}"))
        else:
            sums.append(F.count_if(there & (F.col("w") > 0)).alias(f"_c_{v}"))
    got = met.groupBy(*batch, "dst").agg(*sums)
    if targets is None:
        targets = spark.range(n_target).withColumnRenamed("id", "dst") if n_target is not None else weights.select("dst").distinct()
    keys = field.select(*batch).distinct()
    frame = keys.crossJoin(targets.select("dst"))
    if policy == "propagate":
        need = weights.groupBy("dst").agg(F.count_if(F.col("w") > 0).alias("_need"))
        frame = keys.crossJoin(targets.select("dst").join(need, "dst", "left"))
    dense = frame.join(got, [*batch, "dst"], "left")
    out = []
    for v in variables:
        total = F.col(f"_n_{v}")
        if policy == "renormalize":
            out.append(F.when(F.col(f"_d_{v}") > 0, F.try_divide(total, F.col(f"_d_{v}"))).alias(v))
        else:
            whole = F.coalesce(F.col(f"_c_{v}"), F.lit(0)) >= F.coalesce(F.col("_need"), F.lit(0))
            out.append(F.when(whole, F.coalesce(total, F.lit(0.0))).alias(v))
    return dense.select(*batch, "dst", *out)


def check_size(n_points: int, source_size: int) -> None:
    """Fail if a field's flattened source dimensions are not what the weights expect."""
    if n_points != source_size:
        raise ValueError(f"{n_points} source points does not match the weights' {source_size}")


def attach_centres(df: DataFrame, level: int, cell: str = "cell", nest: bool = True) -> DataFrame:
    """Add longitude and latitude of each cell: computed from the index, not joined."""
    return healpix.with_centres(df, level, cell, "lon", "lat", nest)


def bilinear(field: DataFrame, points: DataFrame, lat0: float, dlat: float, ny: int, lon0: float, dlon: float, nx: int, value: str = "v") -> DataFrame:
    """(dst, value): a regular grid (y, x, value) at points (dst, lon, lat), by the four points around.

    Longitudes go round; latitudes beyond the grid take the edge rows.  Missing if one
    of the four is.
    """
    fy = F.greatest(F.lit(0.0), F.least(F.lit(ny - 1.0), (F.col("lat") - lat0) / dlat))
    fx = F.pmod((F.col("lon") - lon0) / dlon, F.lit(float(nx)))
    at = points.select("dst", fy.alias("fy"), fx.alias("fx"))
    y = F.least(F.floor("fy"), F.lit(ny - 2)).cast("int")
    x = F.floor("fx").cast("int")
    at = at.select("dst", y.alias("y0"), x.alias("x0"), (F.col("fy") - y).alias("ty"), (F.col("fx") - x).alias("tx"))
    around = []
    for a in (0, 1):
        for b in (0, 1):
            w = (F.col("ty") if a else 1 - F.col("ty")) * (F.col("tx") if b else 1 - F.col("tx"))
            around.append(F.struct((F.col("y0") + a).alias("y"), F.pmod(F.col("x0") + b, F.lit(nx)).alias("x"), w.alias("w")))
    corner = at.select("dst", F.explode(F.array(*around)).alias("c")).select("dst", "c.y", "c.x", "c.w")
    own = field.where(valid(F.col(value))).select("y", "x", F.col(value).alias("_v"))
    met = corner.join(own, ["y", "x"], "left")
    return met.groupBy("dst").agg(F.when(F.count("_v") == 4, F.sum(F.col("w") * F.col("_v"))).alias(value))
