"""HEALPix geometry as column expressions (Gorski et al. 2005).

The level is a constant of the plan, so bits are gathered by sums of as many terms as
there are levels; each step is a projection of its own, which keeps the expressions
small and inside one code-generated stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions.sphere import npix

#: Ring and longitude offsets of the twelve faces (fixed values).
JR = (2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4)
JP = (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)
_TEMPORARY = ("_f", "_x", "_y", "_jr", "_nr", "_z", "_ks", "_jp")


def _pick(values: tuple[int, ...], face: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), face.cast("int")).cast("long")


def gather_bits(p: Column, level: int, odd: int) -> Column:
    """The number made of every other bit of ``p``."""
    out = F.lit(0).cast("long")
    for i in range(level):
        out = out + F.shiftleft(F.shiftright(p, 2 * i + odd).bitwiseAND(F.lit(1).cast("long")), i)
    return out


def spread_bits(x: Column, level: int) -> Column:
    out = F.lit(0).cast("long")
    for i in range(level):
        out = out + F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1).cast("long")), 2 * i)
    return out


def face_xy(df: DataFrame, cell: str, level: int) -> DataFrame:
    """Add _f, _x, _y of nested cells."""
    p = F.col(cell).cast("long")
    return df.withColumns({"_f": F.shiftright(p, 2 * level), "_x": gather_bits(p, level, 0), "_y": gather_bits(p, level, 1)})


def with_centres(df: DataFrame, level: int, cell: str = "cell", lon: str = "lon", lat: str = "lat", nest: bool = True) -> DataFrame:
    """Add the cell centres in degrees, longitudes in [0, 360)."""
    n = 1 << level
    if nest:
        df = face_xy(df, cell, level)
        df = df.withColumn("_jr", _pick(JR, F.col("_f")) * n - F.col("_x") - F.col("_y") - 1)
        north, south = F.col("_jr") < n, F.col("_jr") > 3 * n
        df = df.withColumns({
            "_nr": F.when(north, F.col("_jr")).when(south, 4 * n - F.col("_jr")).otherwise(n).cast("long"),
            "_ks": F.when(north | south, 0).otherwise((F.col("_jr") - n).bitwiseAND(F.lit(1).cast("long"))).cast("long"),
        })
        cap = F.col("_nr").cast("double") * F.col("_nr") / (3.0 * n * n)
        df = df.withColumns({
            "_z": F.when(north, 1.0 - cap).when(south, cap - 1.0).otherwise((2 * n - F.col("_jr")) * 2.0 / (3.0 * n)),
            "_jp": F.floor((_pick(JP, F.col("_f")) * F.col("_nr") + F.col("_x") - F.col("_y") + 1 + F.col("_ks")) / 2.0).cast("long"),
        })
        wrapped = F.pmod(F.col("_jp") - 1, 4 * F.col("_nr")) + 1
        phi = (wrapped - (F.col("_ks") + 1) / 2.0) * (90.0 / F.col("_nr"))
        return df.withColumns({lon: phi, lat: F.degrees(F.asin("_z"))}).drop(*_TEMPORARY)
    p, cap_cells, all_cells = F.col(cell).cast("long"), 2 * n * (n - 1), npix(level)
    north, south = p < cap_cells, p >= all_cells - cap_cells
    from_south = all_cells - p
    ring = (
        F.when(north, F.floor((1 + F.floor(F.sqrt((1 + 2 * p).cast("double")))) / 2))
        .when(south, F.floor((1 + F.floor(F.sqrt((2 * from_south - 1).cast("double")))) / 2))
        .otherwise(F.floor((p - cap_cells) / (4 * n)) + n)
        .cast("long")
    )
    df = df.withColumn("_nr", ring)
    r = F.col("_nr")
    df = df.withColumn("_jp", F.when(north, p + 1 - 2 * r * (r - 1)).when(south, 4 * r + 1 - (from_south - 2 * r * (r - 1))).otherwise((p - cap_cells) % (4 * n) + 1))
    half = F.when(north | south, 0.5).otherwise(F.when((r + n) % 2 == 1, 1.0).otherwise(0.5))
    cap = r.cast("double") * r / (3.0 * n * n)
    z = F.when(north, 1.0 - cap).when(south, cap - 1.0).otherwise((2 * n - r) * 2.0 / (3.0 * n))
    per = F.when(north | south, r).otherwise(F.lit(n).cast("long"))
    return df.withColumns({lon: (F.col("_jp") - half) * (90.0 / per), lat: F.degrees(F.asin(z))}).drop(*_TEMPORARY)


def with_vertices(df: DataFrame, level: int, cell: str = "cell", lons: str = "vlon", lats: str = "vlat") -> DataFrame:
    """Add the four corners of nested cells as arrays, counter-clockwise."""
    n = float(1 << level)
    df = face_xy(df, cell, level)
    lon_columns, lat_columns, drop = [], [], list(_TEMPORARY)
    for k, (a, b) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1))):
        x, y = (F.col("_x") + a) / n, (F.col("_y") + b) / n
        jr, nr, t = f"_jr{k}", f"_nr{k}", f"_t{k}"
        drop += [jr, nr, t]
        df = df.withColumn(jr, _pick(JR, F.col("_f")) - x - y)
        north, south = F.col(jr) < 1, F.col(jr) > 3
        df = df.withColumn(nr, F.when(north, F.col(jr)).when(south, 4.0 - F.col(jr)).otherwise(1.0))
        df = df.withColumn(t, F.pmod(_pick(JP, F.col("_f")) * F.col(nr) + x - y, F.lit(8.0)))
        z = F.when(north, 1 - F.col(nr) * F.col(nr) / 3).when(south, F.col(nr) * F.col(nr) / 3 - 1).otherwise((2 - F.col(jr)) * (2.0 / 3))
        lon_columns.append(F.when(F.col(nr) < 1e-12, 0.0).otherwise(45.0 * F.col(t) / F.greatest(F.col(nr), F.lit(1e-12))))
        lat_columns.append(F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z)))))
    return df.withColumns({lons: F.array(*lon_columns), lats: F.array(*lat_columns)}).drop(*drop)


def with_cell(df: DataFrame, level: int, lon: str = "lon", lat: str = "lat", cell: str = "cell") -> DataFrame:
    """Add the nested cell that holds each point."""
    n = 1 << level
    half_pi = math.pi / 2
    df = df.withColumns({"_z": F.sin(F.radians(F.col(lat))), "_t": F.pmod(F.radians(F.col(lon)) / half_pi, F.lit(4.0))})
    flat = F.abs("_z") <= 2.0 / 3
    a, b = n * (0.5 + F.col("_t")), n * 0.75 * F.col("_z")
    df = df.withColumn("_nt", F.least(F.lit(3), F.floor("_t")).cast("long"))
    # Near a pole 1 - |z| loses digits; the cosine of the latitude doesn't.
    reach = n * math.sqrt(3.0) * F.cos(F.radians(F.col(lat))) / F.sqrt(1 + F.abs("_z"))
    clamp = lambda v: F.least(F.lit(n - 1).cast("long"), F.floor(v).cast("long"))
    df = df.withColumns({
        "_jp": F.when(flat, F.floor(a - b).cast("long")).otherwise(clamp((F.col("_t") - F.col("_nt")) * reach)),
        "_jm": F.when(flat, F.floor(a + b).cast("long")).otherwise(clamp((1 - F.col("_t") + F.col("_nt")) * reach)),
    })
    fp, fm, mask = F.shiftright("_jp", level), F.shiftright("_jm", level), F.lit(n - 1).cast("long")
    north = F.col("_z") >= 0
    belt = F.when(fp == fm, F.pmod(fp, F.lit(4)) + 4).when(fp < fm, F.pmod(fp, F.lit(4))).otherwise(F.pmod(fm, F.lit(4)) + 8)
    df = df.withColumns({
        "_f": F.when(flat, belt).otherwise(F.when(north, F.col("_nt")).otherwise(F.col("_nt") + 8)).cast("long"),
        "_x": F.when(flat, F.col("_jm").bitwiseAND(mask)).otherwise(F.when(north, n - 1 - F.col("_jm")).otherwise(F.col("_jp"))),
        "_y": F.when(flat, n - 1 - F.col("_jp").bitwiseAND(mask)).otherwise(F.when(north, n - 1 - F.col("_jp")).otherwise(F.col("_jm"))),
    })
    made = F.shiftleft("_f", 2 * level) + spread_bits(F.col("_x"), level) + 2 * spread_bits(F.col("_y"), level)
    return df.withColumn(cell, made).drop("_z", "_t", "_nt", "_jp", "_jm", "_f", "_x", "_y")


def parent(cell: Column, levels: int = 1) -> Column:
    """The nested ancestor so many levels up: cell >> 2 levels."""
    return F.shiftright(cell.cast("long"), 2 * levels)


def cells(spark: SparkSession, level: int) -> DataFrame:
    """All cells of a level, made where they are needed."""
    return spark.range(npix(level)).withColumnRenamed("id", "cell")
