"""Polygon meshes: faces with their vertices as arrays, and shared nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.functions.sphere import canonical_lon, centroid, counter_clockwise, signed_area, valid
from spherelake.operators import grid as grids

#: Bins of a degree of longitude in which nodes are numbered.
BINS = 100
#: Nodes are one if their coordinates agree to so many decimals (fixed value).
DECIMALS = 12


def regular_faces(lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """(face, y, x, node_ids, vlon, vlat) of a regular grid's cells.

    Corners are (y, x), (y, x+1), (y+1, x+1), (y+1, x).  If the longitudes go round, the
    last column's right corners are the first column's left ones.  Latitude bounds end
    at the poles.
    """
    lat = grids.bounds(lat_axis, clamp=90.0).select(F.col("idx").alias("y"), F.col("lower").alias("south"), F.col("upper").alias("north"))
    lon = grids.bounds(lon_axis).select(F.col("idx").alias("x"), F.col("lower").alias("west"), F.col("upper").alias("east"))
    round_ = F.broadcast(grids.lon_coverage(lon_axis, "deg").select((F.col("coverage") >= grids.GLOBAL_LON).alias("periodic")))
    nx = F.broadcast(lon_axis.agg(F.count(F.lit(1)).alias("nx")))
    both = lat.crossJoin(lon).crossJoin(round_).crossJoin(nx)
    columns = F.when(F.col("periodic"), F.col("nx")).otherwise(F.col("nx") + 1)
    node = lambda y, x: (y * columns + F.when(F.col("periodic"), F.pmod(x, F.col("nx"))).otherwise(x)).cast("long")
    y, x = F.col("y"), F.col("x")
    return both.select(
        (y.cast("long") * F.col("nx") + x).alias("face"),
        "y",
        "x",
        F.array(node(y, x), node(y, x + 1), node(y + 1, x + 1), node(y + 1, x)).alias("node_ids"),
        F.array("west", "east", "east", "west").alias("vlon"),
        F.array("south", "south", "north", "north").alias("vlat"),
    )


def curvilinear_faces(grid: DataFrame) -> DataFrame:
    """(face, y, x, vlon, vlat) from corner means; never periodic.  ``grid`` has src, y, x, lat, lon."""
    corner = grids.corners(grid)
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 1), (1, 0)))]))
    wanted = grid.select(F.col("src").alias("face"), "y", "x", steps.alias("s")).select("face", "y", "x", "s.k", (F.col("y") + F.col("s.a")).alias("cy"), (F.col("x") + F.col("s.b")).alias("cx"))
    met = wanted.join(corner, ["cy", "cx"])
    packed = met.groupBy("face", "y", "x").agg(F.array_sort(F.collect_list(F.struct("k", "lon", "lat"))).alias("v"))
    return packed.select("face", "y", "x", F.transform("v", lambda v: v["lon"]).alias("vlon"), F.transform("v", lambda v: v["lat"]).alias("vlat"))


def healpix_faces(spark, level: int) -> DataFrame:
    """(face, vlon, vlat) of all nested cells of a level."""
    return healpix.with_vertices(healpix.cells(spark, level), level).select(F.col("cell").alias("face"), "vlon", "vlat")


def check_vertices(faces: DataFrame) -> DataFrame:
    """Fail on the first face with fewer than three finite vertices; else return the faces."""
    finite = F.filter(F.arrays_zip("vlon", "vlat"), lambda v: valid(v["vlon"]) & valid(v["vlat"]))
    bad = faces.where(F.size(finite) < 3).agg(F.min("face").alias("face")).first()["face"]
    if bad is not None:
        raise ValueError(f"face {bad} has fewer than three finite vertices")
    return faces


def nodes_and_faces(faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shared nodes (node_id, lon, lat) and faces (face, node_ids, lon, lat) of corner polygons.

    Vertices that agree to 12 decimals are one node, represented by the first of them;
    ids follow the order of (lon, lat).  Vertices that aren't finite are left out; a
    face's centre is the mean direction of its vertices.
    """
    lo = F.round(canonical_lon(F.col("v.vlon")), DECIMALS)
    la = F.round(F.col("v.vlat"), DECIMALS)
    corner = faces.select("face", F.posexplode(F.arrays_zip("vlon", "vlat")).alias("k", "v")).select("face", "k", lo.alias("klon"), la.alias("klat"), F.col("v.vlon").alias("lon"), F.col("v.vlat").alias("lat"))
    corner = corner.where(valid(F.col("klon")) & valid(F.col("klat")))
    keys = corner.groupBy("klon", "klat").agg(F.min(F.struct("face", "k", "lon", "lat")).alias("first"))
    # Dense ids without one big window: rank within bins of longitude, plus what the bins before hold (some 36,000 rows).
    ranged = keys.withColumn("part", F.floor(F.col("klon") * BINS))
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("klon", "klat"))
    numbered = ranged.withColumn("rank", rank).join(F.broadcast(before), "part").select("klon", "klat", (F.col("offset") + F.col("rank") - 1).alias("node_id"), "first")
    nodes = numbered.select("node_id", canonical_lon(F.col("first.lon")).alias("lon"), F.col("first.lat").alias("lat"))
    met = corner.join(numbered.select("klon", "klat", "node_id"), ["klon", "klat"])
    packed = met.groupBy("face").agg(F.array_sort(F.collect_list(F.struct("k", "node_id", "lon", "lat"))).alias("v"))
    lon, lat = centroid(F.transform("v", lambda v: v["lon"]), F.transform("v", lambda v: v["lat"]))
    return nodes, packed.select("face", F.transform("v", lambda v: v["node_id"]).alias("node_ids"), lon.alias("lon"), lat.alias("lat"))


def valid_faces(faces: DataFrame, n_nodes: int) -> DataFrame:
    """Faces (face, node_ids) without closing or repeated neighbours.

    A face is rejected if it has fewer than three nodes, before or after that, a missing
    node or one out of range, or a node twice.
    """
    broken = F.exists("node_ids", lambda v: v.isNull() | (v < 0) | (v >= n_nodes))
    kept = faces.where((F.size("node_ids") >= 3) & ~broken).withColumn("n", F.col("node_ids"))
    new = F.filter("n", lambda v, i: (i == 0) | (v != F.get("n", i - 1)))
    kept = kept.withColumn("n", new)
    opened = F.when((F.size("n") > 1) & (F.get("n", F.lit(0)) == F.get("n", F.size("n") - 1)), F.slice("n", F.lit(1), F.greatest(F.size("n") - 1, F.lit(0)))).otherwise(F.col("n"))
    kept = kept.withColumn("n", opened)
    return kept.where((F.size("n") >= 3) & (F.size(F.array_distinct("n")) == F.size("n"))).select("face", F.col("n").alias("node_ids"))


def ordered_vertices(faces: DataFrame) -> DataFrame:
    """Faces (face, vlon, vlat, lon, lat) with vertices by angle round the centre, counter-clockwise."""
    la, d = F.radians(F.col("v.vlat")), F.radians(F.col("v.vlon") - F.col("lon"))
    east, c = F.cos(la) * F.sin(d), F.radians(F.col("lat"))
    north = F.cos(c) * F.sin(la) - F.sin(c) * F.cos(la) * F.cos(d)
    spread = faces.select("face", "lon", "lat", F.posexplode(F.arrays_zip("vlon", "vlat")).alias("k", "v"))
    turned = spread.select("face", "lon", "lat", F.struct(F.atan2(north, east).alias("angle"), "k", F.col("v.vlon").alias("vlon"), F.col("v.vlat").alias("vlat")).alias("s"))
    packed = turned.groupBy("face", "lon", "lat").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return packed.select("face", F.transform("s", lambda s: s["vlon"]).alias("vlon"), F.transform("s", lambda s: s["vlat"]).alias("vlat"), "lon", "lat")


def ensure_ccw(faces: DataFrame) -> DataFrame:
    """Faces (face, vlon, vlat, lon, lat) with the vertices reversed where they run clockwise."""
    area = signed_area(F.col("vlon"), F.col("vlat"), F.col("lon"), F.col("lat"))
    signed = faces.withColumn("_area", area)
    return signed.select("face", counter_clockwise(F.col("vlon"), F.col("_area")).alias("vlon"), counter_clockwise(F.col("vlat"), F.col("_area")).alias("vlat"), "lon", "lat")


def triangle_fan(faces: DataFrame) -> DataFrame:
    """(face, k, a, b, c): the triangles from each face's first node."""
    fan = F.explode(F.sequence(F.lit(1), F.size("node_ids") - 2))
    node = lambda i: F.get("node_ids", i)
    return faces.where(F.size("node_ids") >= 3).select("face", "node_ids", fan.alias("k")).select("face", "k", node(F.lit(0)).alias("a"), node(F.col("k")).alias("b"), node(F.col("k") + 1).alias("c"))
