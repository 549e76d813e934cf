"""Regridding weights as tables (dst, src, w): nearest neighbours and conservative overlaps.

Both searches put unit vectors into cubes of a three-dimensional lattice, which knows
neither poles nor a date line, and meet in equi-joins on the cube.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.functions.sphere import npix, xyz
from spherelake.functions.text import digest
from spherelake.session import cut, ship

METHODS = ("nearest", "conservative")
_AROUND = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
_CUBE = ("ix", "iy", "iz")
#: Points of an array in the nearest search, and sources up to which the arrays are broadcast (27 entries a source at most).
PACK, SMALL = 1024, 10_000


@dataclass(frozen=True)
class WeightsMeta:
    """What was regridded to what.  Sizes come from here, not from the largest index that has a weight."""

    method: str
    level: int
    order: str = "nested"
    source_kind: str = "regular"
    source_dims: tuple[str, ...] = ("y", "x")
    source_size: int = 0

    @property
    def target_size(self) -> int:
        return npix(self.level)


def _cube(h: float, *v: Column) -> list[Column]:
    return [F.floor((c + 1.0) / h).cast("int").alias(n) for c, n in zip(v, _CUBE)]


def _around() -> Column:
    return F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in _AROUND]))


def _spread(df: DataFrame, edge: float) -> DataFrame:
    """Each row once for each of the 27 cubes around its own that the sphere may pass through."""
    rest = [c for c in df.columns if c not in _CUBE]
    out = df.select(*rest, *_CUBE, _around().alias("o")).select(*rest, *[(F.col(i) + F.col(f"o.{k}")).alias(i) for i, k in zip(_CUBE, "abc")])
    middle = [(F.col(i) + 0.5) * edge - 1.0 for i in _CUBE]
    return out.where(F.abs(F.sqrt(sum(m * m for m in middle)) - 1.0) <= edge * math.sqrt(3) / 2 + 1e-9)


def _rounded(s: Column) -> Column:
    return F.struct(F.round(s["far"], 12).alias("far"), s["src"].alias("src"))


def _nearer(a: Column, b: Column) -> Column:
    """The nearer one by the rounded distance, of equals the one with the least src; only close ones are rounded, which is slow."""
    return F.when(b["far"] < a["far"] - 2e-12, b).when(b["far"] > a["far"] + 2e-12, a).otherwise(F.least(_rounded(a), _rounded(b)))


def nearest(source: DataFrame, target: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(dst, src, w = 1): for each target point the nearest source point.

    Both tables have lon and lat.  Distances are compared by the dot product rounded to
    12 decimals; of equals the least src wins.  Targets look into the 27 cubes around
    them; those that find nothing within a cube's edge look again with cubes of twice
    the edge, until all have found theirs.  What a round has found, and what is left, is
    cut from its lineage, so every round's plan is as small as the first one's.

    Sources meet targets as arrays of some PACK points, and each array gives its nearest
    one at once, so no pair becomes a row.  The sources are laid out over the cubes around
    them, so that targets stay single rows; only where targets are far fewer, they are.
    """
    vector = lambda df, key: df.select(F.col(key).alias("id"), *[c.alias(n) for c, n in zip(xyz(F.col("lon"), F.col("lat")), "xyz")])
    sources, left = vector(source, src), vector(target, dst)
    n = sources.count()
    if n == 0:
        raise ValueError("no source points")
    edge = min(2.0, 1.3 * math.sqrt(4 * math.pi / n))
    done: DataFrame | None = None
    while True:
        cube = _cube(edge, F.col("x"), F.col("y"), F.col("z"))
        homes, asks = sources.select(F.struct(F.col("id").alias("src"), "x", "y", "z").alias("s"), *cube), left.select("id", "x", "y", "z", *cube)
        if 27 * left.count() < n:
            asks = _spread(asks, edge)
        else:
            homes = _spread(homes, edge)
        counts = homes.groupBy(*_CUBE).count()
        crowd = counts.where(F.col("count") > PACK).select(*_CUBE, F.ceil(F.col("count") / PACK).cast("int").alias("parts"))
        at = [*_CUBE, "part"]
        if crowd.isEmpty():
            homes, asks = homes.withColumn("part", F.lit(0)), asks.withColumn("part", F.lit(0))
        else:
            # More than an array's worth: several arrays, which a target meets as so many rows, by any task.
            crowd, parts = F.broadcast(crowd) if 27 * n <= PACK * SMALL else crowd, F.coalesce("parts", F.lit(1))
            homes = homes.join(crowd, list(_CUBE), "left").select("s", *_CUBE, F.pmod(F.hash("s.src"), parts).alias("part"))
            asks = asks.join(crowd, list(_CUBE), "left").select("id", "x", "y", "z", *_CUBE, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
            # Few rows with much to compare: a number that is given isn't lowered for their size.
            asks = asks.repartition(int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *at)
        packs = homes.groupBy(*at).agg(F.collect_list("s").alias("pack"))
        met = asks.join(F.broadcast(packs) if n <= SMALL else packs, at, "left")
        far = lambda s: -(F.col("x") * s["x"] + F.col("y") * s["y"] + F.col("z") * s["z"])
        met = met.select("id", F.transform("pack", lambda s: F.struct(far(s).alias("far"), s["src"].alias("src"))).alias("all"))
        best = met.select("id", F.aggregate("all", F.get("all", F.lit(0)), _nearer, _rounded).alias("s")).groupBy("id").agg(F.min("s").alias("s"))
        # Within an edge (chord), nothing outside the 27 cubes is nearer, nor as near.
        near = F.col("s").isNotNull() & (2.0 + 2.0 * F.col("s.far") < F.lit(edge * edge * (1 - 1e-9) - 4e-12) if edge < 2 else F.lit(True))
        seen = cut(best.select(F.col("id").alias("dst"), F.col("s.src").alias("src"), F.coalesce(near, F.lit(False)).alias("near")))
        found, missed = seen.where("near").select("dst", "src"), seen.where("NOT near").select(F.col("dst").alias("id"))
        done = found if done is None else done.unionByName(found)
        if edge >= 2 or missed.isEmpty():
            break
        left = cut(left.join(missed, left["id"].eqNullSafe(missed["id"]), "left_semi"))
        edge = min(2.0, edge * 2)
    return done.withColumn("w", F.lit(1.0))


# --- conservative -----------------------------------------------------------


def vertices(batch: pa.RecordBatch, lon: str, lat: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All longitudes and latitudes of a batch's polygons, and how many each has; arrays that are NULL have none."""
    flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (lon, lat)]
    return flat[0], flat[1], pc.fill_null(pc.list_value_length(batch.column(lon)), 0).to_numpy().astype(np.int64)


def polygon_vectors(lons: np.ndarray, lats: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Padded unit vectors [n, m, 3] and vertex counts of polygons that follow each other in the arrays.

    Coincident neighbours are one vertex, and all run counter-clockwise.
    """
    n = len(counts)
    m = int(counts.max()) if n else 0
    inside = np.arange(m) < counts[:, None]
    lo, la = np.zeros((n, m)), np.zeros((n, m))
    lo[inside], la[inside] = np.radians(lons), np.radians(lats)
    v = np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], 2)
    before = v[np.arange(n)[:, None], (np.arange(m)[None, :] - 1) % counts[:, None]]
    keep = inside & (np.abs(v - before).max(2) > 1e-12)
    v, counts = compact(v, keep)
    turn = area(v, counts) < 0
    if turn.any():
        m = v.shape[1]
        at = np.where(turn[:, None], (counts[:, None] - 1 - np.arange(m)[None, :]) % np.maximum(counts, 1)[:, None], np.arange(m)[None, :])
        v = v[np.arange(n)[:, None], at]
    return v, counts


def compact(v: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Move the kept vertices of each polygon to the front."""
    counts = keep.sum(1)
    out = np.zeros((len(v), max(1, int(counts.max())) if len(v) else 1, 3))
    row, column = np.nonzero(keep)
    out[row, (np.cumsum(keep, 1) - 1)[row, column]] = v[row, column]
    return out, counts


def area(v: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signed areas of spherical polygons with great-circle edges, by fans of triangles."""
    total = np.zeros(len(v))
    a = v[:, 0]
    for k in range(1, v.shape[1] - 1):
        b, c = v[:, k], v[:, k + 1]
        det = np.einsum("ij,ij->i", a, np.cross(b, c))
        base = 1 + np.einsum("ij,ij->i", a, b) + np.einsum("ij,ij->i", b, c) + np.einsum("ij,ij->i", c, a)
        total += np.where(k + 1 < counts, 2 * np.arctan2(det, base), 0)
    return total


def clip(v: np.ndarray, counts: np.ndarray, normal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of polygons on the positive side of great circles, one circle each."""
    n, m = v.shape[:2]
    inside_row = np.arange(m) < counts[:, None]
    d = np.where(inside_row, np.einsum("nmk,nk->nm", v, normal), -1.0)
    d = np.where(np.abs(d) < 1e-15, 0.0, d)
    following = (np.arange(m)[None, :] + 1) % np.maximum(counts, 1)[:, None]
    rows = np.arange(n)[:, None]
    d2, v2 = d[rows, following], v[rows, following]
    keep = inside_row & (d >= 0)
    cross = inside_row & ((d > 0) & (d2 < 0) | (d < 0) & (d2 > 0))
    with np.errstate(invalid="ignore", divide="ignore"):
        t = np.where(cross, d / (d - d2), 0.0)
    p = v + t[..., None] * (v2 - v)
    p /= np.maximum(np.linalg.norm(p, axis=2, keepdims=True), 1e-300)
    both = np.stack([v, p], 2).reshape(n, 2 * m, 3)
    return compact(both, np.stack([keep, cross], 2).reshape(n, 2 * m))


def overlap(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Areas of the intersections of polygons ``a`` with convex polygons ``b``, pair by pair."""
    v, n = a, na
    for k in range(b.shape[1]):
        p, q = b[:, k], b[np.arange(len(b)), (k + 1) % np.maximum(nb, 1)]
        normal = np.where((k < nb)[:, None], np.cross(p, q), 0.0)
        # A circle without a normal cuts nothing.
        cut, count = clip(v, n, normal)
        whole = k >= nb
        if whole.any():
            width = max(v.shape[1], cut.shape[1])
            pad = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1]), (0, 0)))
            v, n = np.where(whole[:, None, None], pad(v), pad(cut)), np.where(whole, n, count)
        else:
            v, n = cut, count
    return np.where(n >= 3, np.maximum(area(v, n), 0.0), 0.0)


def _caps(faces: DataFrame, key: str) -> DataFrame:
    """(k, x, y, z, r): the bounding cap of each face, its radius as a chord."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, n = polygon_vectors(*vertices(batch, "vlon", "vlat"))
            inside = np.arange(v.shape[1]) < n[:, None]
            mean = v.sum(1)
            mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-300)
            r = np.where(inside, np.linalg.norm(v - mean[:, None], axis=2), 0).max(1)
            ok = n >= 3
            arrays = [batch.column("k"), *[pa.array(mean[:, i]) for i in range(3)], pa.array(r)]
            yield pa.RecordBatch.from_arrays(arrays, ["k", "x", "y", "z", "r"]).filter(pa.array(ok))

    ship(faces.sparkSession)
    return faces.select(F.col(key).alias("k"), "vlon", "vlat").mapInArrow(run, "k bigint, x double, y double, z double, r double")


def conservative(source: DataFrame, target: DataFrame, src: str = "face", dst: str = "face") -> DataFrame:
    """(dst, src, w): overlap area over the target polygon's area, great-circle edges.

    Both tables have vlon and vlat arrays; target polygons are convex.  Faces of fewer
    than three different vertices are ignored; a face as large as a hemisphere is an
    error.  Pairs come from an equi-join on lattice cubes whose edge holds the two
    caps' radii; source faces are grouped by the power of two of their radius, so that a
    few large ones don't coarsen the lattice for all.  The search moves keys and caps
    alone; the pairs that are left fetch their polygons.
    """
    size = F.ceil(F.log2(F.greatest("r", F.lit(1e-9)))).cast("int")
    a, b = cut(_caps(source, src).withColumn("size", size)), cut(_caps(target, dst))
    largest = b.agg(F.max("r").alias("r")).first()["r"]
    if largest is None:
        return source.sparkSession.createDataFrame([], "dst bigint, src bigint, w double")
    sizes = a.groupBy("size").agg(F.max("r").alias("r")).collect()  # one row per power of two
    if max([largest, *[s["r"] for s in sizes]]) >= math.sqrt(2):
        raise ValueError("a face is as large as a hemisphere")
    pairs: DataFrame | None = None
    for s in sizes:
        edge = s["r"] + largest + 1e-9
        own = a.where(F.col("size") == s["size"]).select("k", "x", "y", "z", "r", *_cube(edge, F.col("x"), F.col("y"), F.col("z")), _around().alias("o"))
        own = own.select(F.col("k").alias("src"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), F.col("r").alias("ar"), *[(F.col(i) + F.col(f"o.{c}")).alias(i) for i, c in zip(("ix", "iy", "iz"), "abc")])
        to = b.select(F.col("k").alias("dst"), "x", "y", "z", "r", *_cube(edge, F.col("x"), F.col("y"), F.col("z")))
        gap = (F.col("x") - F.col("ax")) ** 2 + (F.col("y") - F.col("ay")) ** 2 + (F.col("z") - F.col("az")) ** 2
        met = own.join(to, ["ix", "iy", "iz"]).where(gap <= (F.col("r") + F.col("ar") + 1e-9) ** 2).select("dst", "src")
        pairs = met if pairs is None else pairs.unionByName(met)
    pairs = pairs.join(source.select(F.col(src).alias("src"), F.col("vlon").alias("alon"), F.col("vlat").alias("alat")), "src")
    pairs = pairs.join(target.select(F.col(dst).alias("dst"), "vlon", "vlat"), "dst").select("dst", "src", "alon", "alat", "vlon", "vlat")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                (va, na), (vb, nb) = (polygon_vectors(*vertices(part, *p)) for p in (("alon", "alat"), ("vlon", "vlat")))
                w = overlap(va, na, vb, nb) / area(vb, nb)
                arrays = [part.column("dst"), part.column("src"), pa.array(w)]
                yield pa.RecordBatch.from_arrays(arrays, ["dst", "src", "w"]).filter(pa.array(w > 1e-14))

    return pairs.mapInArrow(run, "dst bigint, src bigint, w double")


def face_areas(faces: DataFrame, key: str = "face") -> DataFrame:
    """(key, area): spherical areas of faces on the unit sphere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v, n = polygon_vectors(*vertices(batch, "vlon", "vlat"))
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(np.where(n >= 3, area(v, n), 0.0))], [key, "area"])

    ship(faces.sparkSession)
    return faces.select(F.col(key).alias("k"), "vlon", "vlat").mapInArrow(run, f"`{key}` bigint, area double")


# --- tables of weights --------------------------------------------------------


def import_weights(df: DataFrame) -> DataFrame:
    """(dst, src, w) from either naming dialect; indices move to zero only if both begin at one or more.

    A table without rows is an error, and so is one without the columns of a dialect.
    """
    names = {"row": "dst", "dst_address": "dst", "col": "src", "src_address": "src", "S": "w", "remap_matrix": "w"}
    found = [c for c in df.columns if c in names]
    if sorted(names[c] for c in found) != ["dst", "src", "w"]:
        raise ValueError(f"no weight columns among {df.columns}")
    own = df.select(*[F.col(c).cast("double" if names[c] == "w" else "long").alias(names[c]) for c in found]).select("dst", "src", "w")
    least = own.agg(F.min("dst").alias("d"), F.min("src").alias("s")).first()
    if least["d"] is None:
        raise ValueError("the weight table is empty")
    shift = int(least["d"] >= 1 and least["s"] >= 1)
    return own.select((F.col("dst") - shift).alias("dst"), (F.col("src") - shift).alias("src"), "w")


def unmapped(weights: DataFrame, spark: SparkSession, level: int) -> DataFrame:
    """(cell): target cells without a weight."""
    return healpix.cells(spark, level).join(weights.select(F.col("dst").alias("cell")), "cell", "left_anti")


def check_unmapped(weights: DataFrame, spark: SparkSession, level: int, ignore: bool) -> None:
    """Fail if a target cell has no weight, unless that is to be ignored (as for regional sources)."""
    if not ignore and (row := unmapped(weights, spark, level).first()) is not None:
        raise ValueError(f"target cell {row['cell']} has no source; pass ignore_unmapped=True for a regional source")


def grid_digest(points: DataFrame, *parameters) -> str:
    """A key of a grid's geometry and parameters: sums of hashes of all coordinates, one row to the driver.

    The order of the points is nothing to it, but a point that occurs twice is.
    """
    hashes = [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in points.columns], F.lit(s)), F.lit((1 << 31) - 1)) for s in range(4)]
    row = points.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{s}") for s, h in enumerate(hashes)]).first()
    return digest(list(row), sorted(points.columns), *parameters)


def cached(spark: SparkSession, root: str, points: DataFrame, meta: WeightsMeta, make) -> tuple[DataFrame, str]:
    """Weights from ``root`` if they are there under the key of grid and parameters, else made and kept.

    The key holds the resolved level.  A table is written beside its place and moved
    there, so a broken job leaves nothing that looks complete.
    """
    key = grid_digest(points, asdict(meta))
    path = f"{root.rstrip('/')}/weights_{key}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        draft = f"{path}.draft"
        make().write.mode("overwrite").parquet(draft)
        about = spark.createDataFrame([(json.dumps(asdict(meta)),)], "value string")
        about.coalesce(1).write.mode("overwrite").text(f"{path}.json")
        fs.rename(jvm.org.apache.hadoop.fs.Path(draft), hadoop)
    return spark.read.parquet(path), path
