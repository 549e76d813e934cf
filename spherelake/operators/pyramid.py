"""The public verbs: weights, regridding, pyramids.

A dataset may be a table with a source index (``src``), or one with its source
dimensions as they come (``y`` and ``x``, or a cell dimension): the index is made from
those whose sizes are what the weights expect.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions import healpix, names
from spherelake.functions.sphere import npix, resolution_to_level, to_degrees
from spherelake.operators import apply, coarsen, grid, mesh, weights
from spherelake.operators.weights import METHODS, WeightsMeta
from spherelake.session import cut
from spherelake.sources import store
from spherelake.sources.readers import path_exists


@dataclass
class Source:
    """A source grid: kind, and its axis tables (idx, deg) or points (src, y, x, lat, lon[, vlon, vlat]).

    ``units`` are those of the coordinates: deg, rad, or auto, by their size.  ``prepare``
    brings data to the grid's points first, where they aren't there yet (spectral fields).
    """

    kind: str
    lat: DataFrame | None = None
    lon: DataFrame | None = None
    points: DataFrame | None = None
    dims: tuple[str, ...] = ("y", "x")
    units: str = "deg"
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self) -> None:
        if self.units == "deg":
            return
        radians = self.units == "rad" or names.in_radians(self.points, self.lon, self.lat)
        if radians:
            self.lat, self.lon = (None if a is None else to_degrees(a, ["deg"], "rad") for a in (self.lat, self.lon))
            if self.points is not None:
                arrays = {c: F.transform(c, F.degrees) for c in ("vlon", "vlat") if c in self.points.columns}
                self.points = to_degrees(self.points, ["lat", "lon"], "rad").withColumns(arrays)
        self.units = "deg"

    @staticmethod
    def of(points: DataFrame, kind: str = "auto", grid_types: tuple[str, ...] = (), units: str = "auto") -> Source:
        """A source from a table of points as it comes, whatever its coordinates are called.

        With two spatial dimensions the grid is regular if latitudes follow from the one and
        longitudes from the other, else curvilinear; with a dimension of cells it is unstructured.
        """
        lat, lon = names.find_coordinates(points.columns)
        own = points.withColumnsRenamed({lat: "lat", lon: "lon"})
        cells = [c for c in own.columns if c in names.UNSTRUCTURED_DIMS]
        if names.is_unstructured(own.columns, grid_types) or kind == "unstructured":
            own = own.withColumnRenamed(cells[0], "src") if cells else own
            return Source("unstructured", points=own, dims=(cells[0] if cells else "cell",), units=units)
        y, x = names.find_spatial_dims([c for c in own.columns if c not in ("lat", "lon")])
        own = own.withColumnsRenamed({y: "y", x: "x"})
        axes = [own.groupBy(F.col(i).cast("int").alias("idx")).agg(F.min(v).alias("deg"), F.max(v).alias("most")) for i, v in (("y", "lat"), ("x", "lon"))]
        regular = all(a.where("deg < most").isEmpty() for a in axes) if kind == "auto" else False
        kind = names.classify((y, x), 1 if regular else 2, grid_types, kind)
        if kind == "regular":
            lat_axis, lon_axis = (cut(a.select("idx", "deg")) for a in axes)
            return Source(kind, lat_axis, lon_axis, dims=(y, x), units=units)
        if "src" not in own.columns:
            nx = F.broadcast(own.agg((F.max("x") + 1).alias("_nx")))
            own = own.crossJoin(nx).withColumn("src", F.col("y").cast("long") * F.col("_nx") + F.col("x")).drop("_nx")
        return Source(kind, points=own, dims=(y, x), units=units)

    def centres(self) -> DataFrame:
        if self.points is None and self.kind == "regular":
            self.points = grid.regular(self.lat, self.lon)
        if self.points is None:
            raise ValueError(f"a {self.kind} source needs points")
        return self.points

    def faces(self) -> DataFrame:
        if self.kind == "regular":
            return mesh.regular_faces(self.lat, self.lon)
        if self.kind == "curvilinear":
            return mesh.curvilinear_faces(self.centres())
        if self.kind == "unstructured":
            points = self.centres()
            if not {"vlon", "vlat"} <= set(points.columns):
                raise ValueError("an unstructured source needs the vertices of its cells (vlon, vlat)")
            return mesh.check_vertices(points.withColumnRenamed("src", "face"))
        raise ValueError(f"{self.kind} sources must be brought to grid points first")

    def describe(self) -> dict[str, object]:
        """Size, coverage and whether the grid goes round the sphere: one row to the driver."""
        points = self.centres()
        row = grid.coverage(points).crossJoin(points.agg(F.count(F.lit(1)).alias("n"))).first()
        return {"kind": self.kind, "dims": self.dims, "size": row["n"], "is_global": row["is_global"], "lon_coverage": row["lon_coverage"], "lat_coverage": row["lat_coverage"]}

    def resolution(self) -> float:
        if self.kind == "regular":
            return grid.resolution_regular(self.lat, self.lon).first()["resolution"]
        made = grid.resolution_curvilinear if self.kind == "curvilinear" else grid.resolution_unstructured
        return made(self.centres()).first()["resolution"]


@dataclass(frozen=True)
class Prepared:
    """Weights ready to be applied to any number of fields."""

    table: DataFrame
    meta: WeightsMeta
    path: str | None = None
    notes: dict[str, str] = field(default_factory=dict)


def compute_weights(spark: SparkSession, source: Source, level: int, method: str = "nearest", nest: bool = True, ignore_unmapped: bool | None = None, weights_path: str | None = None) -> Prepared:
    """Weights from a source grid to a level.  Ring order is for nearest weights.

    Cells without a source are an error for a global source, and left without weights
    for any other, unless ``ignore_unmapped`` says otherwise.  With ``weights_path`` they
    are written there, for ``open_weights``.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    if not nest and method == "conservative":
        raise ValueError("conservative weights are made for nested cells")
    about = source.describe()
    meta = WeightsMeta(method, level, "nested" if nest else "ring", source.kind, source.dims, about["size"])
    if method == "nearest":
        target = healpix.with_centres(healpix.cells(spark, level), level, nest=nest).withColumnRenamed("cell", "dst")
        table = weights.nearest(source.centres(), target)
    else:
        table = weights.conservative(source.faces(), mesh.healpix_faces(spark, level))
    # Every level and variable reads them again, so they are made once and kept where an executor's loss doesn't matter.
    table = cut(table)
    weights.check_unmapped(table, spark, level, not about["is_global"] if ignore_unmapped is None else ignore_unmapped)
    if weights_path is not None:
        table.write.mode("overwrite").parquet(weights_path)
        spark.createDataFrame([(json.dumps(asdict(meta)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{weights_path}.json")
    return Prepared(table, meta, weights_path)


def open_weights(spark: SparkSession, path: str, meta: WeightsMeta | None = None) -> Prepared:
    """Weights from a file, in either naming dialect; what they are is in the file beside it, unless it is given."""
    if meta is None:
        if not path_exists(spark, f"{path}.json"):
            raise ValueError(f"nothing says which level and grid the weights at {path} are of; pass meta")
        about = json.loads(spark.read.text(f"{path}.json").first()["value"])
        meta = WeightsMeta(**about | {"source_dims": tuple(about["source_dims"])})
    table = spark.read.parquet(path)
    return Prepared(table if {"dst", "src", "w"} <= set(table.columns) else weights.import_weights(table), meta, path)


def cached_weights(spark: SparkSession, root: str, source: Source, level: int | None = None, method: str = "conservative", nest: bool = True) -> Prepared:
    """The same, kept under a key of geometry, level and method.  The level is resolved first."""
    level = resolution_to_level(source.resolution()) if level is None else level
    meta = WeightsMeta(method, level, "nested" if nest else "ring", source.kind, source.dims, source.centres().count())
    table, path = weights.cached(spark, root, source.centres(), meta, lambda: compute_weights(spark, source, level, method, nest).table)
    return Prepared(table, meta, path)


def with_source_index(data: DataFrame, prepared: Prepared, variables: list[str], batch: list[str], source_dims: tuple[str, ...] | None = None, grid: Source | None = None) -> DataFrame:
    """The data with a column ``src``, made from the source dimensions if it isn't there; an error if the sizes don't match."""
    expected = prepared.meta.source_size
    if "src" in data.columns and source_dims is None:
        most = data.agg(F.max("src")).first()[0]
        if expected and most is not None and most >= expected:
            apply.check_size(most + 1, expected)
        return data
    kinds = dict(data.dtypes)
    dims = [c for c in data.columns if c not in (*variables, *batch) and kinds[c] in ("tinyint", "smallint", "int", "bigint")]
    row = data.agg(*[(F.max(c) + 1).alias(c) for c in dims]).first() if dims else None
    sizes = {c: row[c] or 0 for c in dims}
    own = None if grid is None else (grid.dims, grid.centres().count())
    spatial = None
    if expected and len(dims) > 1:
        try:
            spatial = names.find_spatial_dims(dims)
        except ValueError:
            spatial = None
    inferred = None if spatial is None else (spatial, names.flat_size(sizes, spatial))
    found = names.resolve_dims(sizes, expected, source_dims, prepared.meta.source_dims, own, inferred)
    index = F.lit(0).cast("long")
    for d in found:
        index = index * sizes[d] + F.col(d)
    return data.withColumn("src", index).drop(*found)


def apply_prepared(data: DataFrame, prepared: Prepared, variables: list[str], batch: list[str], policy: str = "renormalize", strategy: str = "auto", source_dims: tuple[str, ...] | None = None, grid: Source | None = None) -> DataFrame:
    """(batch..., cell, variables..., lon, lat): the field on all cells of the weights' level."""
    own = with_source_index(data, prepared, variables, batch, source_dims, grid)
    out = apply.apply_weights(own, prepared.table, variables, batch, prepared.meta.target_size, policy, strategy=strategy)
    return apply.attach_centres(out.withColumnRenamed("dst", "cell"), prepared.meta.level, nest=prepared.meta.order == "nested")


def apply_dataset(tables: dict[str, DataFrame], prepared: Prepared, batch: list[str], **more) -> dict[str, DataFrame]:
    """Each variable's table regridded; one without the source dimensions passes through as it is.

    A table has the variable in a column of its name, and the batch columns that it depends on.
    """
    out = {}
    for name, data in tables.items():
        there = {"src"} <= set(data.columns) or set(prepared.meta.source_dims) <= set(data.columns) or any(c in names.UNSTRUCTURED_DIMS for c in data.columns)
        out[name] = apply_prepared(data, prepared, [name], [c for c in batch if c in data.columns], **more) if there else data
    return out


def regrid(data: DataFrame, source: Source, level: int, variables: list[str], batch: list[str], method: str = "conservative", nest: bool = True, prepared: Prepared | None = None, policy: str = "renormalize") -> DataFrame:
    prepared = prepared or compute_weights(data.sparkSession, source, level, method, nest)
    return apply_prepared(data.transform(source.prepare) if source.prepare else data, prepared, variables, batch, policy)


def cached_faces(spark: SparkSession, root: str, source: Source) -> DataFrame:
    """A source's polygons, kept as a table under a key of its points."""
    path = f"{root.rstrip('/')}/faces_{weights.grid_digest(source.centres(), source.kind)}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        source.faces().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def regrid_unstructured(data: DataFrame, source: Source, level: int, variables: list[str], batch: list[str], **more) -> DataFrame:
    if source.kind != "unstructured":
        raise ValueError(f"an unstructured source is needed, not a {source.kind} one")
    return regrid(data, source, level, variables, batch, **more)


def pyramid(
    data: DataFrame,
    source: Source,
    variables: list[str],
    batch: list[str],
    max_level: int | None = None,
    min_level: int = 0,
    method: str = "conservative",
    nest: bool = True,
    how: str = "auto",
    fraction: float = 0.5,
) -> dict[int, DataFrame]:
    """Levels from the finest down, each (batch..., cell, variables..., lon, lat).

    Nested levels are coarsened one step at a time, so missing values spread as they do
    step by step; ring levels are regridded one by one, each with weights of its own.
    Every level that another is made from is cut from its lineage, so none is made twice.
    """
    return {level: df for level, df, _ in _levels(data, source, variables, batch, max_level, min_level, method, nest, how, fraction, lambda level, df, meta: cut(df) if nest and level > min_level else df)}


def _levels(data, source, variables, batch, max_level, min_level, method, nest, how, fraction, keep, regridder=None):
    """(level, table, metadata) from the finest level down; ``keep`` says what the next level is made from."""
    top = resolution_to_level(source.resolution()) if max_level is None else max_level
    if not 0 <= min_level <= top:
        raise ValueError(f"min_level must be in [0, {top}], not {min_level}")
    spark, last = data.sparkSession, None
    for level in range(top, min_level - 1, -1):
        if last is None or not nest:
            prepared = compute_weights(spark, source, level, method, nest)
            made, meta = (regridder or regrid)(data, source, level, variables, batch, prepared=prepared), level_metadata(prepared.meta)
            about = prepared.meta
        else:
            made = coarsen.coarsen(last, variables, batch, level + 1, level, how, fraction, method, dense=True)
            made, meta = apply.attach_centres(made, level), level_metadata(at_level(about, level), level + 1)
        last = keep(level, made, meta)
        yield level, last, meta


def write_pyramid(data: DataFrame, source: Source, variables: list[str], batch: list[str], root: str, max_level: int | None = None, min_level: int = 0, method: str = "conservative", nest: bool = True, how: str = "auto", fraction: float = 0.5, mode: str = "w", region: tuple[int, int] | None = None, time_index: str = "time_idx", regridder: Callable[..., DataFrame] | None = None) -> list[int]:
    """Write all levels with their metadata, each made from the one that was written before it.

    ``regridder`` takes the place of ``regrid``, with its arguments.
    """

    def keep(level: int, df: DataFrame, meta: dict) -> DataFrame:
        store.save_level(df, root, level, mode, region, time_index, metadata=meta)
        written = store.read_level(data.sparkSession, root, level)
        # Of a store that had times before, the next level is made from the data's own.
        return written if mode == "w" else written.join(df.select(*batch).distinct(), batch, "left_semi")

    return [level for level, _, _ in _levels(data, source, variables, batch, max_level, min_level, method, nest, how, fraction, keep, regridder)]


latlon_pyramid = pyramid


def stacked(levels: dict[int, DataFrame]) -> DataFrame:
    """One table with a level column, finest first."""
    out = None
    for level, df in sorted(levels.items(), reverse=True):
        own = df.withColumn("level", F.lit(level))
        out = own if out is None else out.unionByName(own)
    return out


def level_metadata(meta: WeightsMeta, coarsened_from: int | None = None) -> dict[str, object]:
    """What is stored with a level: geometry and where it came from."""
    out = {
        "healpix_level": meta.level, "healpix_nside": 1 << meta.level, "healpix_order": meta.order, "npix": npix(meta.level), "remap_method": meta.method, "source_kind": meta.source_kind, "source_dims": list(meta.source_dims), "source_size": meta.source_size,
        "crs": {"grid_mapping_name": "healpix", "nside": 1 << meta.level, "level": meta.level, "order": meta.order},
    }
    return out | ({} if coarsened_from is None else {"coarsened_from_level": coarsened_from})


def at_level(meta: WeightsMeta, level: int) -> WeightsMeta:
    return replace(meta, level=level)
