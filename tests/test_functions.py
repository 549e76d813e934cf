import math

import pytest
from pyspark.sql import functions as F

from spherelake.functions import healpix, names, sizing, sphere, text


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_canonical_longitude(spark):
    df = spark.createDataFrame([(float(v),) for v in (-190, -180, 0, 180, 190)], "v double")
    assert [r[0] for r in rows(df, sphere.canonical_lon(F.col("v")))] == [170, -180, 0, -180, -170]


def test_units(spark):
    df = spark.createDataFrame([(0.0,), (math.pi / 2,), (math.pi,)], "v double")
    assert [round(r[0], 9) for r in rows(sphere.to_degrees(df, ["v"], "auto"), "v")] == [0, 90, 180]
    assert [r[0] for r in rows(sphere.to_degrees(df, ["v"], "deg"), "v")] == [0, math.pi / 2, math.pi]
    with pytest.raises(ValueError, match="unknown units"):
        sphere.to_degrees(df, ["v"], "grad")


def test_valid_means_finite(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r[0] for r in rows(df, sphere.valid(F.col("v")))] == [True, False, False, False, False]


def test_zero_vector_is_an_error(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "x double, y double, z double")
    with pytest.raises(Exception, match="zero vector"):
        df.select(*sphere.lonlat(F.col("x"), F.col("y"), F.col("z"))).collect()


@pytest.mark.parametrize(("resolution", "level"), [(58.6, 0), (29.3, 1), (1.0, 5), (0.25, 7), (100.0, 0)])
def test_level_of_resolution(resolution, level):
    assert sphere.resolution_to_level(resolution) == level


def test_resolution_must_be_positive():
    with pytest.raises(ValueError):
        sphere.resolution_to_level(0)


@pytest.mark.parametrize("level", range(6))
def test_points_and_cells_go_round(spark, level):
    df = healpix.with_cell(healpix.with_centres(healpix.cells(spark, level), level), level, cell="back")
    assert df.where("cell <> back").count() == 0


@pytest.mark.parametrize("level", [1, 3])
def test_children_lie_in_their_parent(spark, level):
    df = healpix.with_cell(healpix.with_centres(healpix.cells(spark, level + 1), level + 1), level, cell="holder")
    assert df.where("holder <> shiftright(cell, 2)").count() == 0


def test_ring_and_nested_have_the_same_centres(spark):
    points = lambda nest: sorted((round(a, 8), round(b, 8)) for a, b in rows(healpix.with_centres(healpix.cells(spark, 3), 3, nest=nest), "lon", "lat"))
    assert points(True) == points(False)


def test_ring_cells_run_from_north_to_south(spark):
    lat = [r[0] for r in rows(healpix.with_centres(healpix.cells(spark, 2), 2, nest=False).orderBy("cell"), "lat")]
    assert all(a >= b - 1e-9 for a, b in zip(lat, lat[1:]))


def test_chunk_sizes():
    assert sizing.chunk_sizes(8) == {"time": 10, "cell": 786432}
    assert sizing.chunk_sizes(8, access="time_series", ntime=365) == {"time": 365, "cell": 22982}
    assert sizing.chunk_sizes(15, stored_mib=0.001)["time"] == 1
    assert sizing.chunk_sizes(2, access="time_series", ntime=5, max_time=100)["time"] == 5
    assert sizing.chunk_sizes(8, max_cell=1000)["cell"] == 1000
    with pytest.raises(ValueError, match="ntime"):
        sizing.chunk_sizes(3, access="time_series")
    with pytest.raises(ValueError, match="unknown access"):
        sizing.chunk_sizes(3, access="both")


@pytest.mark.parametrize(
    ("value", "dims"),
    [(None, None), ("", None), ('["y", "x"]', ("y", "x")), ('"cell"', ("cell",)), ("lat, lon", ("lat", "lon")), (("y", "x"), ("y", "x")), (["cell"], ("cell",)), (3, None), ("[1, 2]", None)],
)
def test_source_dims(value, dims):
    assert text.parse_dims(value) == dims


def test_dims_by_size():
    assert names.guess_dims({"cell": 10, "member": 10}, 10) == ("cell",)
    assert names.guess_dims({"a": 8, "b": 8}, 8) is None
    assert names.resolve_dims({"y": 2, "x": 3}, 6, stored=("y", "x")) == ("y", "x")
    assert names.resolve_dims({"y": 2, "x": 3, "cell": 6}, 6, stored=("gone",)) == ("cell",)
    with pytest.raises(ValueError, match="expect"):
        names.resolve_dims({"y": 2, "x": 3}, 5, explicit=("y", "x"))
    with pytest.raises(ValueError, match="does not match"):
        names.resolve_dims({"y": 2, "x": 3}, 5, grid=(("y", "x"), 6))
    with pytest.raises(ValueError, match="cannot tell"):
        names.resolve_dims({"y": 2, "x": 3}, 5)


def test_names():
    assert names.find_coordinates(["lon", "latitude", "lat"]) == ("lat", "lon")
    with pytest.raises(ValueError, match="no latitude"):
        names.find_coordinates(["a"])
    assert names.find_spatial_dims(["time", "Y", "X"]) == ("Y", "X")
    assert names.find_spatial_dims(["a", "b"], {"lat": ("a", "b")}) == ("a", "b")
    assert names.classify(["ncells"], 1) == "unstructured"
    assert names.classify(["y", "x"], 2) == "curvilinear"
    assert names.classify(["lat"], 1, kind="spectral") == "spectral"
    with pytest.raises(ValueError, match="classify"):
        names.classify(["lat"], 3)


def test_hashes_and_options():
    assert text.digest("a", 1) == text.digest("a", 1) != text.digest("a", 2)
    assert len(text.pair_hash("a", "b")) == 16
    assert text.s3_options("https://s", '{"accessKey": "k", "secretKey": "s"}') == {"endpoint_url": "https://s", "key": "k", "secret": "s"}
    with pytest.raises(ValueError, match="object"):
        text.s3_options("https://s", "[]")
