import math

import pytest
from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.operators import apply, coarsen, grid, mesh, pyramid, weights

NAN = float("nan")


@pytest.fixture(scope="module")
def simple(spark):
    return spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (1, 2, 1.0)], "dst long, src long, w double")


def field(spark, *slices):
    return spark.createDataFrame([(t, s, v) for t, values in enumerate(slices) for s, v in enumerate(values)], "t int, src long, v double")


def applied(df, weights_, **more):
    got = apply.apply_weights(df, weights_, ["v"], ["t"], 2, **more).orderBy("t", "dst").collect()
    return [r["v"] for r in got]


@pytest.mark.parametrize(
    ("slices", "policy", "want"),
    [
        ([[2, 4, 6]], "renormalize", [3, 6]),
        ([[10, NAN, 3]], "renormalize", [10, 3]),
        ([[10, NAN, 3]], "propagate", [None, 3]),
        ([[NAN, NAN, NAN]], "renormalize", [None, None]),
        ([[1, 2, 3], [4, 5, 6]], "renormalize", [1.5, 3, 4.5, 6]),
        ([[10, NAN, 3], [NAN, 20, 6]], "renormalize", [10, 3, 20, 6]),
        ([[float("inf"), 2, 3]], "renormalize", [2, 3]),
        # Only the middle slice has more gaps than the others.
        ([[1, 1, 1], [1, NAN, 1], [1, 1, 1]], "renormalize", [1, 1, 1, 1, 1, 1]),
    ],
)
def test_apply(spark, simple, slices, policy, want):
    assert applied(field(spark, *[[float(v) for v in s] for s in slices]), simple, policy=policy) == want


def test_absent_rows_are_missing(spark, simple):
    own = spark.createDataFrame([(0, 0, 10.0), (0, 2, 3.0)], "t int, src long, v double")
    assert applied(own, simple) == [10, 3]
    assert applied(own, simple, policy="propagate") == [None, 3]


@pytest.mark.parametrize("strategy", apply.STRATEGIES)
def test_strategies_agree(spark, simple, strategy):
    assert applied(field(spark, [2.0, 4.0, 6.0]), simple, strategy=strategy) == [3, 6]


def test_duplicate_weights_add_up(spark):
    w = spark.createDataFrame([(0, 0, 0.25), (0, 0, 0.25), (0, 1, 0.5)], "dst long, src long, w double")
    got = apply.apply_weights(field(spark, [2.0, 4.0]), w, ["v"], ["t"], 1, "propagate").collect()
    assert [r["v"] for r in got] == [3]


def test_bad_arguments(spark, simple):
    with pytest.raises(ValueError, match="policy"):
        apply.apply_weights(field(spark, [1.0]), simple, ["v"], ["t"], policy="other")
    with pytest.raises(ValueError, match="strategy"):
        apply.apply_weights(field(spark, [1.0]), simple, ["v"], ["t"], strategy="gpu")
    with pytest.raises(ValueError, match="does not match"):
        apply.check_size(2, 3)


def test_import_weights(spark):
    one = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5), (2, 3, 1.0)], "row int, col int, S double")
    assert sorted(map(tuple, weights.import_weights(one).collect())) == [(0, 0, 0.5), (0, 1, 0.5), (1, 2, 1.0)]
    zero = spark.createDataFrame([(0, 1, 1.0)], "dst_address int, src_address int, remap_matrix double")
    assert [tuple(r) for r in weights.import_weights(zero).collect()] == [(0, 1, 1.0)]
    with pytest.raises(ValueError, match="empty"):
        weights.import_weights(one.limit(0))
    with pytest.raises(ValueError, match="no weight columns"):
        weights.import_weights(one.drop("S"))


def cells(spark, values):
    return spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "t int, cell long, v double")


def parents(df):
    return [r["v"] for r in df.where("cell < 2").orderBy("cell").collect()]


@pytest.mark.parametrize(
    ("values", "fraction", "want"),
    [([1, 2, 3, 4, 5, 6, 7, 8], 0.5, [2.5, 6.5]), ([1, NAN, NAN, NAN], 0.5, [None]), ([1, 3, NAN, NAN], 0.5, [2]), ([1, NAN, NAN, NAN], 0.25, [1]), ([1, 2, 3, NAN], 1.0, [None])],
)
def test_mean(spark, values, fraction, want):
    got = coarsen.mean(cells(spark, [float(v) for v in values]), ["v"], ["t"], 1, fraction)
    assert parents(got) == want


@pytest.mark.parametrize(("values", "want"), [([5, 5, 5, 3], [5]), ([3, 3, 7, NAN], [3]), ([8, 2, 2, 8], [8]), ([2, 8, 8, 2], [2])])
def test_mode(spark, values, want):
    assert parents(coarsen.mode(cells(spark, [float(v) for v in values]), "v", ["t"], 1)) == want


def test_coarsen_twice_at_once(spark):
    own = cells(spark, [0.0, 2.0, 4.0, 6.0] * 192)
    assert {r["v"] for r in coarsen.coarsen(own, ["v"], ["t"], 3, 1).collect()} == {3.0}
    sparse = cells(spark, [1.0, NAN, NAN, NAN] * 192)
    assert {r["v"] for r in coarsen.coarsen(sparse, ["v"], ["t"], 3, 1).collect()} == {None}


def test_coarsen_rejects(spark):
    own = cells(spark, [1.0] * 48)
    with pytest.raises(ValueError, match="ring|nested"):
        coarsen.coarsen(own, ["v"], ["t"], 1, 0, order="ring")
    with pytest.raises(ValueError, match="target level"):
        coarsen.coarsen(own, ["v"], ["t"], 1, 1)
    with pytest.raises(ValueError, match="coarsen mode"):
        coarsen.coarsen(own, ["v"], ["t"], 1, 0, "median")
    with pytest.raises(ValueError, match="unknown aggregator"):
        coarsen.degrade(own, "v", ["t"], 1, 0, "median")
    assert coarsen.resolve_mode("auto", None) == "mean"


def axis(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "idx int, deg double")


def test_bounds(spark):
    got = grid.bounds(axis(spark, [0, 2, 4])).orderBy("idx").collect()
    assert [r["lower"] for r in got] == [-1, 1, 3] and got[-1]["upper"] == 5
    with pytest.raises(Exception, match="two points"):
        grid.bounds(axis(spark, [1])).collect()


def lat12(spark):
    return axis(spark, [-90 + 180 * i / 11 for i in range(12)])


def lon24(spark):
    return axis(spark, [15 * i for i in range(24)])


def test_regular_mesh(spark):
    faces = mesh.regular_faces(lat12(spark), lon24(spark))
    assert faces.select(F.explode("node_ids")).distinct().count() == 312
    small = mesh.regular_faces(axis(spark, [-67.5, -22.5, 22.5, 67.5]), axis(spark, [0, 45, 90, 135, 180, 225, 270, 315]))
    assert small.where("face = 7").first()["node_ids"][:2] == [7, 0]
    assert small.where("face = 7").first()["node_ids"][2:] == [8, 15]
    regional = mesh.regular_faces(axis(spark, [20, 25, 30, 35, 40]), axis(spark, [10, 14, 18, 22, 26, 30]))
    assert regional.select(F.explode("node_ids")).distinct().count() == 42


def test_global(spark):
    assert grid.coverage(grid.regular(lat12(spark), lon24(spark))).first()["is_global"]
    part = grid.regular(axis(spark, [20, 25, 30, 35, 40]), axis(spark, [10, 14, 18, 22, 26, 30]))
    assert not grid.coverage(part).first()["is_global"]


def brute_nearest(sources, targets):
    def v(p):
        a, b = map(math.radians, p)
        return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)

    own = [v(p) for p in sources]
    return [max(range(len(own)), key=lambda j: (round(sum(a * b for a, b in zip(v(t), own[j])), 12), -j)) for t in targets]


def test_nearest_against_brute_force(spark):
    import random

    rng = random.Random(4)
    # A dense cluster and a few far points, so that some targets must look further.
    sources = [(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(200)] + [(200.0, -80.0), (90.0, 89.9)]
    targets = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)]
    s = spark.createDataFrame([(i, *p) for i, p in enumerate(sources)], "src long, lon double, lat double")
    t = spark.createDataFrame([(i, *p) for i, p in enumerate(targets)], "dst long, lon double, lat double")
    got = dict(map(tuple, weights.nearest(s, t).select("dst", "src").collect()))
    assert [got[i] for i in range(300)] == brute_nearest(sources, targets)


def shuffled(spark):
    """Rows that all stages so far have written to shuffles."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    sc.listenerBus().waitUntilEmpty(30_000)
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def scattered(spark, n):
    lon, lat = F.col("id") * 137508 % 360000 / 1000.0 - 180.0, F.col("id") * 61803 % 180000 / 1000.0 - 90.0
    return spark.range(0, n, 1, 4).select((n - 1 - F.col("id")).alias("dst"), lon.alias("lon"), lat.alias("lat"))


def test_the_nearest_search_moves_targets_as_single_rows(spark):
    n, source = 20_000, spark.range(288).select(F.col("id").alias("src"), (F.col("id") % 24 * 15.0).alias("lon"), (F.floor(F.col("id") / 24) * 15.0 - 82.5).alias("lat"))
    before = shuffled(spark)
    assert weights.nearest(source, scattered(spark, n)).count() == n
    # Not 27 rows for each target, and no row for each pair.
    assert shuffled(spark) - before < 2 * n


@pytest.mark.parametrize(("pack", "small", "targets"), [(1024, 10_000, 300), (3, 10_000, 300), (3, 0, 300), (3, 0, 6), (1024, 0, 6)])
def test_nearest_by_any_layout(spark, monkeypatch, pack, small, targets):
    import random

    monkeypatch.setattr(weights, "PACK", pack)
    monkeypatch.setattr(weights, "SMALL", small)
    rng = random.Random(5)
    # A dense cluster, far points, places that occur twice, and targets just between two sources.
    sources = [(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(200)] + [(200.0, -80.0), (90.0, 89.9), (90.0, 89.9), (100.0, -40.0), (102.0, -40.0)]
    points = [(101.0, -40.0), (90.0, 89.9), (-180.0, -90.0)] + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(targets - 3)]
    s = spark.createDataFrame([(i, *p) for i, p in enumerate(sources)] + [(900, None, 1.0), (901, float("nan"), 1.0)], "src long, lon double, lat double")
    # A repeated row counts once; a target without a place has no source.
    t = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(0, *points[0]), (1000, None, 1.0)], "dst long, lon double, lat double")
    got = sorted(map(tuple, weights.nearest(s, t).select("dst", "src").collect()))
    assert got == list(enumerate(brute_nearest(sources, points)))


def test_conservative_keeps_integrals(spark):
    faces, target = mesh.regular_faces(lat12(spark), lon24(spark)), mesh.healpix_faces(spark, 1)
    w = weights.conservative(faces, target)
    rows = w.groupBy("dst").agg(F.sum("w").alias("s")).collect()
    assert len(rows) == 48 and all(abs(r["s"] - 1) < 1e-12 for r in rows)
    to = {r["face"]: r["area"] for r in weights.face_areas(target).collect()}
    own = {r["face"]: r["area"] for r in weights.face_areas(faces).collect()}
    given: dict[int, float] = {}
    for r in w.collect():
        given[r["src"]] = given.get(r["src"], 0) + r["w"] * to[r["dst"]]
    assert all(abs(given[k] - own[k]) < 1e-12 for k in own)
    assert abs(sum(own.values()) - 4 * math.pi) < 1e-9


def test_conservative_of_sizes_that_differ(spark):
    # A level-0 cell and the fine cells of the rest: each target is covered once.
    coarse = mesh.healpix_faces(spark, 0).where("face = 4")
    fine = mesh.healpix_faces(spark, 3).where("shiftright(face, 6) <> 4").select((F.col("face") + 100).alias("face"), "vlon", "vlat")
    got = weights.conservative(coarse.unionByName(fine), mesh.healpix_faces(spark, 3))
    own = got.where("src >= 100 AND src - 100 = dst")
    assert own.where("abs(w - 1) > 1e-9").count() == 0 and own.count() == 704
    assert got.where("src = 4 AND w > 0.999999").count() > 40


def test_unmapped(spark):
    w = spark.range(40).select(F.col("id").alias("dst"))
    weights.check_unmapped(w, spark, 1, ignore=True)
    with pytest.raises(ValueError, match="no source"):
        weights.check_unmapped(w, spark, 1, ignore=False)


def test_pyramid_levels(spark):
    source = pyramid.Source("regular", lat12(spark), lon24(spark))
    data = source.centres().select("src", F.lit(0).alias("t"), F.col("lat").alias("v"))
    got = pyramid.pyramid(data, source, ["v"], ["t"], max_level=2, min_level=1)
    assert sorted(got) == [1, 2] and got[1].count() == 48
    ring = pyramid.pyramid(data, source, ["v"], ["t"], max_level=1, method="nearest", nest=False)
    assert sorted(ring) == [0, 1]
    # Values follow the latitude that they were made from.
    far = got[2].where(F.abs(F.col("v") - F.col("lat")) > 10).count()
    assert far == 0


def test_sources(spark):
    with pytest.raises(ValueError, match="vertices"):
        pyramid.Source("unstructured", points=spark.createDataFrame([(0, 1.0, 2.0)], "src long, lat double, lon double")).faces()
    with pytest.raises(ValueError, match="unstructured"):
        pyramid.regrid_unstructured(None, pyramid.Source("regular"), 1, ["v"], ["t"])
    cell = healpix.with_centres(mesh.healpix_faces(spark, 1).withColumnRenamed("face", "cell"), 1).withColumnRenamed("cell", "src")
    source = pyramid.Source("unstructured", points=cell, dims=("cell",))
    data = cell.select("src", F.lit(0).alias("t"), F.col("src").cast("double").alias("v"))
    # Its own cells give back its own values.
    got = pyramid.regrid_unstructured(data, source, 1, ["v"], ["t"])
    assert got.where("abs(v - cell) > 1e-9").count() == 0


def test_faces_need_vertices(spark):
    bad = spark.createDataFrame([(7, [0.0, 1.0, NAN], [0.0, 1.0, 2.0])], "face long, vlon array<double>, vlat array<double>")
    with pytest.raises(ValueError, match="face 7"):
        mesh.check_vertices(bad)


def test_bilinear_reproduces_a_plane(spark):
    f = spark.createDataFrame([(y, x, float(3 * y)) for y in range(5) for x in range(8)], "y int, x int, v double")
    points = spark.createDataFrame([(0, 10.0, -15.0), (1, 359.0, 20.0)], "dst long, lon double, lat double")
    got = apply.bilinear(f, points, -60.0, 30.0, 5, 0.0, 45.0, 8).orderBy("dst").collect()
    assert [round(r["v"], 9) for r in got] == [4.5, 8.0]


def test_faces_out_of_range_are_rejected(spark):
    rows = [(0, [0, 1, 2]), (1, [0, 1, 12, 2]), (2, [0, 1]), (3, [0, 0, 1, 2, 0]), (4, [0, 1, 2, 1]), (5, [0, -1, 2, 3]), (6, [1, None, 2, 3]), (7, [0, 0, 1])]
    df = spark.createDataFrame(rows, "face long, node_ids array<long>")
    assert {r["face"]: r["node_ids"] for r in mesh.valid_faces(df, 12).collect()} == {0: [0, 1, 2], 3: [0, 1, 2]}


def test_a_digest_heeds_repeated_points(spark):
    one = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "lon double, lat double")
    other = spark.createDataFrame([(5.0, 6.0)] * 2, "lon double, lat double")
    digests = [weights.grid_digest(x) for x in (one, one.orderBy("lon"), one.unionByName(one.limit(1)), one.limit(0).unionByName(other), other)]
    assert digests[0] == digests[1] and len({digests[0], digests[2], digests[3]}) == 3


def test_rounds_of_the_nearest_search_have_equal_plans(spark):
    # A source in one corner: many rounds until the other side has found it.
    source = spark.range(400).select(F.col("id").alias("src"), (F.col("id") % 20 / 10).alias("lon"), (F.floor(F.col("id") / 20) / 10).alias("lat"))
    target = healpix.with_centres(healpix.cells(spark, 1), 1).withColumnRenamed("cell", "dst")
    got = weights.nearest(source, target)
    assert got.count() == 48 and got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
