"""Queries over sphere functions, HEALPix geometry and meshes (F1-F14, F30-F31, G*, P9-P10, W1-W5, W8, A13-A14, A27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spherelake.functions import healpix, sphere
from spherelake.operators import diagnostics, grid, mesh, weights
from spherelake.plans.fixtures import GRID, LAT, OBS, centres_sql, lat_axis, lon_axis, obs, query, r9, r9_sql, table, vector_sql


@query("F1_canonical_lon", "SELECT event_id, ((((event_id * 137) % 1440 - 720) / 2.0::DOUBLE + 180) % 360 + 360) % 360 - 180 AS lon FROM events")
def f1(spark, d):
    raw = ((F.col("event_id") * 137) % 1440 - 720) / 2.0
    return table(spark, d, "events").select("event_id", sphere.canonical_lon(raw).alias("lon"))


@query("F2_radians_heuristic", "SELECT 'degrees' AS axis, max(abs(lon)) <= 2 * pi() + 1e-6 AS in_radians FROM (WITH " + OBS + " SELECT lon FROM obs) UNION ALL SELECT 'radians', max(abs(radians(lon))) <= 2 * pi() + 1e-6 FROM (WITH " + OBS + " SELECT lon FROM obs)")
def f2(spark, d):
    own = obs(spark, d).withColumn("rad", F.radians("lon"))
    rows = [("degrees", sphere.in_radians(own, "lon")), ("radians", sphere.in_radians(own, "rad"))]
    return spark.createDataFrame(rows, "axis string, in_radians boolean")


@query("F3_units", f"WITH {OBS} SELECT event_id, {r9_sql('degrees(radians(lat))')} AS lat FROM obs")
def f3(spark, d):
    own = obs(spark, d).select("event_id", F.radians("lat").alias("lat"))
    return sphere.to_degrees(own, ["lat"], "auto").select("event_id", r9(F.col("lat"), "lat"))


@query("F4_xyz", f"WITH {OBS} SELECT event_id, " + ", ".join(f"{r9_sql(e)} AS {n}" for e, n in zip(vector_sql("lon", "lat"), "xyz")) + " FROM obs")
def f4(spark, d):
    return obs(spark, d).select("event_id", *[r9(c, n) for c, n in zip(sphere.xyz(F.col("lon"), F.col("lat")), "xyz")])


_V = vector_sql("lon", "lat")


@query("F5_lonlat", f"WITH {OBS}, v AS (SELECT event_id, 3 * {_V[0]} AS x, 3 * {_V[1]} AS y, 3 * {_V[2]} AS z, abs(lat) >= 89 AS polar FROM obs) SELECT event_id, CASE WHEN polar THEN NULL ELSE {r9_sql('degrees(atan2(y, x))')} END AS lon, {r9_sql('degrees(asin(z / sqrt(x * x + y * y + z * z)))')} AS lat FROM v")
def f5(spark, d):
    # So near a pole the ninth decimal of a longitude says nothing.
    own = obs(spark, d)
    v = own.select("event_id", (F.abs("lat") >= 89).alias("polar"), *[(3 * c).alias(n) for c, n in zip(sphere.xyz(F.col("lon"), F.col("lat")), "xyz")])
    lon, lat = sphere.lonlat(F.col("x"), F.col("y"), F.col("z"))
    return v.select("event_id", F.when(~F.col("polar"), r9(lon, "lon")).alias("lon"), r9(lat, "lat"))


_MEAN = "avg(vx) AS x, avg(vy) AS y, avg(vz) AS z"


@query("F6_centroid", f"WITH {OBS}, v AS (SELECT event_id // 4 AS g, {_V[0]} AS vx, {_V[1]} AS vy, {_V[2]} AS vz FROM obs), m AS (SELECT g, {_MEAN} FROM v GROUP BY g) SELECT g, CASE WHEN sqrt(x * x + y * y) > 0.05 THEN round(degrees(atan2(y, x)), 6) END AS lon, round(degrees(asin(z / sqrt(x * x + y * y + z * z))), 6) AS lat FROM m")
def f6(spark, d):
    own = obs(spark, d).groupBy(F.floor(F.col("event_id") / 4).alias("g")).agg(F.array_sort(F.collect_list(F.struct("event_id", "lon", "lat"))).alias("p"))
    lons, lats = F.transform("p", lambda p: p["lon"]), F.transform("p", lambda p: p["lat"])
    lon, lat = sphere.centroid(lons, lats)
    x = F.aggregate(F.transform("p", lambda p: F.cos(F.radians(p["lat"])) * F.cos(F.radians(p["lon"]))), F.lit(0.0), lambda a, v: a + v) / F.size("p")
    y = F.aggregate(F.transform("p", lambda p: F.cos(F.radians(p["lat"])) * F.sin(F.radians(p["lon"]))), F.lit(0.0), lambda a, v: a + v) / F.size("p")
    return own.select("g", F.when(F.sqrt(x * x + y * y) > 0.05, F.round(lon, 6)).alias("lon"), F.round(lat, 6).alias("lat"))


@query("F7_ccw", "SELECT event_id AS face, event_id % 2 = 1 AS turned FROM events")
def f7(spark, d):
    # Squares round a centre; every other one runs clockwise.
    own = table(spark, d, "events").select(F.col("event_id").alias("face"), ((F.col("event_id") * 7) % 360 - 180.0).alias("lon"), ((F.col("event_id") * 11) % 160 - 80.0).alias("lat"))
    corner = lambda c, s: F.array(*[F.col(c) + v for v in s])
    own = own.withColumns({"vlon": corner("lon", (-1, 1, 1, -1)), "vlat": corner("lat", (-1, -1, 1, 1))})
    odd = F.col("face") % 2 == 1
    own = own.withColumns({"vlon": F.when(odd, F.reverse("vlon")).otherwise(F.col("vlon")), "vlat": F.when(odd, F.reverse("vlat")).otherwise(F.col("vlat"))})
    fixed = mesh.ensure_ccw(own.select("face", "vlon", "vlat", "lon", "lat")).select("face", F.col("vlat").alias("after"))
    return own.join(fixed, "face").select("face", (F.col("after") != F.col("vlat")).alias("turned"))


@query("F8_level_of_resolution", "SELECT p_partkey, greatest(0, floor(log2(58.6::DOUBLE / (p_size / 8.0::DOUBLE))))::INT AS level FROM part")
def f8(spark, d):
    return table(spark, d, "part").select("p_partkey", sphere.level_of(F.col("p_size") / 8.0).alias("level"))


@query("F9_sizes", "SELECT range AS level, 1 << range AS nside, 12 * (1 << (2 * range)) AS npix FROM range(14)")
def f9(spark, d):
    power = lambda e: F.expr(f"shiftleft(cast(1 AS bigint), cast({e} AS int))")
    return spark.range(14).select(F.col("id").alias("level"), power("id").alias("nside"), (12 * power("2 * id")).alias("npix"))


@query("F10_centres_nested", f"WITH {centres_sql(4)} SELECT cell, {r9_sql('lon')} AS lon, {r9_sql('lat')} AS lat FROM centres")
def f10(spark, d):
    got = healpix.with_centres(healpix.cells(spark, 4), 4)
    return got.select("cell", r9(F.col("lon"), "lon"), r9(F.col("lat"), "lat"))


_RING = """WITH p AS (SELECT range AS cell, CASE WHEN range < 24 THEN 0 WHEN range >= 168 THEN 2 ELSE 1 END AS zone FROM range(192)),
q AS (SELECT cell, zone, CASE zone WHEN 0 THEN floor((1 + floor(sqrt(1 + 2 * cell))) / 2)::BIGINT WHEN 2 THEN floor((1 + floor(sqrt(2 * (192 - cell) - 1))) / 2)::BIGINT ELSE (cell - 24) // 16 + 4 END AS r FROM p)
SELECT cell, CASE zone WHEN 0 THEN (cell + 1 - 2 * r * (r - 1) - 0.5) * (90.0 / r) WHEN 2 THEN (4 * r + 1 - (192 - cell - 2 * r * (r - 1)) - 0.5) * (90.0 / r)
    ELSE ((cell - 24) % 16 + 1 - CASE WHEN (r + 4) % 2 = 1 THEN 1.0 ELSE 0.5 END) * 22.5 END::DOUBLE AS lon_raw,
    degrees(asin(CASE zone WHEN 0 THEN 1 - r * r / 48.0::DOUBLE WHEN 2 THEN r * r / 48.0::DOUBLE - 1 ELSE (8 - r) * 2 / 12.0::DOUBLE END)) AS lat_raw FROM q"""


@query("F10_centres_ring", f"SELECT cell, {r9_sql('lon_raw')} AS lon, {r9_sql('lat_raw')} AS lat FROM ({_RING})")
def f10_ring(spark, d):
    got = healpix.with_centres(healpix.cells(spark, 2), 2, nest=False)
    return got.select("cell", r9(F.col("lon"), "lon"), r9(F.col("lat"), "lat"))


@query("F10_round_trip", "SELECT range AS cell, range AS back FROM range(3072)")
def f10_back(spark, d):
    got = healpix.with_centres(healpix.cells(spark, 4), 4)
    return healpix.with_cell(got, 4, cell="back").select("cell", "back")


@query("F11_vertices_tile_the_sphere", "SELECT 768::BIGINT AS n, round(4 * pi(), 9) AS area, 768::BIGINT AS n_positive")
def f11(spark, d):
    got = weights.face_areas(mesh.healpix_faces(spark, 3))
    return got.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("area"), 9).alias("area"), F.count_if(F.col("area") > 0).alias("n_positive"))


@query("F12_parents", "SELECT l_orderkey, l_linenumber, l_partkey >> 2 AS p1, l_partkey >> 6 AS p3 FROM lineitem")
def f12(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", healpix.parent(F.col("l_partkey")).alias("p1"), healpix.parent(F.col("l_partkey"), 3).alias("p3"))


@query("F13_radians_variant", f"WITH {OBS} SELECT max(abs(radians(lat))) <= pi() + 0.01 AS in_radians FROM obs")
def f13(spark, d):
    own = obs(spark, d).select(F.radians("lat").alias("lat"))
    return spark.createDataFrame([(sphere.in_radians(own, "lat", limit=sphere.RADIAN_LIMIT_PI),)], "in_radians boolean")


@query("F14_dateline_shift", "SELECT event_id, ((((event_id * 91) % 720 - 360 - ((event_id * 13) % 360 - 180) + 180)::DOUBLE % 360) + 360) % 360 - 180 + ((event_id * 13) % 360 - 180) AS lon FROM events")
def f14(spark, d):
    lon, centre = ((F.col("event_id") * 91) % 720 - 360).cast("double"), ((F.col("event_id") * 13) % 360 - 180).cast("double")
    return table(spark, d, "events").select("event_id", sphere.shift_lon(lon, centre).alias("lon"))


@query("W1_differences", f"WITH {LAT} SELECT y AS idx, lat - lag(lat) OVER (ORDER BY y) AS step FROM lat")
def w1(spark, d):
    return grid.differences(lat_axis(spark)).select(F.col("idx").cast("long").alias("idx"), "step")


@query("W2_bounds", f"WITH {LAT}, n AS (SELECT y, lat, lag(lat) OVER (ORDER BY y) AS a, lead(lat) OVER (ORDER BY y) AS b FROM lat) SELECT y AS idx, greatest(-90, least(90, lat - coalesce((lat - a) / 2, (b - lat) / 2))) AS lower, greatest(-90, least(90, lat + coalesce((b - lat) / 2, (lat - a) / 2))) AS upper FROM n")
def w2(spark, d):
    return grid.bounds(lat_axis(spark), clamp=90.0).select(F.col("idx").cast("long").alias("idx"), "lower", "upper")


@query("W3_wrapped_gap", "WITH d AS (SELECT DISTINCT (l_partkey * 37) % 360 AS v FROM lineitem) SELECT v, coalesce(lead(v) OVER (ORDER BY v), first(v) OVER (ORDER BY v) + 360) - v AS gap FROM d")
def w3(spark, d):
    from pyspark.sql import Window

    own = table(spark, d, "lineitem").select(((F.col("l_partkey") * 37) % 360).alias("v")).distinct()
    w = Window.orderBy("v")
    return own.select("v", (F.coalesce(F.lead("v").over(w), F.first("v").over(w) + 360) - F.col("v")).alias("gap"))


@query("W4_running_offsets", "SELECT o_custkey, o_orderkey, coalesce(sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM (SELECT o_custkey, o_orderkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)")
def w4(spark, d):
    from pyspark.sql import Window

    n = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    return n.select("o_custkey", "o_orderkey", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))


def quads(spark, d):
    """Faces of a lattice whose corners are shared."""
    own = table(spark, d, "part").select(F.col("p_partkey").alias("face"), (F.floor(F.col("p_partkey") / 100) % 150).alias("y"), (F.col("p_partkey") % 100).alias("x"))
    y, x = F.col("y") * 1.0 - 75, F.col("x") * 3.0 - 150
    return own.select("face", F.array(x, x + 3, x + 3, x).alias("vlon"), F.array(y, y, y + 1, y + 1).alias("vlat"))


_QUADS = """quads AS (SELECT p_partkey AS face, ((p_partkey // 100) % 150) * 1.0::DOUBLE - 75 AS y, (p_partkey % 100) * 3.0::DOUBLE - 150 AS x FROM part),
corner AS (SELECT face, 0 AS k, x AS lon, y AS lat FROM quads UNION ALL SELECT face, 1, x + 3, y FROM quads UNION ALL SELECT face, 2, x + 3, y + 1 FROM quads UNION ALL SELECT face, 3, x, y + 1 FROM quads),
nodes AS (SELECT row_number() OVER (ORDER BY lon, lat) - 1 AS node_id, lon, lat FROM (SELECT DISTINCT lon, lat FROM corner))"""


@query("A13_unique_nodes", f"WITH {_QUADS} SELECT node_id, lon, lat FROM nodes")
def a13(spark, d):
    return mesh.nodes_and_faces(quads(spark, d))[0]


@query("W5_inverse_ids", f"WITH {_QUADS} SELECT face, string_agg(node_id::VARCHAR, ',' ORDER BY k) AS node_ids FROM corner JOIN nodes USING (lon, lat) GROUP BY face")
def w5(spark, d):
    return mesh.nodes_and_faces(quads(spark, d))[1].select("face", F.array_join(F.transform("node_ids", lambda n: n.cast("string")), ",").alias("node_ids"))


_FACE_MEAN = "avg(cos(radians(lat)) * cos(radians(lon))) AS x, avg(cos(radians(lat)) * sin(radians(lon))) AS y, avg(sin(radians(lat))) AS z"


@query("A14_face_centres", f"WITH {_QUADS}, m AS (SELECT face, {_FACE_MEAN} FROM corner GROUP BY face) SELECT face, {r9_sql('degrees(atan2(y, x))')} AS lon, {r9_sql('degrees(asin(z / sqrt(x * x + y * y + z * z)))')} AS lat FROM m")
def a14(spark, d):
    return mesh.nodes_and_faces(quads(spark, d))[1].select("face", r9(F.col("lon"), "lon"), r9(F.col("lat"), "lat"))


_RAW_FACES = "raw AS (SELECT o_orderkey AS face, list(l_suppkey % 13 ORDER BY l_linenumber, l_suppkey % 13) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)"
_KEPT = f"""WITH {_RAW_FACES}, a AS (SELECT face, n FROM raw WHERE len(n) >= 3 AND NOT list_contains(n, 12)),
b AS (SELECT face, list_filter(n, lambda v, i: i = 1 OR v != n[i - 1]) AS n FROM a),
c AS (SELECT face, CASE WHEN len(n) > 1 AND n[1] = n[len(n)] THEN n[1:len(n) - 1] ELSE n END AS n FROM b),
kept AS (SELECT face, n FROM c WHERE len(n) >= 3 AND len(list_distinct(n)) = len(n))"""


def raw_faces(spark, d):
    met = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    packed = met.groupBy(F.col("o_orderkey").alias("face")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", (F.col("l_suppkey") % 13).alias("n")))).alias("s"))
    return packed.select("face", F.transform("s", lambda s: s["n"]).alias("node_ids"))


@query("P9_valid_faces", f"{_KEPT} SELECT face, array_to_string(n, ',') AS node_ids FROM kept")
def p9(spark, d):
    got = mesh.valid_faces(raw_faces(spark, d), 12)
    return got.select("face", F.array_join(F.transform("node_ids", lambda n: n.cast("string")), ",").alias("node_ids"))


@query("A27_bad_faces", f"{_KEPT} SELECT (SELECT count(*) FROM raw) AS n_faces, (SELECT count(*) FROM kept) AS n_kept, (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS n_bad")
def a27(spark, d):
    raw = raw_faces(spark, d)
    return diagnostics.bad_faces(raw, mesh.valid_faces(raw, 12))


@query("G7_triangle_fan", f"{_KEPT} SELECT face, k::INT AS k, n[1] AS a, n[k + 1] AS b, n[k + 2] AS c FROM (SELECT face, n, unnest(range(1, len(n) - 1)) AS k FROM kept)")
def g7(spark, d):
    return mesh.triangle_fan(mesh.valid_faces(raw_faces(spark, d), 12))


@query("J7_triangle_parents", f"{_KEPT}, fan AS (SELECT face, unnest(range(1, len(n) - 1)) AS k FROM kept) SELECT face, k::INT AS k, o_totalprice AS v FROM fan JOIN orders ON face = o_orderkey")
def j7(spark, d):
    fan = mesh.triangle_fan(mesh.valid_faces(raw_faces(spark, d), 12)).select("face", "k")
    return fan.join(table(spark, d, "orders").select(F.col("o_orderkey").alias("face"), F.col("o_totalprice").alias("v")), "face")


@query("J6_node_gather", f"WITH {_QUADS}, f AS (SELECT face, k, node_id FROM corner JOIN nodes USING (lon, lat)) SELECT f.face, f.k, n.lon, n.lat FROM f JOIN nodes n USING (node_id)")
def j6(spark, d):
    nodes, faces = mesh.nodes_and_faces(quads(spark, d))
    return faces.select("face", F.posexplode("node_ids").alias("k", "node_id")).join(nodes, "node_id").select("face", "k", "lon", "lat")


@query("W8_vertex_order", f"WITH {_QUADS}, s AS (SELECT face, k, lon, lat, avg(lon) OVER (PARTITION BY face) AS clon, avg(lat) OVER (PARTITION BY face) AS clat FROM corner), a AS (SELECT *, atan2(cos(radians(clat)) * sin(radians(lat)) - sin(radians(clat)) * cos(radians(lat)) * cos(radians(lon - clon)), cos(radians(lat)) * sin(radians(lon - clon))) AS angle FROM s) SELECT face, string_agg(lon::INT || ' ' || lat::INT, ',' ORDER BY angle) AS vertices FROM a GROUP BY face")
def w8(spark, d):
    own = quads(spark, d)
    # Vertices in another order, to be put right.
    mixed = own.select("face", F.array(*[F.get("vlon", F.lit(i)) for i in (2, 0, 3, 1)]).alias("vlon"), F.array(*[F.get("vlat", F.lit(i)) for i in (2, 0, 3, 1)]).alias("vlat"), (F.get("vlon", F.lit(0)) + 1.5).alias("lon"), (F.get("vlat", F.lit(0)) + 0.5).alias("lat"))
    got = mesh.ordered_vertices(mixed)
    return got.select("face", F.array_join(F.transform(F.arrays_zip("vlon", "vlat"), lambda v: F.concat_ws(" ", v["vlon"].cast("int"), v["vlat"].cast("int"))), ",").alias("vertices"))


@query("G1_regular_mesh", f"""WITH {GRID} SELECT src AS face, y, x, (y * 24 + x) || ',' || (y * 24 + (x + 1) % 24) || ',' || ((y + 1) * 24 + (x + 1) % 24) || ',' || ((y + 1) * 24 + x) AS node_ids,
    lon - 7.5 AS west, lon + 7.5 AS east, greatest(-90, lat - 7.5) AS south, least(90, lat + 7.5) AS north FROM grid""")
def g1(spark, d):
    got = mesh.regular_faces(lat_axis(spark), lon_axis(spark))
    nodes = F.array_join(F.transform("node_ids", lambda n: n.cast("string")), ",")
    pick = lambda c, i, n: F.get(c, F.lit(i)).alias(n)
    return got.select("face", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), nodes.alias("node_ids"), pick("vlon", 0, "west"), pick("vlon", 1, "east"), pick("vlat", 0, "south"), pick("vlat", 2, "north"))


@query("G1_node_count", "SELECT 312::BIGINT AS n_nodes, 288::BIGINT AS n_faces")
def g1_nodes(spark, d):
    got = mesh.regular_faces(lat_axis(spark), lon_axis(spark))
    return got.agg(F.lit(0).alias("z"), F.count(F.lit(1)).alias("n_faces")).crossJoin(got.select(F.explode("node_ids").alias("n")).agg(F.countDistinct("n").alias("n_nodes"))).select("n_nodes", "n_faces")


#: Sines of degrees bend the grid; a corner is the mean direction of the centres around it.
_G2 = f"""WITH {GRID}, curved AS (SELECT src, y, x, least(90, greatest(-90, lat + 2 * sin(radians(lon)))) AS lat, lon + 2 * cos(radians(lat)) AS lon FROM grid), v AS (SELECT y, x, cos(radians(lat)) * cos(radians(lon)) AS vx, cos(radians(lat)) * sin(radians(lon)) AS vy, sin(radians(lat)) AS vz FROM curved),
corner AS (SELECT y + a AS cy, x + b AS cx, avg(vx) AS vx, avg(vy) AS vy, avg(vz) AS vz FROM v, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS o(a, b) GROUP BY 1, 2)
SELECT c.src AS face, 4 AS n, {r9_sql('degrees(atan2(p.vy, p.vx))')} AS lon0, {r9_sql('degrees(asin(q.vz / sqrt(q.vx * q.vx + q.vy * q.vy + q.vz * q.vz)))')} AS lat2
FROM curved c JOIN corner p ON p.cy = c.y AND p.cx = c.x JOIN corner q ON q.cy = c.y + 1 AND q.cx = c.x + 1"""


@query("G2_curvilinear_mesh", _G2)
def g2(spark, d):
    from spherelake.plans.aggregates import curved

    got = mesh.curvilinear_faces(curved(spark))
    return got.select("face", F.size("vlon").alias("n"), r9(F.get("vlon", F.lit(0)), "lon0"), r9(F.get("vlat", F.lit(2)), "lat2"))


@query("G3_corner_mesh", f"WITH {_QUADS} SELECT count(DISTINCT node_id) AS n_nodes, count(DISTINCT face) AS n_faces, count(*) AS n_corners FROM corner JOIN nodes USING (lon, lat)")
def g3(spark, d):
    nodes, faces = mesh.nodes_and_faces(quads(spark, d))
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).crossJoin(faces.agg(F.count(F.lit(1)).alias("n_faces"), F.sum(F.size("node_ids")).alias("n_corners")))


@query("G5_healpix_mesh", "SELECT 194::BIGINT AS n_nodes, 192::BIGINT AS n_faces")
def g5(spark, d):
    # A level's cells share their corners: npix + 2 of them.
    nodes, faces = mesh.nodes_and_faces(mesh.healpix_faces(spark, 2))
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).crossJoin(faces.agg(F.count(F.lit(1)).alias("n_faces")))


@query("P10_finite_vertices", "SELECT p_partkey AS face FROM part WHERE p_partkey % 3 = 0")
def p10(spark, d):
    from spherelake.functions.sphere import valid

    own = quads(spark, d)
    broken = own.withColumn("vlat", F.when(F.col("face") % 3 == 0, F.transform("vlat", lambda v, i: F.when(i < 2, F.lit(float("nan"))).otherwise(v))).otherwise(F.col("vlat")))
    finite = F.filter(F.arrays_zip("vlon", "vlat"), lambda v: valid(v["vlon"]) & valid(v["vlat"]))
    return broken.where(F.size(finite) < 3).select("face")


@query("F31_ragged_and_padded", f"WITH {_RAW_FACES} SELECT face, array_to_string(list_concat(n, list_transform(range((SELECT max(len(n)) FROM raw) - len(n)), lambda i: -1)), ',') AS padded FROM raw")
def f31(spark, d):
    own = raw_faces(spark, d)
    own = own.crossJoin(F.broadcast(own.agg(F.max(F.size("node_ids")).alias("width"))))
    padded = F.concat("node_ids", F.array_repeat(F.lit(-1).cast("long"), F.col("width") - F.size("node_ids")))
    back = F.filter(padded, lambda v: v >= 0)
    return own.where(back == F.col("node_ids")).select("face", F.array_join(F.transform(padded, lambda v: v.cast("string")), ",").alias("padded"))

