"""Queries over joins and set operations (J*, U*, O*, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.functions.sphere import valid
from spherelake.operators import apply, grid, mesh, pyramid, weights as weights_
from spherelake.plans.fixtures import FIELD, GRID, WEIGHTS, centres_sql, field, lat_axis, lon_axis, nearest_sql, obs, OBS, query, r9, r9_sql, table, vector_sql, weights
from spherelake.plans.geometry import _RING
from spherelake.sources import merge


@query("J1_weights_join", f"WITH {FIELD}, {WEIGHTS} SELECT t, dst, count(*) AS n, sum(w * v) AS total FROM field JOIN weights USING (src) WHERE v IS NOT NULL GROUP BY t, dst")
def j1(spark, d):
    met = field(spark, d).where("v IS NOT NULL").join(weights(spark), "src")
    return met.groupBy("t", "dst").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("v")).alias("total"))


def _nearest(level: int):
    sql = f"WITH {GRID}, {nearest_sql(level)} SELECT dst, src FROM nearest"

    @query(f"J3_nearest_l{level}", sql)
    def run(spark, d):
        target = healpix.with_centres(healpix.cells(spark, level), level).withColumnRenamed("cell", "dst")
        return weights_.nearest(grid.regular(lat_axis(spark), lon_axis(spark)), target).select("dst", "src")

    return run


for _level in (1, 2, 3):
    _nearest(_level)

_A, _B = "cos(radians(e.lat)) * cos(radians(e.lon))", "cos(radians(g.lat)) * cos(radians(g.lon))"


@query("J3_nearest_points", f"WITH {GRID}, {OBS}, e AS (SELECT * FROM obs), pairs AS (SELECT event_id, src, round({_A} * {_B} + cos(radians(e.lat)) * sin(radians(e.lon)) * (cos(radians(g.lat)) * sin(radians(g.lon))) + sin(radians(e.lat)) * sin(radians(g.lat)), 12) AS dot FROM e CROSS JOIN grid g) SELECT event_id, src FROM pairs QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY dot DESC, src) = 1")
def j3_points(spark, d):
    # Scattered points as targets.
    target = obs(spark, d).select(F.col("event_id").alias("dst"), "lon", "lat")
    got = weights_.nearest(grid.regular(lat_axis(spark), lon_axis(spark)), target)
    return got.select(F.col("dst").alias("event_id"), "src")


@query("J2_overlap_rows", "SELECT range AS dst, 1.0::DOUBLE AS row_sum FROM range(192)")
def j2(spark, d):
    got = weights_.conservative(mesh.regular_faces(lat_axis(spark), lon_axis(spark)), mesh.healpix_faces(spark, 2))
    return got.groupBy("dst").agg(r9(F.sum("w"), "row_sum"))


@query("J2_overlap_columns", "SELECT range AS src, true AS conserved FROM range(288)")
def j2_columns(spark, d):
    # What a source cell gives to all targets is its own area.
    faces, target = mesh.regular_faces(lat_axis(spark), lon_axis(spark)), mesh.healpix_faces(spark, 2)
    got = weights_.conservative(faces, target).join(weights_.face_areas(target).withColumnRenamed("face", "dst"), "dst")
    given = got.groupBy("src").agg(F.sum(F.col("w") * F.col("area")).alias("given"))
    own = weights_.face_areas(faces).withColumnRenamed("face", "src")
    return given.join(own, "src").select("src", (F.abs(F.col("given") - F.col("area")) < 1e-12).alias("conserved"))


@query("J4_attach_centres", f"WITH {centres_sql(1)}, {OBS}, c AS (SELECT event_id % 48 AS cell, sum(v)::BIGINT AS v FROM obs GROUP BY 1) SELECT cell, v, {r9_sql('lon')} AS lon, {r9_sql('lat')} AS lat FROM c JOIN centres USING (cell)")
def j4(spark, d):
    own = obs(spark, d).groupBy((F.col("event_id") % 48).alias("cell")).agg(F.sum("v").alias("v"))
    got = apply.attach_centres(own, 1)
    return got.select("cell", "v", r9(F.col("lon"), "lon"), r9(F.col("lat"), "lat"))


@query("J5_mesh_product", f"WITH {GRID} SELECT src, y, x, lat, lon FROM grid")
def j5(spark, d):
    got = grid.regular(lat_axis(spark), lon_axis(spark))
    return got.select("src", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "lat", "lon")


_AXES = "a AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS time FROM orders WHERE o_orderkey % 5 = 0), b AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS time, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS v FROM orders WHERE o_orderkey % 7 = 0 GROUP BY 1)"


def axes(spark, d):
    o = table(spark, d, "orders").withColumn("time", F.date_format("o_orderdate", "yyyy-MM-dd"))
    a = o.where("o_orderkey % 5 = 0").select("time").distinct()
    b = o.where("o_orderkey % 7 = 0").groupBy("time").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("v"))
    return a, b


@query("J8_reindex", f"WITH {_AXES} SELECT time, n, v FROM a LEFT JOIN b USING (time)")
def j8(spark, d):
    a, b = axes(spark, d)
    return merge.reindex(a, b)


@query("J9_overlapping_times", f"WITH {_AXES} SELECT * FROM b SEMI JOIN a USING (time)")
def j9(spark, d):
    a, b = axes(spark, d)
    return merge.overlapping(a, b)


@query("J10_unseen_times", f"WITH {_AXES} SELECT * FROM b ANTI JOIN a USING (time)")
def j10(spark, d):
    a, b = axes(spark, d)
    return merge.unseen(a, b)


@query("J11_merge_by_coords", f"WITH {_AXES}, c AS (SELECT time, n * 2 AS n, n AS extra FROM b WHERE n > 1) SELECT time, coalesce(c.n, a2.n) AS n, extra, v FROM c FULL JOIN (SELECT time, n, v FROM b WHERE v % 2 = 0) a2 USING (time)")
def j11(spark, d):
    _, b = axes(spark, d)
    c = b.where("n > 1").select("time", (F.col("n") * 2).alias("n"), F.col("n").alias("extra"))
    return merge.combine_by_coords(c, b.where("v % 2 = 0"), ["time"])


@query("J12_bilinear", f"""WITH {centres_sql(1)}, f AS (SELECT range // 24 AS y, range % 24 AS x, (range * range) % 97::DOUBLE AS v FROM range(288)),
p AS (SELECT cell, greatest(0, least(11, (lat + 82.5) / 15)) AS fy, ((lon / 15) % 24 + 24) % 24 AS fx FROM centres),
q AS (SELECT cell, least(floor(fy), 10)::INT AS y0, floor(fx)::INT AS x0, fy - least(floor(fy), 10) AS ty, fx - floor(fx) AS tx FROM p),
o AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(a, b)),
c AS (SELECT cell, y0 + a AS y, (x0 + b) % 24 AS x, CASE a WHEN 1 THEN ty ELSE 1 - ty END * CASE b WHEN 1 THEN tx ELSE 1 - tx END AS w FROM q, o)
SELECT cell, {r9_sql('sum(w * v)')} AS v FROM c JOIN f USING (y, x) GROUP BY cell""")
def j12(spark, d):
    f = spark.range(288).select(F.floor(F.col("id") / 24).cast("int").alias("y"), (F.col("id") % 24).cast("int").alias("x"), ((F.col("id") * F.col("id")) % 97).cast("double").alias("v"))
    points = healpix.with_centres(healpix.cells(spark, 1), 1).withColumnRenamed("cell", "dst")
    return apply.bilinear(f, points, -82.5, 15.0, 12, 0.0, 15.0, 24).select(F.col("dst").alias("cell"), r9(F.col("v"), "v"))


@query("U1_union_of_files", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, o_orderdate, NULL FROM orders WHERE o_orderkey % 3 = 1")
def u1(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderdate", "o_totalprice").unionByName(o.where("o_orderkey % 3 = 1").select("o_orderkey", "o_orderdate"), allowMissingColumns=True)


@query("U2_unsupported", "SELECT DISTINCT event_type AS variable FROM events EXCEPT SELECT * FROM (VALUES ('click'), ('view'))")
def u2(spark, d):
    from spherelake.sources.plan import unsupported

    wanted = table(spark, d, "events").select(F.col("event_type").alias("variable"))
    return unsupported(wanted, spark.createDataFrame([("click",), ("view",)], "variable string"))


@query("U3_missing_variables", "SELECT column0 AS variable FROM (VALUES ('extra'), ('flag')) AS t(column0)")
def u3(spark, d):
    o = table(spark, d, "orders").limit(1)
    candidate = o.withColumns({"extra": F.lit(1), "flag": F.lit(True)})
    return spark.createDataFrame([(c,) for c in merge.missing_variables(o, candidate, ["o_orderkey"])], "variable string")


@query("U4_new_times", f"WITH {_AXES} SELECT time FROM b EXCEPT SELECT time FROM a")
def u4(spark, d):
    a, b = axes(spark, d)
    return merge.unseen(a, b).select("time").distinct()


@query("U5_common_times", f"WITH {_AXES} SELECT time FROM a INTERSECT SELECT time FROM b")
def u5(spark, d):
    return merge.common_times(*axes(spark, d))


@query("U6_distinct_files", "SELECT DISTINCT source AS path FROM documents")
def u6(spark, d):
    return table(spark, d, "documents").select(F.col("source").alias("path")).distinct()


@query("U7_same_axis", "SELECT true AS same, false AS other")
def u7(spark, d):
    a, b = axes(spark, d)
    return spark.createDataFrame([(merge.same_axis(a, a), merge.same_axis(a, b))], "same boolean, other boolean")


@query("U8_append_padded", f"WITH {_AXES}, e AS (SELECT time, n, v, 7 AS q FROM b WHERE n > 1) SELECT * FROM e UNION ALL SELECT time, n, v, -2147483648 FROM b ANTI JOIN e USING (time)")
def u8(spark, d):
    _, b = axes(spark, d)
    return merge.append(b.where("n > 1").withColumn("q", F.lit(7)), b, fill=True)


@query("K12_append_twice", f"WITH {_AXES} SELECT * FROM b")
def k12(spark, d):
    # Appending what is there already changes nothing.
    _, b = axes(spark, d)
    once = merge.append(b.where("n > 1"), b)
    return merge.append(once, b)


@query("K13_new_variable_full_axis", f"WITH {_AXES} SELECT time, n, extra FROM b LEFT JOIN (SELECT time, v AS extra FROM b WHERE n > 1) USING (time)")
def k13(spark, d):
    _, b = axes(spark, d)
    return merge.add_variables(b.select("time", "n"), b.where("n > 1").select("time", F.col("v").alias("extra")), ["time"])


@query("K14_merge_summary", f"WITH {_AXES} SELECT (SELECT count(*) FROM b WHERE n = 1)::INT AS time_slices_written, 1 AS missing_variables_added, 0 AS static_writes, 0 AS overlapping_times_rewritten")
def k14(spark, d):
    _, b = axes(spark, d)
    _, done = merge.merge(b.where("n > 1").select("time", "n"), b, ["time"])
    return spark.createDataFrame([tuple(done.values())], ", ".join(f"{k} int" for k in done))


@query("K15_rewrite_overlap", f"WITH {_AXES} SELECT time, CASE WHEN n = 1 THEN 100 ELSE n END AS n FROM b")
def k15(spark, d):
    _, b = axes(spark, d)
    return merge.rewrite(b.select("time", "n"), b.where("n = 1").select("time", F.lit(100).cast("long").alias("n")), ["time"])


@query("K7_axis_difference", f"WITH {_AXES}, x AS (SELECT row_number() OVER (ORDER BY time) - 1 AS i, time FROM a), y AS (SELECT row_number() OVER (ORDER BY time) - 1 AS i, time FROM b) SELECT min(i) FILTER (x.time IS DISTINCT FROM y.time) AS first_difference, count(x.time) AS n_a, count(y.time) AS n_b FROM x FULL JOIN y USING (i)")
def k7(spark, d):
    return merge.first_difference(*axes(spark, d)).select(F.col("first_difference").cast("long").alias("first_difference"), "n_a", "n_b")


@query("S8_combine_files", "WITH p AS (SELECT 0 AS f, strftime(o_orderdate, '%Y-%m-%d') AS time, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT 1, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 1) SELECT time, o_orderkey, o_totalprice FROM p QUALIFY f = min(f) OVER (PARTITION BY time)")
def s8(spark, d):
    o = table(spark, d, "orders").withColumn("time", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return merge.combine([o.where("o_orderkey % 11 = 0").select("time", "o_orderkey", "o_totalprice"), o.where("o_orderkey % 4 = 1").select("time", "o_orderkey")])


@query("P1_pass_through", f"WITH {FIELD}, s AS (SELECT t, 10 * t AS static FROM field GROUP BY t) SELECT t, static FROM s")
def p1(spark, d):
    # A variable without the source dimension stays as it is, beside one that is regridded.
    static = field(spark, d).select("t").distinct().select("t", (F.col("t") * 10).alias("static"))
    prepared = pyramid.Prepared(weights(spark), pyramid.WeightsMeta("nearest", 1, source_size=288))
    got = pyramid.apply_dataset({"v": field(spark, d), "static": static}, prepared, ["t"])
    return got["static"].join(got["v"].select("t").distinct(), "t", "left_semi")


@query("P2_valid", f"WITH {FIELD} SELECT t, count(v) AS n_valid, count(*) - count(v) AS n_missing FROM field GROUP BY t")
def p2(spark, d):
    odd = F.get(F.array(F.lit(None).cast("double"), F.lit(float("nan")), F.lit(float("inf")), F.lit(float("-inf"))), (F.col("src") % 4).cast("int"))
    own = field(spark, d).withColumn("v", F.coalesce("v", odd))
    return own.groupBy("t").agg(F.count_if(valid(F.col("v"))).alias("n_valid"), F.count_if(~valid(F.col("v"))).alias("n_missing"))


@query("P3_drop_nuisance", "SELECT n_nationkey, n_name FROM nation")
def p3(spark, d):
    from spherelake.sources.readers import drop_nuisance

    own = table(spark, d, "nation").select("n_nationkey", "n_name", F.lit(2.0).alias("heightAboveGround"))
    return drop_nuisance(own)


@query("P4_rename", "SELECT n_nationkey AS cell, n_regionkey AS value FROM nation")
def p4(spark, d):
    from spherelake.sources.readers import rename_points

    return rename_points(table(spark, d, "nation").select(F.col("n_nationkey").alias("values"), F.col("n_regionkey").alias("unknown")))


@query("P6_region", "SELECT o_orderkey, o_orderkey % 400 AS time_idx FROM orders WHERE o_orderkey % 400 >= 96 AND o_orderkey % 400 < 144")
def p6(spark, d):
    own = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 400).alias("time_idx"))
    return own.where((F.col("time_idx") >= 96) & (F.col("time_idx") < 144))


@query("P8_skip_finished", "WITH k AS (SELECT event_type, min(ts) + INTERVAL 10 DAY AS known FROM events WHERE event_type <> 'view' GROUP BY 1) SELECT e.event_id, e.event_type FROM events e LEFT JOIN k USING (event_type) WHERE known IS NULL OR ts > known")
def p8(spark, d):
    from spherelake.streaming.incremental import fresh_periods

    e = table(spark, d, "events")
    known = e.where("event_type <> 'view'").groupBy("event_type").agg((F.min("ts") + F.expr("INTERVAL 10 DAYS")).alias("existing_max_time"))
    return fresh_periods(e.join(known, "event_type", "left").withColumn("period_end", F.col("ts"))).select("event_id", "event_type")


@query("O2_sorted_unique", "SELECT DISTINCT l_shipdate AS v FROM lineitem")
def o2(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_shipdate").alias("v")).distinct().orderBy("v")


@query("O3_argmax", "SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) = 1")
def o3(spark, d):
    best = F.max_by("l_linenumber", F.struct(F.col("l_quantity"), -F.col("l_linenumber")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(best.alias("l_linenumber"))


@query("O4_first_times", f"WITH {FIELD} SELECT t, src, v FROM field WHERE t < 5")
def o4(spark, d):
    return field(spark, d).where("t < 5")


@query("O6_result_order", "SELECT event_id AS item_index, event_type AS variable, CASE WHEN event_id % 3 > 0 THEN strftime(ts, '%Y-%m-%d') END AS time_start, row_number() OVER (ORDER BY coalesce(CASE WHEN event_id % 3 > 0 THEN strftime(ts, '%Y-%m-%d') END, ''), event_type, event_id) AS place FROM events")
def o6(spark, d):
    from pyspark.sql import Window

    from spherelake.sources.plan import result_order

    own = table(spark, d, "events").select(F.col("event_id").alias("item_index"), F.col("event_type").alias("variable"), F.when(F.col("event_id") % 3 > 0, F.date_format("ts", "yyyy-MM-dd")).alias("time_start"))
    return result_order(own).withColumn("place", F.row_number().over(Window.orderBy(F.coalesce("time_start", F.lit("")), "variable", "item_index")).cast("long"))


@query("R4_regrid_conservative", "SELECT range AS cell, 5.0::DOUBLE AS v FROM range(48)")
def r4(spark, d):
    # A constant field stays constant.
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    data = source.centres().select("src", F.lit(0).alias("t"), F.lit(5.0).alias("v"))
    return pyramid.regrid(data, source, 1, ["v"], ["t"]).select("cell", r9(F.col("v"), "v"))


@query("R4_regrid_conservative_field")
def r4_field(spark, d):
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    return pyramid.regrid(field(spark, d), source, 2, ["v"], ["t"]).select("t", "cell", r9(F.col("v"), "v"))


_RING_NEAREST = f"""WITH {GRID}, {FIELD}, c AS (SELECT cell, lon_raw AS lon, lat_raw AS lat FROM ({_RING})),
pairs AS (SELECT cell, src, round({' + '.join(f"({a}) * ({b})" for a, b in zip(vector_sql("c.lon", "c.lat"), vector_sql("g.lon", "g.lat")))}, 12) AS dot FROM c CROSS JOIN grid g),
near AS (SELECT cell, src FROM pairs QUALIFY row_number() OVER (PARTITION BY cell ORDER BY dot DESC, src) = 1)
SELECT t, cell, v FROM (SELECT DISTINCT t FROM field) CROSS JOIN near LEFT JOIN field USING (t, src)"""


@query("R4_regrid_ring", _RING_NEAREST)
def r4_ring(spark, d):
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    return pyramid.regrid(field(spark, d), source, 2, ["v"], ["t"], method="nearest", nest=False).select("t", "cell", "v")


_MEANS = f"WITH {FIELD}, {WEIGHTS}, m AS (SELECT t, dst, sum(w * v) / sum(w) AS v FROM field JOIN weights USING (src) WHERE v IS NOT NULL GROUP BY t, dst) SELECT t, dst AS cell, v FROM (SELECT DISTINCT t FROM field) CROSS JOIN (SELECT DISTINCT dst FROM weights) LEFT JOIN m USING (t, dst)"


@query("R3_weight_file", _MEANS)
def r3_file(spark, d):
    # Weights of another tool, counted from one, and data with the grid's own dimensions.
    from spherelake.plans.tables import scratch

    path = f"{scratch(spark)}/weights"
    weights(spark).select((F.col("dst") + 1).cast("int").alias("row"), (F.col("src") + 1).cast("int").alias("col"), F.col("w").alias("S")).write.parquet(path)
    prepared = pyramid.open_weights(spark, path, pyramid.WeightsMeta("conservative", 1, source_dims=("y", "x"), source_size=288))
    own = field(spark, d).select("t", F.floor(F.col("src") / 24).cast("int").alias("y"), (F.col("src") % 24).cast("int").alias("x"), "v")
    return pyramid.apply_prepared(own, prepared, ["v"], ["t"]).select("t", "cell", "v").where("cell < 48")


@query("F32_dims_by_size", _MEANS)
def f32(spark, d):
    # Nothing says which dimension is the source's but its size.
    prepared = pyramid.Prepared(weights(spark), pyramid.WeightsMeta("nearest", 1, source_dims=(), source_size=288))
    own = field(spark, d).select("t", F.col("src").alias("ncells"), "v")
    return pyramid.apply_prepared(own, prepared, ["v"], ["t"]).select("t", "cell", "v")


@query("G9_sources_as_they_come", "SELECT * FROM (VALUES ('cells', 'unstructured', 288, true), ('radians', 'regular', 288, true), ('rotated', 'curvilinear', 288, false)) AS t(name, kind, size, is_global)")
def g9(spark, d):
    # The rotated grid's latitudes are a hundredth of a degree apart, so by the median step it ends short of the poles.
    own = grid.regular(lat_axis(spark), lon_axis(spark))
    tables = {
        "radians": own.select(F.col("y").alias("nj"), F.col("x").alias("ni"), F.radians("lat").alias("latitude"), F.radians("lon").alias("longitude")),
        "rotated": own.select("y", "x", (F.col("lat") + F.col("x") / 100).alias("nav_lat"), F.col("lon").alias("nav_lon")),
        "cells": own.select(F.col("src").alias("ncells"), F.col("lat").alias("clat"), F.col("lon").alias("clon")),
    }
    rows = []
    for name, df in tables.items():
        about = pyramid.Source.of(df).describe()
        rows.append((name, about["kind"], int(about["size"]), about["is_global"]))
    return spark.createDataFrame(rows, "name string, kind string, size int, is_global boolean")


@query("R11_level_metadata", "SELECT range::INT AS level, 1 << range::INT AS nside, 'nested' AS order_, CASE WHEN range < 2 THEN range::INT + 1 END AS coarsened_from, 12 * (1 << (2 * range::INT)) * (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS n FROM range(3)")
def r11(spark, d):
    from spherelake.plans.tables import scratch
    from spherelake.sources import store

    root = scratch(spark)
    data = field(spark, d).withColumnRenamed("t", "time_idx")
    made = pyramid.write_pyramid(data, pyramid.Source("regular", lat_axis(spark), lon_axis(spark)), ["v"], ["time_idx"], root, max_level=2, method="nearest")
    rows = []
    for level in made:
        meta = store.read_metadata(spark, root, level)
        rows.append((level, meta["crs"]["nside"], meta["crs"]["order"], meta.get("coarsened_from_level"), store.read_level(spark, root, level).count()))
    return spark.createDataFrame(rows, "level int, nside int, order_ string, coarsened_from int, n long")


@query("R4_regrid_level7")
def r4_level7(spark, d):
    # Every day's field on 196,608 cells: the size at which cells a second mean something.  Brute force checks levels 1 to 3.
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    return pyramid.regrid(field(spark, d), source, 7, ["v"], ["t"], method="nearest").select("t", "cell", "v")
