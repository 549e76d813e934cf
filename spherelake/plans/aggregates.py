"""Queries over the aggregation operators (A*, E2) and the pyramid (R6, R7)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from spherelake.functions import healpix
from spherelake.operators import apply, coarsen, diagnostics, grid, pyramid
from spherelake.operators import weights as weights_
from spherelake.plans.fixtures import CELL_LEVEL, CELLS, FIELD, GRID, LAT, LON, WEIGHTS, cells, field, lat_axis, lon_axis, nearest_sql, obs, OBS, query, r9, r9_sql, table, weights

_MET = f"WITH {FIELD}, {WEIGHTS}, days AS (SELECT DISTINCT t FROM field), frame AS (SELECT t, dst, src, w FROM days, weights), met AS (SELECT f.*, v FROM frame f LEFT JOIN field USING (t, src))"
_RENORMALIZE = "SELECT t, dst, CASE WHEN sum(w) FILTER (v IS NOT NULL) > 0 THEN sum(w * v) / sum(w) FILTER (v IS NOT NULL) END AS v FROM met GROUP BY t, dst"
_PROPAGATE = "SELECT t, dst, CASE WHEN coalesce(sum(w) FILTER (v IS NULL), 0) > 0 THEN NULL ELSE sum(w * v) END AS v FROM met GROUP BY t, dst"


@query("A1_renormalize", f"{_MET} {_RENORMALIZE}")
def a1(spark, d):
    return apply.apply_weights(field(spark, d), weights(spark), ["v"], ["t"])


@query("A1_missing_block", f"{_MET.replace('LEFT JOIN field USING (t, src)', 'LEFT JOIN (SELECT * FROM field WHERE src >= 60) USING (t, src)')} {_RENORMALIZE}")
def a1_block(spark, d):
    # Targets 0 to 9 have no source that is present.
    own = field(spark, d).withColumn("v", F.when(F.col("src") >= 60, F.col("v")))
    return apply.apply_weights(own, weights(spark), ["v"], ["t"])


@query("A1_nan_inf", f"{_MET} {_RENORMALIZE}")
def a1_nan(spark, d):
    # NaN and both infinities are missing as NULL is.
    odd = F.get(F.array(F.lit(float("nan")), F.lit(float("inf")), F.lit(float("-inf"))), (F.col("src") % 3).cast("int"))
    return apply.apply_weights(field(spark, d).withColumn("v", F.coalesce("v", odd)), weights(spark), ["v"], ["t"])


@query("A2_propagate", f"{_MET} {_PROPAGATE}")
def a2(spark, d):
    return apply.apply_weights(field(spark, d), weights(spark), ["v"], ["t"], policy="propagate")


@query("A2_unmapped_zero", f"{_MET}, all_targets AS (SELECT t, range AS dst FROM days, range(50)) SELECT a.t, a.dst, CASE WHEN p.dst IS NULL THEN 0.0 ELSE p.v END AS v FROM all_targets a LEFT JOIN ({_PROPAGATE}) p ON a.t = p.t AND a.dst = p.dst")
def a2_unmapped(spark, d):
    # Targets 48 and 49 have no weights: 0 under propagate.
    return apply.apply_weights(field(spark, d), weights(spark), ["v"], ["t"], n_target=50, policy="propagate")


_TWO = f"""WITH {FIELD}, {WEIGHTS}, two AS (SELECT t // 10 AS dekad, t % 10 AS t, src, v, CASE WHEN src % 4 > 0 THEN v * 2 END AS u FROM field),
days AS (SELECT DISTINCT dekad, t FROM two), met AS (SELECT dekad, t, dst, w, v, u FROM days CROSS JOIN weights LEFT JOIN two USING (dekad, t, src))
SELECT dekad, t, dst, sum(w * v) / sum(w) FILTER (v IS NOT NULL) AS v, sum(w * u) / sum(w) FILTER (u IS NOT NULL) AS u FROM met GROUP BY dekad, t, dst"""


@query("A3_batch_dims", _TWO)
def a3(spark, d):
    # Two batch dimensions and two variables with masks of their own, in one pass.
    own = field(spark, d).select(F.floor(F.col("t") / 10).alias("dekad"), (F.col("t") % 10).alias("t"), "src", "v", F.when(F.col("src") % 4 > 0, F.col("v") * 2).alias("u"))
    return apply.apply_weights(own, weights(spark), ["v", "u"], ["dekad", "t"])


def _coarse_sql(levels: int, need: int, frame: int) -> str:
    return f"""WITH {CELLS}, got AS (SELECT t, cell >> {2 * levels} AS cell, CASE WHEN count(v) >= {need} THEN sum(v) / count(v) END AS v FROM cells GROUP BY 1, 2),
frame AS (SELECT t, range AS cell FROM (SELECT DISTINCT t FROM cells), range({frame})) SELECT t, cell, v FROM frame LEFT JOIN got USING (t, cell)"""


@query("A4_mean", _coarse_sql(1, 2, 192))
def a4(spark, d):
    return coarsen.coarsen(cells(spark, d), ["v"], ["t"], CELL_LEVEL, CELL_LEVEL - 1, "mean")


@query("A4_one_valid", _coarse_sql(1, 1, 192))
def a4_quarter(spark, d):
    return coarsen.coarsen(cells(spark, d), ["v"], ["t"], CELL_LEVEL, CELL_LEVEL - 1, "mean", fraction=0.25)


@query("A4_all_valid", _coarse_sql(1, 4, 192))
def a4_all(spark, d):
    return coarsen.coarsen(cells(spark, d), ["v"], ["t"], CELL_LEVEL, CELL_LEVEL - 1, "mean", fraction=1.0)


@query("R6_two_levels_at_once", _coarse_sql(2, 8, 48))
def r6(spark, d):
    return coarsen.coarsen(cells(spark, d), ["v"], ["t"], CELL_LEVEL, 1, method="conservative")


_MODE = f"""WITH {CELLS}, n AS (SELECT t, cell >> 2 AS p, k, count(*) AS n, min(cell) AS first FROM cells WHERE k IS NOT NULL GROUP BY 1, 2, 3),
best AS (SELECT t, p, sum(n) OVER (PARTITION BY t, p) AS whole, k, row_number() OVER (PARTITION BY t, p ORDER BY n DESC, first) AS place FROM n),
frame AS (SELECT t, range AS cell FROM (SELECT DISTINCT t FROM cells), range(192))
SELECT f.t, cell, CASE WHEN whole >= 2 THEN k END AS k FROM frame f LEFT JOIN best b ON f.t = b.t AND cell = p AND place = 1"""


@query("A5_mode_tie", _MODE)
def a5(spark, d):
    return coarsen.coarsen(cells(spark, d).select("t", "cell", "k"), ["k"], ["t"], CELL_LEVEL, CELL_LEVEL - 1, "mode")


@query("A6_auto_nearest_is_mode", _MODE)
def a6(spark, d):
    return coarsen.coarsen(cells(spark, d).select("t", "cell", "k"), ["k"], ["t"], CELL_LEVEL, CELL_LEVEL - 1, "auto", method="nearest")


_BLOCKS = {"mean": "sum(v) / 4", "sum": "sum(v)", "min": "min(v)", "max": "max(v)"}
_SKIP = {"nanmean": "sum(v) / count(v)", "nansum": "coalesce(sum(v), 0)", "nanmin": "min(v)", "nanmax": "max(v)"}


@query("A7_block_aggregates", f"WITH {CELLS} SELECT t, cell >> 2 AS cell, " + ", ".join(f"CASE WHEN count(v) = 4 THEN {e} END AS v_{n}" for n, e in _BLOCKS.items()) + " FROM cells GROUP BY 1, 2")
def a7(spark, d):
    made = [coarsen.aggregator(n, F.col("v"), F.col("cell")).alias(f"v_{n}") for n in _BLOCKS]
    return cells(spark, d).groupBy("t", healpix.parent(F.col("cell")).alias("p")).agg(*made).withColumnRenamed("p", "cell")


@query("A8_skipping_aggregates", f"WITH {CELLS} SELECT t, cell >> 2 AS cell, " + ", ".join(f"{e} AS v_{n}" for n, e in _SKIP.items()) + " FROM cells GROUP BY 1, 2")
def a8(spark, d):
    made = [coarsen.aggregator(n, F.col("v"), F.col("cell")).alias(f"v_{n}") for n in _SKIP]
    return cells(spark, d).groupBy("t", healpix.parent(F.col("cell")).alias("p")).agg(*made).withColumnRenamed("p", "cell")


@query("A8_infinity_rules", f"WITH {CELLS}, i AS (SELECT t, cell, CASE WHEN cell % 7 = 0 THEN 'inf'::DOUBLE ELSE v END AS v FROM cells) SELECT t, cell >> 2 AS cell, sum(v) FILTER (NOT isinf(v)) / count(v) FILTER (NOT isinf(v)) AS v_nanmean, max(v) AS v_nanmax FROM i GROUP BY 1, 2")
def a8_inf(spark, d):
    own = cells(spark, d).withColumn("v", F.when(F.col("cell") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("v")))
    made = [coarsen.aggregator(n, F.col("v"), F.col("cell")).alias(f"v_{n}") for n in ("nanmean", "nanmax")]
    return own.groupBy("t", healpix.parent(F.col("cell")).alias("p")).agg(*made).withColumnRenamed("p", "cell")


@query("A9_first_child", f"WITH {CELLS} SELECT t, cell >> 2 AS cell, v FROM cells QUALIFY row_number() OVER (PARTITION BY t, cell >> 2 ORDER BY cell) = 1")
def a9(spark, d):
    return coarsen.degrade(cells(spark, d).select("t", "cell", "v"), "v", ["t"], CELL_LEVEL, CELL_LEVEL - 1, "first")


@query("A10_iterated_nanmax", f"WITH {CELLS} SELECT t, cell >> 4 AS cell, max(v) AS v FROM cells GROUP BY 1, 2")
def a10(spark, d):
    return coarsen.degrade(cells(spark, d).select("t", "cell", "v"), "v", ["t"], CELL_LEVEL, 1, "nanmax")


@query("A10_iterated_nanmean", f"WITH {CELLS}, a AS (SELECT t, cell >> 2 AS cell, sum(v) / count(v) AS v FROM cells GROUP BY 1, 2) SELECT t, cell >> 2 AS cell, {r9_sql('avg(v)')} AS v FROM a GROUP BY 1, 2")
def a10_mean(spark, d):
    got = coarsen.degrade(cells(spark, d).select("t", "cell", "v"), "v", ["t"], CELL_LEVEL, 1, "nanmean")
    return got.select("t", "cell", r9(F.col("v"), "v"))


@query("A11_one_shot", f"WITH {CELLS} SELECT t, cell >> 2 AS cell, CASE WHEN count(v) = 4 THEN sum(v) / 4 END AS v FROM cells GROUP BY 1, 2")
def a11(spark, d):
    return coarsen.degrade_mean(cells(spark, d).select("t", "cell", "v"), "v", ["t"], 1)


@query("E2_own_aggregate", f"WITH {CELLS} SELECT t, cell >> 2 AS cell, max(v) - min(v) AS v FROM cells GROUP BY 1, 2")
def e2(spark, d):
    return coarsen.degrade(cells(spark, d).select("t", "cell", "v"), "v", ["t"], CELL_LEVEL, CELL_LEVEL - 1, lambda v, cell: F.max(v) - F.min(v))


_NEAREST = f"WITH {GRID}, {nearest_sql(2)}, {FIELD}, days AS (SELECT DISTINCT t FROM field)"
_PYRAMID = f"""{_NEAREST}, l2 AS (SELECT t, dst AS cell, v FROM days CROSS JOIN nearest LEFT JOIN field USING (t, src)),
l1 AS (SELECT t, cell >> 2 AS cell, CASE WHEN count(v) >= 2 THEN sum(v) / count(v) END AS v FROM l2 GROUP BY 1, 2),
l0 AS (SELECT t, cell >> 2 AS cell, CASE WHEN count(v) >= 2 THEN sum(v) / count(v) END AS v FROM l1 GROUP BY 1, 2)
SELECT 2 AS level, t, cell, {r9_sql('v')} AS v FROM l2 UNION ALL SELECT 1, t, cell, {r9_sql('v')} FROM l1 UNION ALL SELECT 0, t, cell, {r9_sql('v')} FROM l0"""


@query("R7_pyramid", _PYRAMID)
def r7(spark, d):
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    levels = pyramid.pyramid(field(spark, d), source, ["v"], ["t"], max_level=2, method="nearest", how="mean")
    return pyramid.stacked(levels).select("level", "t", "cell", r9(F.col("v"), "v"))


@query("A12_keep_first_time", "SELECT user_id, ts, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1")
def a12(spark, d):
    from spherelake.sources.merge import keep_first

    own = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return keep_first(own, ["user_id", "day"], ["ts", "event_id"]).select("user_id", "ts", "event_id", "value")


@query("A16_median_step", "WITH d AS (SELECT DISTINCT o_totalprice AS v FROM orders), s AS (SELECT v - lag(v) OVER (ORDER BY v) AS d FROM d) SELECT round(median(d), 9) AS step FROM s WHERE d > 0")
def a16(spark, d):
    return grid.median_step(table(spark, d, "orders"), "o_totalprice").select(F.round("step", 9).alias("step"))


_LON_COVERAGE = "d AS (SELECT DISTINCT ((({lon}) % 360) + 360) % 360 AS v FROM {t}), g AS (SELECT coalesce(lead(v) OVER (ORDER BY v), first(v) OVER (ORDER BY v) + 360) - v AS gap, v - lag(v) OVER (ORDER BY v) AS step FROM d), lonc AS (SELECT greatest(0, least(360, 360 - max(gap) + coalesce(median(step) FILTER (step > 0), 0))) AS c FROM g)"
_LAT_COVERAGE = "e AS (SELECT DISTINCT {lat} AS v FROM {t}), h AS (SELECT v, v - lag(v) OVER (ORDER BY v) AS step FROM e), latc AS (SELECT greatest(0, least(180, max(v) - min(v) + coalesce(median(step) FILTER (step > 0), 0))) AS c FROM h)"


@query("A17_lon_coverage", f"WITH {OBS}, part AS (SELECT * FROM obs WHERE lon BETWEEN -100 AND 60), {_LON_COVERAGE.format(lon='lon', t='part')} SELECT {r9_sql('c')} AS coverage FROM lonc")
def a17(spark, d):
    return grid.lon_coverage(obs(spark, d).where("lon BETWEEN -100 AND 60")).select(r9(F.col("coverage"), "coverage"))


@query("A18_lat_coverage", f"WITH {OBS}, part AS (SELECT * FROM obs WHERE lat > -45), {_LAT_COVERAGE.format(lat='lat', t='part')} SELECT {r9_sql('c')} AS coverage FROM latc")
def a18(spark, d):
    return grid.lat_coverage(obs(spark, d).where("lat > -45")).select(r9(F.col("coverage"), "coverage"))


@query("A19_is_global", f"WITH {GRID}, {_LON_COVERAGE.format(lon='lon', t='grid')}, {_LAT_COVERAGE.format(lat='lat', t='grid')} SELECT {r9_sql('lonc.c')} AS lon_coverage, {r9_sql('latc.c')} AS lat_coverage, lonc.c >= 350 AND latc.c >= 170 AS is_global FROM lonc, latc")
def a19(spark, d):
    got = grid.coverage(grid.regular(lat_axis(spark), lon_axis(spark)))
    return got.select(r9(F.col("lon_coverage"), "lon_coverage"), r9(F.col("lat_coverage"), "lat_coverage"), "is_global")


@query("A20_resolution_regular", f"WITH {LAT}, {LON}, s AS (SELECT abs(lat - lag(lat) OVER (ORDER BY y)) AS step FROM lat UNION ALL SELECT abs(lon - lag(lon) OVER (ORDER BY x)) FROM lon) SELECT min(step) AS resolution FROM s")
def a20(spark, d):
    return grid.resolution_regular(lat_axis(spark), lon_axis(spark))


@query("A20_resolution_unstructured", f"SELECT {r9_sql('degrees(sqrt(4 * pi() / count(*)))')} AS resolution FROM events")
def a20_unstructured(spark, d):
    return grid.resolution_unstructured(table(spark, d, "events")).select(r9(F.col("resolution"), "resolution"))


_CURVED = f"WITH {GRID}, curved AS (SELECT src, y, x, least(90, greatest(-90, lat + 2 * sin(radians(lon)))) AS lat, lon + 2 * cos(radians(lat)) AS lon FROM grid)"


def curved(spark):
    own = grid.regular(lat_axis(spark), lon_axis(spark))
    lat = F.least(F.lit(90.0), F.greatest(F.lit(-90.0), F.col("lat") + 2 * F.sin(F.radians("lon"))))
    return own.select("src", "y", "x", lat.alias("lat"), (F.col("lon") + 2 * F.cos(F.radians("lat"))).alias("lon"))


@query("A20_resolution_curvilinear", f"{_CURVED}, s AS (SELECT abs(lat - lag(lat) OVER (PARTITION BY x ORDER BY y)) AS a, abs(lon - lag(lon) OVER (PARTITION BY y ORDER BY x)) AS b FROM curved) SELECT {r9_sql('least(avg(a), avg(b))')} AS resolution FROM s")
def a20_curved(spark, d):
    return grid.resolution_curvilinear(curved(spark)).select(r9(F.col("resolution"), "resolution"))


_MEAN_LON = "degrees(atan2(avg(vy), avg(vx)))"
_MEAN_LAT = "degrees(asin(avg(vz) / sqrt(avg(vx) * avg(vx) + avg(vy) * avg(vy) + avg(vz) * avg(vz))))"
_CURVED_VECTORS = "v AS (SELECT y, x, cos(radians(lat)) * cos(radians(lon)) AS vx, cos(radians(lat)) * sin(radians(lon)) AS vy, sin(radians(lat)) AS vz FROM curved)"


@query("A15_corners", f"{_CURVED}, {_CURVED_VECTORS}, o AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(a, b)) SELECT y + a AS cy, x + b AS cx, {r9_sql(_MEAN_LON)} AS lon, {r9_sql(_MEAN_LAT)} AS lat FROM v, o GROUP BY 1, 2")
def a15(spark, d):
    return grid.corners(curved(spark)).select(F.col("cy").cast("long").alias("cy"), F.col("cx").cast("long").alias("cx"), r9(F.col("lon"), "lon"), r9(F.col("lat"), "lat"))


@query("A21_conservation", f"WITH {CELLS}, a AS (SELECT sum(v) * {4 * math.pi / 768!r} AS fine FROM cells WHERE t = 0), p AS (SELECT cell >> 2 AS cell, sum(coalesce(v, 0)) / 4 AS m FROM cells WHERE t = 0 GROUP BY 1), b AS (SELECT sum(m) * {4 * math.pi / 192!r} AS coarse FROM p) SELECT {r9_sql('fine')} AS source_integral, {r9_sql('coarse')} AS target_integral, abs(coarse - fine) / fine < 1e-12 AS conserved FROM a, b")
def a21(spark, d):
    own = cells(spark, d).where("t = 0").select("cell", F.coalesce("v", F.lit(0.0)).alias("v"))
    fine = own.withColumn("area", F.lit(4 * math.pi / 768))
    coarse = own.groupBy(healpix.parent(F.col("cell")).alias("cell")).agg((F.sum("v") / 4).alias("v")).withColumn("area", F.lit(4 * math.pi / 192))
    got = diagnostics.conservation(fine, coarse, "v", "area")
    return got.select(r9(F.col("source_integral"), "source_integral"), r9(F.col("target_integral"), "target_integral"), (F.abs("relative_difference") < 1e-12).alias("conserved"))


@query("A22_statistics", f"WITH {FIELD} SELECT t, min(v) AS v_min, max(v) AS v_max, sum(v) / count(v) AS v_mean, count(v) AS n FROM field GROUP BY t")
def a22(spark, d):
    return diagnostics.statistics(field(spark, d), "v", ["t"])


@query("A23_raster", f"WITH {OBS}, b AS (SELECT least(17, greatest(0, floor((lat + 90) / 10)))::INT AS iy, least(35, greatest(0, floor((lon + 180) / 10)))::INT AS ix, v FROM obs) SELECT iy, ix, sum(v)::DOUBLE / count(*) AS v, count(*) AS n FROM b GROUP BY 1, 2")
def a23(spark, d):
    return diagnostics.raster(obs(spark, d), "v", 36, 18)


@query("A24_percentiles", "SELECT event_type, round(quantile_cont(value, 0.01), 9) AS low, round(quantile_cont(value, 0.99), 9) AS high FROM events GROUP BY event_type")
def a24(spark, d):
    got = diagnostics.percentile_range(table(spark, d, "events"), "value", ["event_type"])
    return got.select("event_type", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


@query("A25_latest", "SELECT max(ts) AS latest, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS variables FROM events")
def a25(spark, d):
    from spherelake.sources.merge import latest

    return latest(table(spark, d, "events"), "ts", "event_type").select("latest", F.array_join("variables", ",").alias("variables"))


@query("A26_outputs_by_level", "SELECT event_type AS level, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS paths FROM events GROUP BY 1")
def a26(spark, d):
    from spherelake.sources.plan import outputs_by_level

    own = table(spark, d, "events").select(F.col("event_type").alias("level"), F.format_string("%08d", "event_id").alias("path"))
    got = outputs_by_level(own)
    return got.select("level", F.array_join(F.transform("paths", lambda p: p.cast("long").cast("string")), ",").alias("paths"))


@query("A28_row_sums", "SELECT range AS dst, 1.0::DOUBLE AS row_sum FROM range(48)")
def a28(spark, d):
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    got = pyramid.compute_weights(spark, source, 1, "conservative").table
    return got.groupBy("dst").agg(r9(F.sum("w"), "row_sum"))


@query("R12_unmapped", "SELECT range AS cell FROM range(48) WHERE range >= 40")
def r12(spark, d):
    return weights_.unmapped(spark.range(40).select(F.col("id").alias("dst")), spark, 1)

