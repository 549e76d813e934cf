"""Gridded tables derived from the TPC-like ones by integer arithmetic, alike in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.functions.healpix import JP, JR
from spherelake.functions.sphere import npix

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query to the catalogue, with the SQL that must give the same rows (or none)."""

    def add(f: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"two queries are named {name}")
        REGISTRY[name] = Entry(f, sql)
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r9(c, name: str):
    """Nine decimals, without negative zeros."""
    return (F.round(c, 9) + F.lit(0.0)).alias(name)


NY, NX = 12, 24
NSRC = NY * NX


def lat_axis(spark: SparkSession) -> DataFrame:
    return spark.range(NY).select(F.col("id").cast("int").alias("idx"), (F.col("id") * 15.0 - 82.5).alias("deg"))


def lon_axis(spark: SparkSession) -> DataFrame:
    return spark.range(NX).select(F.col("id").cast("int").alias("idx"), (F.col("id") * 15.0).alias("deg"))


def obs(spark: SparkSession, d: str) -> DataFrame:
    """Events as point observations: t (day), lon, lat, v."""
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long").alias("t"),
        ((F.col("event_id") * 137508) % 360000 / 1000.0 - 180.0).alias("lon"),
        ((F.col("event_id") * 61803) % 180000 / 1000.0 - 90.0).alias("lat"),
        F.round(F.col("value") * 100).cast("long").alias("v"),
    )


def field(spark: SparkSession, d: str) -> DataFrame:
    """(t, src, v): daily sums in cents on the 12 x 24 grid, some missing."""
    own = obs(spark, d).groupBy("t", (F.col("event_id") % NSRC).alias("src")).agg(F.sum("v").alias("s"))
    gap = (F.col("src") * F.col("src") * 31 + F.col("src") * 17 + F.col("t") * 7) % 101 < 12
    return own.select("t", "src", F.when(~gap, F.col("s").cast("double")).alias("v"))


def weights(spark: SparkSession) -> DataFrame:
    """(dst, src, w): six sources for each target, with small integer weights."""
    own = spark.range(NSRC).select(F.floor(F.col("id") / 6).alias("dst"), F.col("id").alias("src"))
    return own.select("dst", "src", (1 + (F.col("src") * 7 + F.col("dst") * 3) % 5).cast("double").alias("w"))


CELL_LEVEL = 3


def cells(spark: SparkSession, d: str) -> DataFrame:
    """(t, cell, v, k): quantities on level-3 cells, about half missing; k is a category."""
    own = table(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 10).alias("t"), ((F.col("l_orderkey") * 31 + F.col("l_linenumber")) % npix(CELL_LEVEL)).alias("cell"))
    own = own.agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("s"), (F.max("l_partkey") % 3).alias("k"))
    gap = (F.col("cell") * F.col("cell") * 31 + F.col("cell") * 17 + F.col("t") * 7) % 101 < 50
    return own.select("t", "cell", F.when(~gap, F.col("s")).alias("v"), F.when(~gap, F.col("k").cast("double")).alias("k"))


# --- the same in SQL ----------------------------------------------------------

OBS = """obs AS (SELECT event_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS t,
    (event_id * 137508) % 360000 / 1000.0::DOUBLE - 180.0::DOUBLE AS lon, (event_id * 61803) % 180000 / 1000.0::DOUBLE - 90.0::DOUBLE AS lat,
    CAST(round(value * 100) AS BIGINT) AS v FROM events)"""
FIELD = (
    OBS
    + """, raw AS (SELECT t, event_id % 288 AS src, sum(v)::BIGINT AS s FROM obs GROUP BY ALL),
field AS (SELECT t, src, CASE WHEN (src * src * 31 + src * 17 + t * 7) % 101 >= 12 THEN s::DOUBLE END AS v FROM raw)"""
)
WEIGHTS = "weights AS (SELECT range // 6 AS dst, range AS src, (1 + (range * 7 + (range // 6) * 3) % 5)::DOUBLE AS w FROM range(288))"
CELLS = """raw AS (SELECT l_orderkey % 10 AS t, (l_orderkey * 31 + l_linenumber) % 768 AS cell, sum(CAST(l_quantity AS BIGINT))::DOUBLE AS s, max(l_partkey) % 3 AS k FROM lineitem GROUP BY ALL),
cells AS (SELECT t, cell, CASE WHEN (cell * cell * 31 + cell * 17 + t * 7) % 101 >= 50 THEN s END AS v, CASE WHEN (cell * cell * 31 + cell * 17 + t * 7) % 101 >= 50 THEN k::DOUBLE END AS k FROM raw)"""
LAT = "lat AS (SELECT range AS y, range * 15.0::DOUBLE - 82.5::DOUBLE AS lat FROM range(12))"
LON = "lon AS (SELECT range AS x, range * 15.0::DOUBLE AS lon FROM range(24))"
GRID = f"{LAT}, {LON}, grid AS (SELECT y * 24 + x AS src, y, x, lat, lon FROM lat, lon)"


def r9_sql(e: str) -> str:
    return f"round({e}, 9) + 0.0::DOUBLE"


def centres_sql(level: int, name: str = "centres") -> str:
    """CTEs that end in ``name`` (cell, lon, lat) for nested cells."""
    n = 1 << level
    bits = lambda odd: " + ".join(f"(((cell >> {2 * i + odd}) & 1) << {i})" for i in range(level)) or "0"
    return f"""{name}_a AS (SELECT range AS cell, range >> {2 * level} AS f FROM range({npix(level)})),
{name}_b AS (SELECT *, ({bits(0)}) AS x, ({bits(1)}) AS y FROM {name}_a),
{name}_c AS (SELECT *, ({list(JR)})[f + 1] * {n} - x - y - 1 AS jr FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN jr < {n} THEN jr WHEN jr > {3 * n} THEN {4 * n} - jr ELSE {n} END AS nr, CASE WHEN jr < {n} OR jr > {3 * n} THEN 0 ELSE (jr - {n}) & 1 END AS ks FROM {name}_c),
{name}_e AS (SELECT *, nr::DOUBLE * nr / {3 * n * n}.0::DOUBLE AS cap, floor((({list(JP)})[f + 1] * nr + x - y + 1 + ks) / 2.0)::BIGINT AS jp FROM {name}_d),
{name} AS (SELECT cell, ((((jp - 1) % (4 * nr)) + 4 * nr) % (4 * nr) + 1 - (ks + 1) / 2.0::DOUBLE) * (90.0::DOUBLE / nr) AS lon,
    degrees(asin(CASE WHEN jr < {n} THEN 1.0::DOUBLE - cap WHEN jr > {3 * n} THEN cap - 1.0::DOUBLE ELSE ({2 * n} - jr) * 2.0::DOUBLE / {3 * n}.0::DOUBLE END)) AS lat FROM {name}_e)"""


def vector_sql(lon: str, lat: str) -> list[str]:
    return [f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"]


def nearest_sql(level: int, name: str = "nearest") -> str:
    """CTEs that end in ``name`` (dst, src): brute force with the tie rule; GRID must stand before."""
    a, b = vector_sql("c.lon", "c.lat"), vector_sql("g.lon", "g.lat")
    dot = " + ".join(f"({p}) * ({q})" for p, q in zip(a, b))
    return f"""{centres_sql(level)}, pairs AS (SELECT c.cell AS dst, g.src, round({dot}, 12) AS dot FROM centres c CROSS JOIN grid g),
{name} AS (SELECT dst, src FROM pairs QUALIFY row_number() OVER (PARTITION BY dst ORDER BY dot DESC, src) = 1)"""
