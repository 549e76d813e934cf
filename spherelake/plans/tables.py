"""Queries that go through stores and incremental work (K*, R9, R10, T*)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from spherelake.operators import pyramid
from spherelake.plans.fixtures import CELLS, FIELD, OBS, cells, field, lat_axis, lon_axis, obs, query, r9, r9_sql, table
from spherelake.sources import store
from spherelake.streaming import incremental


def scratch(spark) -> str:
    """A folder for a query's stores: in the warehouse on a cluster, else a temporary one."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local":
        return f"file://{tempfile.mkdtemp(prefix='store-')}"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{uuid.uuid4().hex}"


@query("K1_store_round_trip", f"WITH {CELLS} SELECT t AS time_idx, cell, v FROM cells")
def k1(spark, d):
    own = cells(spark, d).select(F.col("t").alias("time_idx"), "cell", "v")
    root = scratch(spark)
    store.save_pyramid({3: own}, root, "w", metadata={3: {"healpix_level": 3}})
    return store.read_level(spark, root, 3).select("time_idx", "cell", "v")


@query("K4_region_write", "SELECT range % 144 AS time_idx, range % 48 AS cell, CASE WHEN range % 144 >= 48 AND range % 144 < 96 THEN -1 ELSE range END AS v FROM range(144)")
def k4(spark, d):
    root = scratch(spark)
    own = spark.range(144).select((F.col("id") % 144).alias("time_idx"), (F.col("id") % 48).alias("cell"), F.col("id").alias("v"))
    store.save_level(own, root, 1, "w")
    store.save_level(own.withColumn("v", F.lit(-1).cast("long")), root, 1, "r+", region=(48, 96))
    return store.read_level(spark, root, 1).select("time_idx", "cell", "v")


@query("K6_slices", "SELECT range AS slice, range * 96 AS start, least(range * 96 + 96, 1000) AS stop FROM range(11)")
def k6(spark, d):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(store.slices(1000, 96))], "slice long, start long, stop long")


@query("K6_every_slice", "SELECT t.range AS time_idx, c.range AS cell, t.range * 48 + c.range AS v FROM range(100) t, range(48) c")
def k6_written(spark, d):
    # Slice jobs of a store whose times aren't whole blocks; each is written twice.
    root = scratch(spark)
    own = spark.range(4800).select(F.floor(F.col("id") / 48).alias("time_idx"), (F.col("id") % 48).alias("cell"), F.col("id").alias("v"))
    store.init_store(own, root, 1)
    for begin, end in 2 * store.slices(100, 48):
        store.save_level(own, root, 1, "r+", region=(begin, end))
    return store.read_level(spark, root, 1).select("time_idx", "cell", "v")


@query("K22_time_coordinate", "SELECT DISTINCT epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) // 1000000 AS time FROM orders")
def k22(spark, d):
    own = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").cast("timestamp").alias("time")).distinct()
    return store.time_storage(own)[0]


@query("K9_resumable", f"WITH {OBS} SELECT t, event_id % 48 AS cell, sum(v)::BIGINT AS v FROM obs GROUP BY 1, 2")
def k9(spark, d):
    # A run that breaks off after a block, and one that goes on from there.
    root = scratch(spark)
    own = obs(spark, d).groupBy("t", (F.col("event_id") % 48).alias("cell")).agg(F.sum("v").alias("v")).withColumnRenamed("t", "time_idx")
    progress = incremental.Progress(spark, f"{root}/progress")
    store.init_store(own, root, 1)
    n = own.agg(F.max("time_idx")).first()[0] + 1

    class Broken(Exception):
        pass

    def step(begin: int, end: int, last: int) -> None:
        if begin >= last:
            raise Broken
        part = own.where((F.col("time_idx") >= begin) & (F.col("time_idx") < end))
        part = part.withColumn("time_block", F.lit(begin).cast("long"))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("time_block").parquet(f"{root}/blocks")

    try:
        incremental.run_resumable(progress, "v", 1, n, lambda a, b: step(a, b, 10), block=10)
    except Broken:
        pass
    incremental.run_resumable(progress, "v", 1, n, lambda a, b: step(a, b, n), block=10)
    return spark.read.parquet(f"{root}/blocks").select(F.col("time_idx").alias("t"), "cell", "v")


@query("T6_time_blocks", f"WITH {OBS} SELECT event_id // 48 AS block, count(*) AS n, sum(v)::BIGINT AS v FROM obs GROUP BY 1")
def t6(spark, d):
    return obs(spark, d).groupBy(incremental.time_block(F.col("event_id")).alias("block")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


@query("T1_append_stream", "SELECT event_id, ts, value FROM events")
def t1(spark, d):
    # The same stream twice into one table: what is there isn't appended again.
    root = scratch(spark)
    own = table(spark, d, "events").select("event_id", "ts", "value")
    own.repartition(2).write.parquet(f"{root}/in")
    for run in range(2):
        stream = spark.readStream.schema(own.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        query_ = incremental.append_stream(stream, f"{root}/out", f"{root}/checkpoint{run}", "event_id").trigger(availableNow=True).start()
        query_.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("R10_prepared_weights", f"WITH {FIELD}, a AS (SELECT t, count(v) AS n FROM field GROUP BY t) SELECT t, 48::BIGINT AS n_cells FROM a")
def r10(spark, d):
    # One set of weights for two variables of two tables.
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    prepared = pyramid.compute_weights(spark, source, 1, "nearest")
    first = pyramid.apply_prepared(field(spark, d), prepared, ["v"], ["t"])
    second = pyramid.apply_prepared(field(spark, d).withColumn("u", F.col("v") * 2), prepared, ["u"], ["t"])
    return first.join(second.select("t", "cell", "u"), ["t", "cell"]).groupBy("t").agg(F.count(F.lit(1)).alias("n_cells"))


@query("R2_cached_weights", "SELECT true AS same_path, 48::BIGINT AS n")
def r2(spark, d):
    root = scratch(spark)
    source = pyramid.Source("regular", lat_axis(spark), lon_axis(spark))
    a = pyramid.cached_weights(spark, root, source, 1, "nearest")
    b = pyramid.cached_weights(spark, root, source, 1, "nearest")
    return b.table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(a.path == b.path).alias("same_path"), "n")


@query("T0_binned_stream", f"WITH {OBS} SELECT count(*) AS n, {r9_sql('sum(v)::DOUBLE / 100')} AS total FROM obs")
def binned(spark, d):
    # An extension: observations of a stream by cell and day; here their number and sum.
    root = scratch(spark)
    own = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    points = obs(spark, d).select("event_id", "lon", "lat")
    own.join(points, "event_id").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
    name = f"binned_{uuid.uuid4().hex[:8]}"
    made = incremental.binned_stream(stream, 2)
    run = made.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.table(name).agg(F.sum("n").alias("n"), r9(F.sum(F.col("n") * F.col("value")), "total"))
