import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spherelake import cli
from spherelake.sources import merge, plan, readers, store
from spherelake.streaming import incremental


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}"


def table(spark, rows):
    return spark.createDataFrame(rows, "time int, cell long, v double")


def test_merge_policies(spark):
    old, new = table(spark, [(0, 0, 1.0), (1, 0, 2.0)]), table(spark, [(1, 0, 9.0), (2, 0, 3.0)])
    out, done = merge.merge(old, new, ["time", "cell"])
    assert sorted(map(tuple, out.collect())) == [(0, 0, 1.0), (1, 0, 2.0), (2, 0, 3.0)]
    assert done == {"time_slices_written": 1, "missing_variables_added": 0, "static_writes": 0, "overlapping_times_rewritten": 0}
    out, done = merge.merge(old, new, ["time", "cell"], replace=True)
    assert sorted(map(tuple, out.collect())) == [(0, 0, 1.0), (1, 0, 9.0), (2, 0, 3.0)]
    assert done["overlapping_times_rewritten"] == 1
    assert merge.merge(None, new, ["time", "cell"])[1]["static_writes"] == 1
    static = spark.createDataFrame([(1.0,)], "s double")
    assert merge.merge(old, static, [])[0] is old
    assert merge.merge(old, static, [], overwrite_static=True)[0] is static


def test_fill_values():
    assert merge.fill_value(T.LongType()) == -(2**63) and merge.fill_value(T.StringType()) is None
    assert merge.fill_value(T.DoubleType()) != merge.fill_value(T.DoubleType())


def test_store(spark, root):
    own = spark.range(96).select(F.col("id").alias("time_idx"), (F.col("id") % 12).alias("cell"), F.col("id").cast("double").alias("v"))
    store.save_level(own, root, 0, "w", metadata={"level": 0})
    assert store.read_metadata(spark, root, 0) == {"level": 0}
    store.save_level(own.withColumn("v", F.lit(-1.0)), root, 0, "r+", region=(48, 96))
    got = store.read_level(spark, root, 0)
    assert got.count() == 96 and got.where("v = -1").count() == 48
    store.save_level(own.limit(1), root, 0, "a")
    assert store.read_level(spark, root, 0).count() == 97
    with pytest.raises(ValueError, match="unknown mode"):
        store.save_level(own, root, 0, "x")
    with pytest.raises(ValueError, match="region"):
        store.save_level(own, root, 0, "r+")
    with pytest.raises(ValueError, match="multiples"):
        store.save_level(own, root, 0, "r+", region=(1, 49))
    store.copy_store(spark, root, f"{root}/copy", [0], cells_per_file=4)
    assert store.read_level(spark, f"{root}/copy", 0).count() == 97 and store.read_metadata(spark, f"{root}/copy", 0) == {"level": 0}


def test_init_and_slices(spark, root):
    own = spark.range(3).select(F.col("id").alias("time_idx"), F.col("id").alias("cell"))
    store.init_store(own, root, 0, coordinates=own.select("cell"))
    assert store.read_level(spark, root, 0).count() == 0
    assert store.slices(100, 48) == [(0, 48), (48, 96), (96, 100)]
    with pytest.raises(ValueError, match="multiple"):
        store.slices(100, 50)


def test_merge_level(spark, root):
    path = f"{root}/level"
    old, new = table(spark, [(0, 0, 1.0), (1, 0, 2.0)]), table(spark, [(1, 0, 9.0), (2, 0, 3.0)])
    keys = ["time", "cell"]
    assert store.merge_level(old, spark, path, keys).first()["time_slices_written"] == 2
    assert store.merge_level(new, spark, path, keys).first()["time_slices_written"] == 1
    assert store.merge_level(new, spark, path, keys).first()["time_slices_written"] == 0
    assert store.merge_level(new, spark, path, keys, replace=True).first()["overlapping_times_rewritten"] == 2
    extra = new.withColumn("u", F.lit(5.0))
    assert store.merge_level(extra, spark, path, keys).first()["missing_variables_added"] == 1
    got = sorted(map(tuple, spark.read.parquet(path).select("time", "v", "u").collect()))
    assert got == [(0, 1.0, None), (1, 9.0, 5.0), (2, 3.0, 5.0)]


def test_axes(spark):
    a, b = table(spark, [(0, 0, 1.0), (1, 0, 1.0)]), table(spark, [(0, 0, 1.0), (2, 0, 1.0)])
    store.check_axis(a, a)
    with pytest.raises(ValueError, match="first at 1"):
        store.check_axis(a, b)


def test_time_storage(spark):
    whole = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "time timestamp")
    got, attrs = store.time_storage(whole)
    assert got.first()["time"] == 1577836800 and attrs["units"].startswith("seconds")
    part = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0, 500),)], "time timestamp")
    got, attrs = store.time_storage(part)
    assert got.first()["time"] == 1577836800000500000 and attrs["units"].startswith("nanoseconds")


def test_resume(spark, root):
    progress = incremental.Progress(spark, f"{root}/progress")
    seen = []

    def step(a, b):
        if a == 96 and (96, 144) not in seen:
            seen.append((96, 144))
            raise RuntimeError("lost")
        seen.append((a, b))

    with pytest.raises(RuntimeError):
        incremental.run_resumable(progress, "v", 0, 200, step)
    assert progress.next_index("v", 0) == 96 and progress.next_index("w", 0) == 0
    assert incremental.run_resumable(progress, "v", 0, 200, step) == [(96, 144), (144, 192), (192, 200)]
    assert incremental.run_resumable(progress, "v", 0, 200, step) == []


def test_cached_open_recovers(spark, root, tmp_path):
    spark.range(5).write.parquet(f"{root}/in")
    files = [f"{root}/in"]
    assert readers.cached_open(spark, files, f"{root}/cache").count() == 5
    place = tmp_path / "cache" / readers.dataset_key(files)
    for p in place.glob("part-*"):
        p.write_bytes(b"broken")
    for p in place.glob(".part-*"):
        p.unlink()
    assert readers.cached_open(spark, files * 2, f"{root}/cache").count() == 5
    assert readers.open_existing(spark, f"{root}/nothing") is None
    with pytest.raises(ValueError, match="grid"):
        readers.grid_from(spark)


def test_download(tmp_path):
    source = tmp_path / "a"
    source.write_bytes(b"x" * 10)
    to = str(tmp_path / "d" / "b")
    assert readers.download(source.as_uri(), to) and not readers.download(source.as_uri(), to)
    assert open(to, "rb").read() == b"x" * 10


def test_plans(spark, root):
    with pytest.raises(ValueError, match="unsupported"):
        plan.check_variables(["a", "z"], ["a"])
    links = spark.createDataFrame([("t", "t_202401_x.grb"), ("t", "t_202312_x.grb"), ("t", "t_static.grb")], "variable string, href string")
    known = spark.createDataFrame([("t", dt.datetime(2024, 1, 1))], "variable string, existing_max_time timestamp")
    at = lambda d: F.to_timestamp(F.lit(d))
    got = plan.items(links, "https://x", "P1M", at("2023-01-01"), at("2025-01-01"), known)
    assert [r["filename"] for r in got.orderBy("item_index").collect()] == ["t_202401_x.grb", "t_static.grb"]
    plan.save_plan(f"{root}/plan", {"frequency": "P1M"}, got)
    header, back = plan.load_plan(spark, f"{root}/plan")
    assert header == {"frequency": "P1M"} and back.count() == 2


def test_layout(tmp_path):
    (tmp_path / "a_P1D.x").touch()
    (tmp_path / "b_P1M.x").touch()
    got = dict(plan.layout(str(tmp_path), ["*_{frequency}.x"], ["P1D", "PT1H"]))
    assert [len(v) for v in got.values()] == [1, 0]


def test_command_line(spark, root):
    assert [cli.verbosity(n) for n in (0, 1, 2, 9)] == [30, 20, 10, 10]
    assert cli.cache_dir({"SPHERELAKE_CACHE": "/x"}) == "/x"
    from spherelake.operators import grid

    axis = lambda values: spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "idx int, deg double")
    points = grid.regular(axis([-67.5, -22.5, 22.5, 67.5]), axis(range(0, 360, 45)))
    points.write.parquet(f"{root}/grid")
    points.select("src", F.lit(0).alias("time_idx"), F.lit(2.0).alias("v")).write.parquet(f"{root}/field")
    assert cli.main([f"{root}/field", f"{root}/grid", f"{root}/out", "--variables", "v", "--method", "nearest", "--max-level", "1", "-v"]) == 0
    assert store.read_level(spark, f"{root}/out", 0).where("v = 2").count() == 12


def test_last_slice_is_short(spark, root):
    own = spark.range(100).select(F.col("id").alias("time_idx"), F.lit(0).cast("long").alias("cell"), F.col("id").alias("v"))
    store.init_store(own, root, 0)
    for begin, end in store.slices(100, 48):
        store.save_level(own, root, 0, "r+", region=(begin, end))
    assert store.read_level(spark, root, 0).count() == 100
    store.save_level(own.withColumn("v", F.lit(-1).cast("long")), root, 0, "r+", region=(96, 100))
    got = store.read_level(spark, root, 0)
    assert got.count() == 100 and got.where("v = -1").count() == 4
    # Times after the region, in its last block, would be lost.
    with pytest.raises(ValueError, match="end with"):
        store.save_level(own, root, 0, "r+", region=(48, 60))


def test_times_are_utc_in_any_session(spark):
    from spherelake.functions import text

    rows = [("2024-03-31T02:30:00", 1711852200), ("2024-03-31T02:30:00Z", 1711852200), ("2024-03-31 04:30:00+02:00", 1711852200), ("2024-03-31", 1711843200), (" 2024-10-27T01:30:00 ", 1729992600), ("junk", None)]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame(rows, "t string, s long")
        got = df.select(F.unix_seconds(text.parse_time(F.col("t"))).alias("got"), "s", text.iso_utc(text.parse_time(F.col("t"))).alias("iso")).collect()
        assert [r["got"] for r in got] == [r["s"] for r in got]
        assert [r["iso"] for r in got[:4]] == ["2024-03-31T02:30:00Z"] * 3 + ["2024-03-31T00:00:00Z"]
        begin, end = text.period(F.lit("202403"))
        row = spark.range(1).select(F.unix_seconds(begin).alias("b"), F.unix_seconds(end).alias("e"), text.iso_utc(F.lit("2024-03-31 02:30:00").cast("timestamp_ntz")).alias("n")).first()
        assert (row["b"], row["e"], row["n"]) == (1709251200, 1711929600, "2024-03-31T02:30:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hrefs_as_listings_spell_them(spark):
    from spherelake.sources import plan

    html = """<a class=x data-href="no.grb" href='/a.grb'>a</a><A HREF=/b.grb>b</A><a title="1 > 0" href = "/c&amp;d&#x2e;grb">c</a><a href="">e</a><a name="q">q</a>
        <!-- <a href="/gone.grb"> --><script>var s = '<a href="/js.grb">';</script><link href="/l.grb"><a href="/&lt;&#8364;&gt;.grb">z</a><area href="/area.grb"><a href="/f.txt">f</a>"""
    df = spark.createDataFrame([(1, html), (2, None)], "i int, html string")
    assert sorted(r["href"] for r in plan.hrefs(df, suffix=".grb").collect()) == sorted(["/a.grb", "/b.grb", "/c&d.grb", "/<€>.grb"])
    assert {r["href"] for r in plan.hrefs(df).collect()} >= {"/f.txt"} and plan.hrefs(df.limit(0)).count() == 0


def test_jobs_over_variables_items_and_datasets(spark, root):
    from spherelake.operators import pyramid
    from spherelake.streaming import jobs

    points = spark.range(72).select(F.col("id").alias("src"), F.floor(F.col("id") / 12).cast("int").alias("y"), (F.col("id") % 12).cast("int").alias("x"))
    source = pyramid.Source.of(points.select("y", "x", (F.col("y") * 30.0 - 75).alias("lat"), (F.col("x") * 30.0).alias("lon")))
    assert source.kind == "regular"
    data = points.select("src", F.lit(0).cast("long").alias("time_idx"), F.col("src").cast("double").alias("a"))
    tables = {"a": data, "b c": data.withColumnRenamed("a", "b c")}
    more = {"max_level": 1, "method": "nearest"}
    assert jobs.write_variables(spark, tables, source, ["time_idx"], root, **more) == {"a": "written", "b c": "written"}
    assert jobs.write_variables(spark, tables, source, ["time_idx"], root, **more) == {"a": "skipped", "b c": "skipped"}
    assert store.read_level(spark, f"{root}/b_c", 0).count() == 12 and store.read_metadata(spark, f"{root}/a", 0)["coarsened_from_level"] == 1
    assert jobs.write_variables(spark, {"a": data}, source, ["time_idx"], root, rebuild=True, **more) == {"a": "written"}
    # A regridder of the caller's own, and data that are brought to the points first.
    source.prepare = lambda df: df.withColumn("a", F.col("a") + 1)
    seen = []

    def own(*arguments, **named):
        seen.append(arguments[2])
        return pyramid.regrid(*arguments, **named)

    paths = jobs.item_pyramid(data, source, ["a"], ["time_idx"], f"{root}/staging", 7, regridder=own, **more)
    assert sorted(paths) == [0, 1] and seen == [1] and spark.read.parquet(paths[1]).agg(F.min("a")).first()[0] >= 1
    assert jobs.copy_datasets(spark, {"x / y!": paths[0]}, f"{root}/out") == {"x / y!": f"{root}/out/x_y"} and spark.read.parquet(f"{root}/out/x_y").count() == 12
    faces = [pyramid.cached_faces(spark, f"{root}/cache", source) for _ in range(2)]
    assert faces[0].count() == faces[1].count() == 72


def test_combine_prepares_every_file(spark):
    parts = [spark.createDataFrame([(t, float(i))], "time int, v double") for i, t in enumerate((1, 1, 2))]
    got = merge.combine(parts, preprocess=lambda df: df.withColumn("v", F.col("v") * 10))
    assert [tuple(r) for r in got.select("time", "v").collect()] == [(1, 0.0), (2, 20.0)]
