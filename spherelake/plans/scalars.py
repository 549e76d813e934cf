"""Queries over scalar helpers (F15-F29, F34, P5, W9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spherelake.functions import sizing, text
from spherelake.plans.fixtures import query, table
from spherelake.sources import plan, store


@query("F15_map_time_chunks", "SELECT range AS level, greatest(1, floor(8388608 / (12 * pow(4.0, range))))::BIGINT AS time_chunk FROM range(13)")
def f15(spark, d):
    return spark.range(13).select(F.col("id").alias("level"), sizing.map_time_chunk(F.col("id")).alias("time_chunk"))


@query("F16_digest", "SELECT event_type, sha256(string_agg(event_id::VARCHAR, '|' ORDER BY event_id)) AS digest FROM events GROUP BY 1")
def f16(spark, d):
    own = table(spark, d, "events").groupBy("event_type").agg(F.array_sort(F.collect_list("event_id")).alias("ids"))
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), "|")
    return own.select("event_type", F.sha2(F.encode(joined, "UTF-8"), 256).alias("digest"))


_KEYS = "CASE c_custkey % 4 WHEN 0 THEN '.' || c_name || ' / ' || c_mktsegment || '!.' WHEN 1 THEN c_name || '..a._' WHEN 2 THEN '._ ' || c_mktsegment ELSE ' ._!' END"


@query("F18_sanitise", f"SELECT c_custkey, coalesce(nullif(trim(regexp_replace({_KEYS}, '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'source') AS key FROM customer")
def f18(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.sanitise(F.expr(_KEYS)).alias("key"))


_NAMES = "names AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a_' || strftime(ts, '%Y%m') || '_x.grb' WHEN 1 THEN 'a_' || strftime(ts, '%Y%m%d') || '_x.grb' ELSE 'a_static.grb' END AS name FROM events)"


def names(spark, d):
    n = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyyMM")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyyMMdd"))
    return table(spark, d, "events").select("event_id", F.coalesce(F.concat(F.lit("a_"), n, F.lit("_x.grb")), F.lit("a_static.grb")).alias("name"))


@query("F19_date_token", f"WITH {_NAMES} SELECT event_id, nullif(regexp_extract(name, '_(\\d{{6}}|\\d{{8}})_', 1), '') AS token FROM names")
def f19(spark, d):
    return names(spark, d).select("event_id", text.date_token(F.col("name")).alias("token"))


@query("F20_store_names", "SELECT range AS level, 's3://bucket/a/level_' || range AS path FROM range(5)")
def f20(spark, d):
    return spark.range(5).select(F.col("id").alias("level"), text.store_names(F.lit("s3://bucket/a/"), F.col("id")).alias("path"))


@query("F21_cell_methods", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'cell: mean' WHEN 1 THEN 'time: mean cell: mean' ELSE 'cell: sum' END AS methods FROM nation")
def f21(spark, d):
    old = F.when(F.col("n_nationkey") % 3 == 1, "time: mean").when(F.col("n_nationkey") % 3 == 2, "cell: sum")
    return table(spark, d, "nation").select("n_nationkey", text.add_cell_method(old).alias("methods"))


@query("F22_parse_time", "SELECT event_id, epoch_us(date_trunc('second', ts)) AS us FROM events")
def f22(spark, d):
    shown = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, d, "events").select("event_id", F.unix_micros(text.parse_time(shown)).alias("us"))


_PERIOD = f"""WITH {_NAMES}, k AS (SELECT event_id, nullif(regexp_extract(name, '_(\\d{{6}}|\\d{{8}})_', 1), '') AS token FROM names),
p AS (SELECT event_id, token, CASE length(token) WHEN 6 THEN strptime(token || '01', '%Y%m%d') WHEN 8 THEN strptime(token, '%Y%m%d') END AS b, length(token) AS n FROM k),
q AS (SELECT event_id, token, b, CASE n WHEN 6 THEN b + INTERVAL 1 MONTH WHEN 8 THEN b + INTERVAL 1 DAY END AS e FROM p)"""


@query("F23_periods", f"{_PERIOD} SELECT event_id, epoch_us(b) AS begin_us, epoch_us(e) AS end_us FROM q")
def f23(spark, d):
    begin, end = text.period(text.date_token(F.col("name")))
    return names(spark, d).select("event_id", F.unix_micros(begin).alias("begin_us"), F.unix_micros(end).alias("end_us"))


@query("P5_keep_period", f"{_PERIOD} SELECT event_id FROM q WHERE b IS NULL OR (NOT (e <= TIMESTAMP '2024-01-05' OR b > TIMESTAMP '2024-01-20') AND e > TIMESTAMP '2024-01-09')")
def p5(spark, d):
    begin, end = text.period(text.date_token(F.col("name")))
    at = lambda day: F.to_timestamp(F.lit(day))
    return names(spark, d).where(text.keep_period(begin, end, at("2024-01-05"), at("2024-01-20"), at("2024-01-09"))).select("event_id")


@query("F24_iso", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM orders")
def f24(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.iso_utc(F.col("o_orderdate")).alias("iso"))


@query("F25_time_storage", "SELECT event_id, epoch_us(date_trunc('minute', ts)) // 1000000 AS time, 'seconds since 1970-01-01 00:00:00' AS units FROM events")
def f25(spark, d):
    own = table(spark, d, "events").select("event_id", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("time"))
    got, attrs = store.time_storage(own)
    return got.withColumn("units", F.lit(attrs["units"]))


@query("F25_decode_time", "SELECT o_orderkey, epoch_us(TIMESTAMP '2000-01-01' + INTERVAL 1 HOUR * (o_orderkey % 1000)) AS us FROM orders")
def f25_decode(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.unix_micros(store.decode_time(F.col("o_orderkey") % 1000, "hours since 2000-01-01 00:00:00")).alias("us"))


@query("F26_valid_time", "SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate + INTERVAL 1 HOUR * (6 * l_linenumber)) AS us FROM lineitem")
def f26(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.unix_micros(text.valid_time(F.col("l_shipdate"), F.col("l_linenumber") * 21600)).alias("us"))


@query("F27_time_strings", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time FROM orders")
def f27(spark, d):
    return table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time")).distinct()


@query("F28_source_dims", "SELECT * FROM (VALUES (0, NULL), (1, NULL), (2, 'y|x'), (3, 'cell'), (4, 'lat|lon'), (5, 'cell')) AS t(i, dims)")
def f28(spark, d):
    rows = [(0, None), (1, "  "), (2, '["y", "x"]'), (3, '"cell"'), (4, "lat , lon"), (5, "cell")]
    own = spark.createDataFrame(rows, "i int, value string")
    return own.select("i", F.array_join(text.dims_array(F.col("value")), "|").alias("dims"))


@query("F29_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def f29(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query("F34_attributes", "SELECT n_nationkey, 'level=2;name=' || n_name || ';order=nested' AS attrs FROM nation")
def f34(spark, d):
    # Later entries win where keys meet.
    a = F.create_map(F.lit("level"), F.lit("1"), F.lit("order"), F.lit("nested"))
    b = F.create_map(F.lit("level"), F.lit("2"), F.lit("name"), F.col("n_name"))
    both = F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)
    entries = F.transform(F.array_sort(F.map_entries(both)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return table(spark, d, "nation").select("n_nationkey", F.array_join(entries, ";").alias("attrs"))


@query("F30_flatten", "SELECT vec_id, i::INT AS i, embedding[i + 1] AS v FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)")
def f30(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))


#: Listings: a page's own links, and others spelled as listings may spell them.
_MORE = """ '<A data-href="no.grb" HREF = /a' || page_id || '.grb>x</A><a href="/b' || page_id || '?x=1&amp;y=&#50;.grb">y</a><a href="">z</a><a name=q>q</a><!-- <a href="/c.grb"> --><link href="/d.grb"><a class="href" href="/e' || page_id || '.">e</a>' """
#: The anchors' attributes, then the value of the one that is named href.
_HREFS = rf"""WITH shown AS (SELECT regexp_replace(html || {_MORE}, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS html FROM pages),
anchors AS (SELECT unnest(regexp_extract_all(html, '<[aA](\s[^>]*)>', 1)) AS attributes FROM shown),
found AS (SELECT regexp_extract(attributes, '\s[hH][rR][eE][fF]\s*=\s*("[^"]*"|[^\s>"]+)', 1) AS href FROM anchors),
bare AS (SELECT replace(replace(trim(href, '"'), '&#50;', '2'), '&amp;', '&') AS href FROM found)
SELECT DISTINCT href FROM bare WHERE href <> ''"""


def listings(spark, d):
    return table(spark, d, "pages").withColumn("html", F.concat(F.col("html"), F.expr(_MORE)))


@query("S10_hrefs", _HREFS)
def s10(spark, d):
    return plan.hrefs(listings(spark, d))


@query("O5_sorted_hrefs", f"SELECT href, row_number() OVER (ORDER BY href) - 1 AS place FROM ({_HREFS}) WHERE href LIKE '%.'")
def o5(spark, d):
    from pyspark.sql import Window

    return plan.hrefs(listings(spark, d), suffix=".").withColumn("place", (F.row_number().over(Window.orderBy("href")) - 1).cast("long"))


@query("S11_catalog_links", "SELECT 'https://x.example/' || event_type || '.zarr' AS href FROM events GROUP BY event_type")
def s11(spark, d):
    link = F.to_json(F.struct(F.array(F.struct(F.lit("item").alias("rel"), F.concat(F.lit("https://x.example/"), "event_type", F.lit(".zarr")).alias("href"), F.lit("application/zarr").alias("type")), F.struct(F.lit("self").alias("rel"), F.lit("https://x.example/").alias("href"), F.lit("text/html").alias("type"))).alias("links")))
    return plan.catalog_links(table(spark, d, "events").select(link.alias("doc")), "doc", "application/zarr")


@query("S12_item_assets", "SELECT DISTINCT 'data' AS name, 'https://x.example/' || event_type AS href FROM events")
def s12(spark, d):
    doc = F.to_json(F.struct(F.create_map(F.lit("data"), F.struct(F.concat(F.lit("https://x.example/"), "event_type").alias("href"))).alias("assets")))
    return plan.item_assets(table(spark, d, "events").select(doc.alias("doc")), "doc").distinct()


_ITEMS = f"""WITH n AS (SELECT DISTINCT event_type AS variable, 'a_' || strftime(ts, '%Y%m%d') || '_x.grb' AS href, strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS b FROM events),
k AS (SELECT variable, 'https://x.example/P1D/' || replace(upper(variable), '-', '_') || '/' || href AS url, href AS filename, b FROM n WHERE b + INTERVAL 1 DAY > TIMESTAMP '2024-01-05' AND b <= TIMESTAMP '2024-01-20')
SELECT (row_number() OVER (ORDER BY variable, url) - 1)::INT AS item_index, variable, 'P1D' AS frequency, url, filename, variable || '/' || filename AS relative_path, strftime(b, '%Y%m%d') AS date_token, strftime(b, '%Y-%m-%dT%H:%M:%SZ') AS period_start, strftime(b + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS period_end FROM k"""


@query("W9_work_items", _ITEMS)
def w9(spark, d):
    links = table(spark, d, "events").select(F.col("event_type").alias("variable"), F.concat(F.lit("a_"), F.date_format("ts", "yyyyMMdd"), F.lit("_x.grb")).alias("href"))
    at = lambda day: F.to_timestamp(F.lit(day))
    return plan.items(links, "https://x.example/", "P1D", at("2024-01-05"), at("2024-01-20"))
