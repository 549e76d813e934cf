"""Which source items there are, which of them are wanted, and what became of them."""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spherelake.functions.text import date_token, iso_utc, keep_period, period

ITEM_FIELDS = ("item_index", "variable", "frequency", "url", "filename", "relative_path", "date_token", "period_start", "period_end")


def hrefs(pages: DataFrame, html: str = "html", suffix: str = "", keep: list[str] | None = None) -> DataFrame:
    """(keep..., href): the distinct link targets of listings that end in a suffix.

    A target is the value of an anchor's own ``href``, quoted or not, with its character
    references decoded; empty ones aren't targets.  Comments, scripts and styles hold none.
    """
    shown = F.regexp_replace(F.col(html), r"(?is)<!--.*?(-->|$)|<(script|style)\b.*?(</\2\s*>|$)", "")
    anchors = F.regexp_extract_all(shown, F.lit(r"""(?is)<a(\s(?:[^>"']|"[^"]*"|'[^']*')*)>"""), F.lit(1))
    out = pages.select(*(keep or []), F.explode(anchors).alias("_attributes"))
    attribute = F.explode(F.regexp_extract_all("_attributes", F.lit(r"""(?s)([^\s=/>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?)"""), F.lit(1)))
    out = out.select(*(keep or []), attribute.alias("_attribute")).where(F.col("_attribute").rlike(r"(?i)^href\s*="))
    value = F.regexp_replace("_attribute", r"""(?is)^href\s*=\s*|["']""", "")
    out = out.select(*(keep or []), unescaped(value).alias("href")).where("href != ''")
    return (out.where(F.col("href").endswith(suffix)) if suffix else out).distinct()


def unescaped(text: Column) -> Column:
    """A text with the character references that URLs have decoded: by number, and amp, lt, gt, quot, apos."""

    def put(to: Column, ref: Column) -> Column:
        digits = F.regexp_extract(ref, "([0-9a-fA-F]+)", 1)
        code = F.when(F.lower(ref).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        return F.replace(to, ref, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    out = F.aggregate(F.array_distinct(F.regexp_extract_all(text, F.lit("(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)"), F.lit(1))), text, put)
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(c))
    return out


def catalog_links(documents: DataFrame, column: str, media: str | None = None) -> DataFrame:
    """(href): link targets of catalogue documents, of a media type if given."""
    links = F.from_json(column, "struct<links: array<struct<rel: string, href: string, type: string>>>")
    out = documents.select(F.explode(links.getField("links")).alias("l")).select("l.*")
    return (out.where(F.col("type") == media) if media else out).select("href").distinct()


def item_assets(documents: DataFrame, column: str) -> DataFrame:
    """(name, href): the assets of catalogue items."""
    assets = F.from_json(column, "struct<assets: map<string, struct<href: string>>>").getField("assets")
    return documents.select(F.explode(assets).alias("name", "a")).select("name", F.col("a.href").alias("href"))


def layout(root: str, patterns: list[str], frequencies: list[str]) -> Iterator[tuple[str, list[str]]]:
    """(frequency, sorted files) for each frequency's files by patterns with a {frequency} field."""
    for frequency in frequencies:
        yield frequency, sorted(f for p in patterns for f in glob.glob(os.path.join(root, p.format(frequency=frequency))))


def check_variables(wanted: list[str], supported: list[str]) -> None:
    unknown = sorted(set(wanted) - set(supported))
    if unknown:
        raise ValueError(f"unsupported variables {unknown}; there are {sorted(supported)}")


def unsupported(wanted: DataFrame, supported: DataFrame) -> DataFrame:
    """The wanted values that aren't supported (both one column)."""
    return wanted.distinct().exceptAll(supported.distinct())


def items(links: DataFrame, root: str, frequency: str, start: Column, stop: Column, known: DataFrame | None = None) -> DataFrame:
    """Work items of (variable, href): those whose period is wanted and not known already, numbered by variable and URL.

    ``known`` has (variable, existing_max_time): what a variable has up to that time is skipped.
    """
    begin, end = period(F.col("token"))
    own = links.distinct().withColumn("token", date_token(F.col("href"))).withColumns({"begin": begin, "end": end})
    if known is None:
        own = own.withColumn("existing_max_time", F.lit(None).cast("timestamp"))
    else:
        own = own.join(known, "variable", "left")
    own = own.where(keep_period(F.col("begin"), F.col("end"), start, stop, F.col("existing_max_time")))
    directory = F.concat(F.lit(f"{root.rstrip('/')}/{frequency}/"), F.regexp_replace(F.upper("variable"), "-", "_"))
    filename = F.element_at(F.split("href", "/"), -1)
    url = F.concat_ws("/", directory, "href")
    place = F.row_number().over(Window.orderBy("variable", "url")) - 1
    made = own.select("variable", F.lit(frequency).alias("frequency"), url.alias("url"), filename.alias("filename"), F.concat_ws("/", "variable", filename).alias("relative_path"), F.col("token").alias("date_token"), iso_utc(F.col("begin")).alias("period_start"), iso_utc(F.col("end")).alias("period_end"))
    return made.withColumn("item_index", place).select(*ITEM_FIELDS)


def outputs_by_level(outputs: DataFrame) -> DataFrame:
    """(level, paths): each level's outputs, sorted."""
    return outputs.groupBy("level").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def result_order(results: DataFrame) -> DataFrame:
    """Work results by begin (those without one first), variable and index."""
    return results.orderBy(F.coalesce("time_start", F.lit("")), "variable", "item_index")


def save_plan(path: str, header: dict, plan: DataFrame) -> None:
    """A plan's header as JSON and its items beside it, through Spark's own file access."""
    spark = plan.sparkSession
    plan.write.mode("overwrite").json(f"{path}/items")
    spark.createDataFrame([(json.dumps(header),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")


def load_plan(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    header = json.loads(spark.read.text(f"{path}/header").first()["value"])
    if not isinstance(header, dict):
        raise ValueError("a plan's header must be a JSON object")
    return header, spark.read.json(f"{path}/items")
