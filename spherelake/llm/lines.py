"""Line dedup over content-defined chunks, with DataFrame operations only.

A text's lines are hashed; a rolling hash over each line and the one before it ends a
chunk wherever it is divisible by DIVISOR.  The borders depend on the lines around
them alone, so a passage is cut alike wherever it stands, whatever was put before it.
Of chunks of two lines or more that occur again anywhere, the first occurrence (by
document id, then place) stays and the others are removed.

Chunks are counted under a 128-bit key.  Texts under a repeated key are compared byte
by byte: grouping by key and text must give a single text, else nothing is removed.
Counts are gathered before every shuffle, so a chunk that is everywhere costs one row a
task; joins of occurrences with their chunk are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A chunk ends after a line whose rolling hash this divides: three lines on average.
DIVISOR = 3
#: The factor of the rolling hash (fixed value).
FACTOR = 31
#: Occurrences of one chunk are spread over so many keys when they meet what was found of it.
SALTS = 16


def line_hash(line: Column) -> Column:
    """32 bits of the line's MD5 as a long."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _key(name: str, *columns: Column) -> list[Column]:
    return [F.xxhash64(*columns).alias(f"{name}1"), F.xxhash64(F.lit(name), *columns).alias(f"{name}2")]


def chunks_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row per chunk of two lines or more: _id, _r1, _r2 (the row's key), _c1, _c2 (the chunk's), _at, _n, _chunk."""
    id_, body = F.col(f"`{doc}`"), F.col(f"`{text}`")
    rows = docs.where(body.isNotNull()).select(id_.alias("_id"), *_key("_r", id_, body), F.split(body, "\n", -1).alias("_lines"))
    rows = rows.where(F.size("_lines") > 1).withColumn("_hash", F.transform("_lines", line_hash))
    rolled = F.transform("_hash", lambda h, i: FACTOR * h + F.coalesce(F.get("_hash", i - 1), F.lit(0)))
    rows = rows.withColumn("_rolled", rolled).drop("_hash")
    last = lambda i: (i == F.size("_lines")) | (F.get("_rolled", i - 1) % DIVISOR == 0)
    rows = rows.withColumn("_ends", F.filter(F.sequence(F.lit(1), F.size("_lines")), last)).drop("_rolled")
    begin = lambda j: F.coalesce(F.get("_ends", j - 1), F.lit(0)) + 1
    spans = F.transform("_ends", lambda e, j: F.struct(begin(j).alias("at"), (e - begin(j) + 1).alias("n")))
    rows = rows.withColumn("_spans", F.filter(spans, lambda s: s["n"] >= 2)).drop("_ends")
    joined = F.transform("_spans", lambda s: F.struct(s["at"].alias("at"), s["n"].alias("n"), F.array_join(F.slice("_lines", s["at"], s["n"]), "\n").alias("chunk")))
    out = rows.select("_id", "_r1", "_r2", F.explode(joined).alias("_x"))
    out = out.select("_id", "_r1", "_r2", F.col("_x.at").alias("_at"), F.col("_x.n").alias("_n"), F.col("_x.chunk").alias("_chunk"))
    return out.select("*", *_key("_c", F.col("_chunk")))


def repeated_chunks(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The occurrences to remove: _r1, _r2, _at, _n."""
    # Equal rows are one document; they get the same result.
    own = chunks_of(docs, doc, text)
    lean = own.select("_c1", "_c2", "_id", "_r1", "_r2", "_at", "_n")
    # Partial counts by key and text make the byte comparison: a key with one text has equal bytes throughout.
    texts = own.groupBy("_c1", "_c2", "_chunk").agg(F.count(F.lit(1)).alias("n")).groupBy("_c1", "_c2").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    same = texts.where((F.col("n") > 1) & (F.col("texts") == 1)).select("_c1", "_c2")
    place = F.struct("_id", "_r1", "_r2", "_at")
    first = lean.groupBy("_c1", "_c2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").join(same, ["_c1", "_c2"])
    salted = first.select("_c1", "_c2", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    met = lean.withColumn("_salt", F.pmod(F.col("_r1") + F.col("_at"), F.lit(SALTS)).cast("int")).join(salted, ["_c1", "_c2", "_salt"])
    return met.where(~place.eqNullSafe(F.col("first"))).select("_r1", "_r2", "_at", "_n")


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", counts: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with repeated chunks cut from the text; and n_lines, n_removed.

    ``n_lines`` counts the lines there were (long, 0 for a null text), ``n_removed`` those
    cut.  A null text stays null.  A text that is cut altogether becomes empty.  Rows that
    agree in id and text count as one document, and get the same result.  Lines end at
    \\n alone; an empty text is one empty line.  An empty table gives no rows.  Columns
    of the input named n_lines or n_removed, in either case, are replaced; without
    ``counts`` the columns are those of ``docs``.
    """
    removed = repeated_chunks(docs, doc, text)
    # Equal rows give equal occurrences: each counts once.
    cuts = removed.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_set(F.struct(F.col("_at").alias("at"), F.col("_n").alias("n")))).alias("_cuts"))
    # The row travels as a struct, so its columns clash with nothing.
    columns = [c for c in docs.columns if not counts or c.lower() not in ("n_lines", "n_removed")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), *_key("_r", F.col(f"`{doc}`"), F.col(f"`{text}`")))
    body = F.col("_row").getField(text)
    rows = packed.join(cuts, ["_r1", "_r2"], "left").withColumn("_lines", F.when(body.isNotNull(), F.split(body, "\n", -1)))
    begin = lambda j: F.when(j == 0, 1).otherwise(F.get("_cuts", j - 1)["at"] + F.get("_cuts", j - 1)["n"])
    end = lambda j: F.coalesce(F.get("_cuts", j)["at"], F.size("_lines") + 1)
    gaps = F.transform(F.sequence(F.lit(0), F.size("_cuts")), lambda j: F.slice("_lines", begin(j), end(j) - begin(j)))
    kept = F.when(F.col("_cuts").isNull(), body).otherwise(F.array_join(F.flatten(gaps), "\n"))
    n_removed = F.coalesce(F.aggregate("_cuts", F.lit(0), lambda a, c: a + c["n"]), F.lit(0)).cast("long")
    n_lines = F.greatest(F.coalesce(F.size("_lines"), F.lit(0)), F.lit(0)).cast("long")
    out = [kept.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns]
    return rows.select(*out, *([n_lines.alias("n_lines"), n_removed.alias("n_removed")] if counts else []))
