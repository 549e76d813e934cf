import hashlib

from pyspark.sql import functions as F

from spherelake.llm import lines


def brute(rows):
    """The texts after dedup, by a plain reading of the rules."""
    hash_ = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    chunks = {}
    for key in {(d, t) for d, t in rows if t is not None}:
        own, start, before = key[1].split("\n"), 0, 0
        made = []
        for i, line in enumerate(own):
            if (31 * hash_(line) + before) % 3 == 0 or i == len(own) - 1:
                made.append(own[start : i + 1])
                start = i + 1
            before = hash_(line)
        chunks[key] = made
    seen, out = set(), {}
    for key in sorted(chunks, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        kept = []
        for c in chunks[key]:
            body = "\n".join(c)
            if len(c) >= 2 and body in seen:
                continue
            seen.add(body)
            kept += c
        out[key] = "\n".join(kept)
    return [(d, None if t is None else out[d, t]) for d, t in rows]


def order(rows):
    return sorted(rows, key=repr)


def test_equals_brute_force(spark, prose):
    passage = prose("shared", 200, line=9)
    rows = [(i, prose(i, 60 + i) + "\n" + passage + "\n" + prose(-i, 40)) for i in range(12)]
    rows += [(20, passage), (21, passage), (22, passage + "\n"), (23, None), (24, ""), (25, "\n\n\n"), (26, "\n\n\n"), (27, "one line"), (None, passage), (30, prose(30, 100) * 2)]
    rows += [(40, passage), (40, passage), (41, "é\n" * 5000), (42, "é\n" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in lines.dedup_lines(df.repartition(5)).collect()]
    assert order(got) == order(brute(rows))
    cut = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(df).collect()}
    assert sum(n > 0 for n in cut.values()) > 10 and cut[23] == cut[24] == cut[27] == 0


def test_borders_do_not_shift(spark, prose):
    passage = prose("p", 400, line=8)
    rows = [(i, "\n".join([prose(("x", i, k), 8, line=8) for k in range(i + 1)]) + "\n" + passage) for i in range(6)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # All but the lines at the passage's border go from all but the first.
    assert all(r["n_removed"] >= 30 for r in got if r["doc_id"] > 0) and [r["n_removed"] for r in got if r["doc_id"] == 0] == [0]


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a\nb", 5, 6, 7)], "doc_id long, text string, n_lines int, _r1 int, _cuts int")
    got = lines.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "_r1", "_cuts", "n_lines", "n_removed"] and got.first()["n_lines"] == 2 and got.first()["_r1"] == 6
    assert lines.dedup_lines(df.limit(0)).count() == 0
    upper = spark.createDataFrame([(1, "a\nb", 5)], "doc_id long, text string, N_LINES int")
    assert lines.dedup_lines(upper).columns == ["doc_id", "text", "n_lines", "n_removed"]


def test_no_python_and_hot_chunks(spark, prose):
    passage = prose("hot", 100, line=5)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(passage), F.lit("\n"), F.col("id").cast("string")).alias("text"))
    got = lines.dedup_lines(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert got.where("n_removed = 0").count() == 1
