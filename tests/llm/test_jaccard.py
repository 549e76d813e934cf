import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spherelake.llm import graph, jaccard


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((rows[i][0], least[find(i)], links[i]) for i in range(len(rows)))


def families(prose, n, copies, edits, seed=0):
    rng = random.Random(seed)
    out = []
    for f in range(n):
        base = prose(("family", f), 120).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("small", [128, 4])
def test_equals_brute_force(spark, prose, monkeypatch, small):
    # Small limits, so that nodes split and groups are cut into tiles.
    if small == 4:
        monkeypatch.setattr(jaccard, "SMALL", 4)
        monkeypatch.setattr(jaccard, "TILE", 10)
    texts = families(prose, 6, 25, 4) + [prose(("own", i), 100) for i in range(40)] + ["same few words", "same few words", "one", "one", "", "", "a b c d e", "a b c d e f"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.classes(df).collect()))
    assert got == brute(rows)
    kept = sorted(r["doc_id"] for r in jaccard.keep_one(df).collect())
    assert kept == sorted({c for _, c, _ in brute(rows)})


def test_nulls_repeats_and_names(spark, prose):
    a = prose("a", 30)
    rows = [(1, a, "p"), (1, a, "p"), (2, a, "q"), (3, None, "r"), (3, None, "r"), (None, a, "s"), (4, "", "t"), (5, prose("b", 400_000, line=50), "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string").selectExpr("*", "1 AS links", "2 AS r1")
    got = sorted(((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in jaccard.classes(df).collect()))
    assert got == [(0, 1, 3), (1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 3, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0)]
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    # Equal rows count once; the least id, here the null one, stays for its class.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "4", "5", "None"]
    assert jaccard.classes(df.limit(0)).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_exact_links():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(30)]
    owner, value = np.repeat(np.arange(30), [len(s) for s in sets]), np.concatenate(sets).astype(np.uint64)
    got = jaccard.exact_links(owner, value, 30, np.arange(30), np.arange(30))
    for i in range(30):
        for j in range(30):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert got[i, j] == (5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both))


def test_recall_needs_runs():
    assert (1 - jaccard.survival()) ** jaccard.runs_for() <= 1 - jaccard.RECALL


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(250)] + [(5, 5)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hundred_thousand_copies(spark, prose):
    text = prose("copied", 30)
    near = text.replace(" ", "  ") + " tail"
    df = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).unionByName(spark.createDataFrame([(200_000, near), (200_001, prose("other", 30))], "doc_id long, text string"))
    got = jaccard.classes(df)
    rows = {(r["class_id"], r["n_links"]): r["n"] for r in got.groupBy("class_id", "n_links").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rows == {(0, 100_000): 100_001, (200_001, 0): 1}


def test_the_row_that_stays_does_not_depend_on_chance(spark, prose):
    text = prose("kept", 40)
    rows = [(1, text, "b", 2), (1, text, "a", 9), (1, text, None, 3), (2, text, "0", 0), (None, None, "x", 1), (None, None, "x", 1), (3, "", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    want = None
    for parts in (1, 3, 7):
        got = sorted(tuple(r) for r in jaccard.keep_one(df.repartition(parts).orderBy(F.rand(parts))).selectExpr("coalesce(doc_id, -1)", "coalesce(text, '')", "source", "extra").collect())
        want = want or got
        assert got == want and len(got) == 4
    assert jaccard.keep_one(df.limit(0)).count() == 0
