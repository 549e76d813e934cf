import re
import zlib
from collections import Counter

import numpy as np
import pytest

from spherelake.llm import langid, quality, rules
from spherelake.llm.common import blocks
from spherelake.llm.flat import Flat


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(spark, prose):
    """Good prose, and three sorts of junk, with labels."""
    rows, labels = [], []
    for i in range(400):
        text, good = prose(i, 60 + i % 90, ("en", "de")[i % 2]), i % 4 != 0
        if not good:
            text = [" ".join(w + "%%%" for w in text.split()), " | ".join(text.split()), " ".join(text.split()[:2] * 60)][i % 3]
        rows.append((i, text, ("en", "de")[i % 2]))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def accuracy(rows, truth, said):
    own = [r for r in rows if held_out(r["doc_id"])]
    return sum(said(r) == bool(truth[r["doc_id"]]) for r in own) / len(own)


def test_attention_classifier(corpus):
    docs, labels, truth = corpus
    rows = quality.score(docs, quality.fit(docs, labels)).collect()
    assert accuracy(rows, truth, lambda r: r["predicted"] == 1) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    net = quality.Network.fresh(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    sizes = np.array([3, 1, 4])
    x, begins, y = rng.random((8, quality.WIDTH)), np.cumsum(sizes) - sizes, np.array([1.0, 0.0, 1.0])
    loss = lambda: float(np.mean(np.logaddexp(0, net.forward(x, begins, sizes)[0]) - y * net.forward(x, begins, sizes)[0]))
    g = net.step(x, begins, sizes, y)
    for name in ("enc", "v", "u", "w", "out", "out_b"):
        at = tuple(0 for _ in net.p[name].shape)
        before = net.p[name][at]
        net.p[name][at] = before + 1e-5
        up = loss()
        net.p[name][at] = before - 1e-5
        down = loss()
        net.p[name][at] = before
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-5


def test_attention_edges(spark, corpus):
    docs, labels, _ = corpus
    odd = spark.createDataFrame([(1, None), (2, ""), (2, " \n "), (None, "x y"), (3, "w " * 200_000)], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS x")
    for model in (quality.fit(docs, labels.limit(0)), quality.fit(docs, labels.where("quality = 1")), quality.fit(docs, labels)):
        got = quality.score(odd, model, keep=("doc_id", "score", "x")).collect()
        assert len(got) == 5 and all(r["score"] is not None for r in got)
        assert quality.score(odd.limit(0), model).count() == 0
    many = labels.unionByName(labels).selectExpr("doc_id", "if(doc_id % 50 = 1, NULL, quality) AS quality")
    assert isinstance(quality.fit(docs.unionByName(docs), many), quality.Network)


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_base_counts(prose):
    import random

    rng = random.Random(2)
    texts = ["", "a", "a b", "x  y\n\n \nx  y\n", "é € 漢字 \x0b z\x1c", "a b c a b c", "a b c d", "#|\r\n#|\r\n", "  \xa0"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 60))) for _ in range(300)] + [prose(1, 3000)]
    got = []
    for a, b in blocks(texts, 2000):
        flat = Flat(texts[a:b])
        prefix, words, doc, lengths = rules.word_hashes(flat)
        out = rules.base_counts(flat, prefix, words, doc, lengths)
        got += list(zip(*[out[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
    assert got == [brute(t) for t in texts]


def test_rules(spark, corpus):
    docs, labels, truth = corpus
    model = rules.fit(docs, labels)
    rows = rules.score(docs, model).collect()
    assert accuracy(rows, truth, lambda r: r["kept"]) >= 0.95
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= rules.KEEP)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "w " * 600_000), (3, "w " * 600_000)], "doc_id long, text string").selectExpr("*", "1 AS kept")
    got = rules.score(odd, model, keep=("doc_id", "kept")).collect()
    assert len(got) == 5 and all(r["base_failed"] and not r["kept"] for r in got)
    assert rules.score(odd.limit(0), model).count() == 0
    assert rules.score(docs, rules.fit(docs, labels.limit(0))).where("NOT base_failed AND NOT kept").count() == 0


def test_scores_do_not_depend_on_neighbours(corpus):
    docs, labels, _ = corpus
    model, net = rules.fit(docs, labels), quality.fit(docs, labels)
    few = docs.orderBy("doc_id").limit(20)
    for score, m in ((rules.score, model), (quality.score, net)):
        whole = {r["doc_id"]: r for r in score(docs.repartition(2), m).collect()}
        alone = {r["doc_id"]: r for r in score(few.repartition(20), m).collect()}
        for k, r in alone.items():
            assert all(abs(a - b) < 1e-5 if isinstance(a, float) else a == b for a, b in zip(tuple(r), tuple(whole[k])))


def test_languages(spark, corpus):
    docs, _, _ = corpus
    model = langid.fit(docs)
    rows = langid.predict(docs, model, keep=("doc_id", "lang")).collect()
    own = [r for r in rows if held_out(r["doc_id"])]
    assert sum(r["lang"] == r["lang_pred"] for r in own) / len(own) >= 0.98
    assert sum(r["rejected"] for r in rows) <= 4 and all(0 <= r["score"] <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, "123 !!\n"), (None, "漢字" * 200), (3, "the and " * 150_000), (4, "\U0001d400")], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS lang_pred")
    got = langid.predict(odd, model, keep=("doc_id", "text", "score")).collect()
    assert [r["lang_pred"] for r in got][:3] == ["und"] * 3 and all(r["rejected"] for r in got[:4])
    assert got[3]["lang_pred"] in ("de", "en") and got[4]["lang_pred"] == "en" and not got[4]["rejected"]
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns and 3 in [r["doc_id"] for r in kept.collect()]
    assert langid.predict(odd.limit(0), model).count() == 0


def test_nothing_to_learn(spark, corpus):
    docs, _, _ = corpus
    none = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert langid.fit(none) is None and langid.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.predict(docs.limit(5), None).collect()} == {"und"}


def test_labels_of_held_out_rows_are_never_learned(spark, corpus):
    docs, labels, _ = corpus
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - quality, quality) AS quality")
    a, b = rules.fit(docs, labels), rules.fit(docs, turned)
    assert (a.weights == b.weights).all() and a.scale == b.scale


def test_short_foreign_texts_are_rejected(spark, corpus, prose):
    docs, _, _ = corpus
    model = langid.fit(docs)
    assert (model.floors > 0).all() and (np.diff(model.floors) >= 0).all()
    foreign = ["Привет, как твои дела сегодня, друг", "今天天气很好我们一起去公园散步吧好不好呢今天天气很好", "Καλημέρα σας τι κάνετε σήμερα φίλε"]
    assert langid.classify(model, foreign)[2] == [True] * 3
    short = [prose(("short", i), 3 + i % 12, ("en", "de")[i % 2]) for i in range(200)]
    assert sum(langid.classify(model, short)[2]) <= 2
    few = langid.fit(docs.where("doc_id < 12"))
    assert (few.floors > 0).all() and all(langid.classify(few, foreign)[2])
