import random
import re

import numpy as np

from spherelake.llm import decontaminate as D


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    own = rng.integers(0, 2**63, (50, 2), dtype=np.uint64)
    asked = own[rng.integers(0, 50, 200)].copy()
    for row in asked:
        for bit in rng.choice(D.BITS, rng.integers(0, 60), replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    i, j = D.HammingIndex(own).query(asked)
    far = np.bitwise_count(asked[:, None] ^ own[None]).sum(2)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(far <= D.RADIUS))))


def test_index_prunes():
    rng = np.random.default_rng(4)
    own, asked = (rng.integers(0, 2**64, (n, 2), dtype=np.uint64) for n in (500, 400))
    pairs, read = D.HammingIndex(own).candidates(asked)
    assert len(pairs) <= 0.03 * 500 * 400 and read <= 0.3 * 500 * 400
    for radius in (0, 1, 4, 20, 40):
        close = own[:200].copy()
        for row in close:
            for bit in rng.choice(D.BITS, radius, replace=False):
                row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        i, j = D.HammingIndex(own, radius).query(close)
        far = np.bitwise_count(close[:, None] ^ own[None]).sum(2)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(far <= radius)))) and len(i) >= 200


def test_radius_holds_what_is_similar_enough(prose):
    # Windows at the least similarity: words changed until one more would be too many.
    rng, near, within = random.Random(6), 0, 0
    for k in range(300):
        own = prose(f"item{k}", rng.choice([30, 50, 80, 120])).lower().split()
        changed, last = list(own), None
        while D.similarity(D.shingle_counter(changed, 5), D.shingle_counter(own, 5)) >= D.SIMILARITY:
            last = list(changed)
            changed[rng.randrange(len(changed))] = f"other{rng.randrange(10**9)}"
        if last == own:
            continue
        near += 1
        groups = D.build([(1, " ".join(own)), (2, " ".join(last))])
        a, b = groups[0].index.prints
        within += int(np.bitwise_count(a ^ b).sum()) <= D.RADIUS
    assert near > 200 and within >= 0.99 * near


def brute(texts, items):
    split = lambda t: [w.lower() for w in re.findall(r"[^\W_]+", t)]
    out = {}
    for d, t in enumerate(texts):
        w = split(t)
        for i, x in items:
            own = split(x)
            if not own:
                continue
            k = min(5, len(own))
            want = D.shingle_counter(own, k)
            best = max((D.similarity(D.shingle_counter(w[p : p + len(own)], k), want) for p in range(len(w) - len(own) + 1)), default=0)
            if best >= 0.8:
                out[d, i] = best
    return out


def test_matches_equal_brute_force(prose):
    rng = random.Random(3)
    items = [(i, prose(f"item{i}", rng.choice([3, 7, 20, 45]))) for i in range(12)] + [(90, ""), (91, "one"), (92, "two words")]
    texts = []
    for d in range(60):
        body = prose(f"doc{d}", 80).split()
        if d % 3 == 0:
            own = items[rng.randrange(12)][1].split()
            if d % 2 and len(own) > 15:
                own[rng.choice([0, 1, len(own) - 1])] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = [w.upper() + "!" if d % 4 == 0 else w for w in own]
        texts.append(" ".join(body))
    texts += ["", "One", "say two  WORDS."]
    got = {(d, i): s for d, i, s, _ in D.Matcher(D.build(items)).match(texts)}
    assert got == brute(texts, items) and len(got) > 15


def test_tables(spark, prose):
    passage = prose("bench", 30)
    rows = [(1, prose("a", 40) + " " + passage, "x"), (2, prose("b", 50), "x"), (3, None, "x"), (None, passage, None), (1, passage + " " + passage, "y"), (4, "", "x"), (5, "z " * 400_000 + passage, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, passage), (8, None), (None, passage), (7, "other words entirely")], "item_id long, text string")
    for most in (D.ITEM_WORDS, 5):
        got = sorted((r["doc_id"] or 0, r["item_id"], r["similarity"], r["n_words"]) for r in D.matches(docs, bench, most=most).collect())
        assert got == [(0, 7, 1.0, 30), (1, 7, 1.0, 30), (1, 7, 1.0, 30), (5, 7, 1.0, 30)]
        kept = D.clean(docs, bench, most=most)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    assert D.matches(docs.limit(0), bench).count() == 0 and D.matches(docs, bench.limit(0)).count() == 0
    assert D.clean(docs, bench.limit(0)).count() == 7


def test_texts_shorter_than_an_item(spark, prose):
    item, other = prose("whole", 50).split(), prose("other", 50).split()
    rows = [item[1:], item[:-3], [*item[:20], *item[22:]], item[:30], item[:4], other[:45], [*other[:20], "x", *other[21:49]], [*item[2:], *other[:9]]]
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(other))], "item_id long, text string")
    want = {}
    for d, words in enumerate(rows):
        for i, own in ((7, item), (8, other)):
            n = min(len(words), 50)
            s = max(D.similarity(D.shingle_counter([w.lower() for w in words[p : p + n]], 5), D.shingle_counter(own, 5)) for p in range(len(words) - n + 1))
            if s >= D.SIMILARITY:
                want[d, i] = s, n
    assert {0, 1, 2, 5} < {d for d, _ in want} and not {3, 4} & {d for d, _ in want}
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["n_words"]) for r in D.matches(docs, bench).collect()}
    assert got == want
    assert {r["doc_id"] for r in D.clean(docs, bench).collect()} == set(range(len(rows))) - {d for d, _ in want}


def test_clean_heeds_items_without_an_id(spark, prose):
    passage = prose("nameless", 30)
    docs = spark.createDataFrame([(1, passage), (2, prose("b", 50))], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (None, "x y z"), (7, "other words entirely")], "item_id long, text string")
    assert [r["doc_id"] for r in D.clean(docs, bench).collect()] == [2]
