import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spherelake.llm import pieces as P


@pytest.fixture(scope="module")
def model():
    return P.Pieces.load()


def brute(model, text, n):
    """The n best scores by a plain dynamic programme over the whole text."""
    if not text:
        return [0.0]
    unit = P.Unit([P.OWN_MARK if c == P.MARK else ord(P.MARK) if c == " " else ord(c) for c in " " + text])
    tops = [[0.0]]
    for into in P.edges(model, unit)[1:]:
        e = len(tops)
        tops.append(sorted((t + s for k, s, _ in into for t in tops[e - k]), reverse=True)[:n])
    return tops[-1]


ODD = ["", "a", " ", "   ", "the the", "▁", "a▁b \n\n c", "\x00é漢字\U0001d11e", "a" * 60, "<s> </s> <0x41> <unk>", "x" * 70 + " " * 40 + "y", "\t\r\n", "￾"]


def test_n_best_and_round_trip(model):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abthein  \n é▁漢.") for _ in range(rng.randint(0, 30))) for _ in range(150)]
    ids, offsets, scores, others = P.Encoder(model, 4).encode(texts)
    assert P.decode_ids(model, ids, offsets) == texts
    value = dict(zip(model.ids.tolist(), model.scores.tolist()))
    for i, t in enumerate(texts):
        assert [x for x in scores[i] if x > -np.inf] == brute(model, t, 4)
        seen = {tuple(ids[offsets[i] : offsets[i + 1]])}
        for changes in others[i]:
            own = tuple(P.apply_alternative(ids[offsets[i] : offsets[i + 1]].tolist(), changes))
            assert own not in seen
            seen.add(own)
            assert P.decode_ids(model, np.array(own, np.int64), np.array([0, len(own)])) == [t]
    # A path without bytes scores what its pieces add up to.
    i = texts.index("the the")
    assert scores[i, 0] == sum(value[x] for x in ids[offsets[i] : offsets[i + 1]])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text_round_trips(model, texts):
    ids, offsets, _, _ = P.Encoder(model, 1).encode(texts)
    assert P.decode_ids(model, ids, offsets) == texts


def test_neighbours_do_not_matter(model):
    alone = [P.Encoder(model, 2).encode([t]) for t in ODD]
    ids, offsets, scores, _ = P.Encoder(model, 2).encode(ODD)
    for i, (own, _, s, _) in enumerate(alone):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == own.tolist() and scores[i].tolist() == s[0].tolist()


def test_tables(spark, model):
    rows = [(1, "hello there"), (2, None), (3, ""), (1, "hello there"), (None, "é " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS ids", "6 AS others")
    made = P.encode(df, model, keep=("doc_id", "text", "ids"), n=3)
    back = P.decode(made, model).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back) and len(back) == 5
    one = [r for r in back if r["doc_id"] == 1]
    assert one[0]["ids"] == one[1]["ids"] and len(one[0]["others"]) == 2 and len(one[0]["scores"]) == 3
    assert [len(r["ids"]) for r in back if r["doc_id"] in (2, 3)] == [0, 0]
    assert P.encode(df.limit(0), model).count() == 0
    odd = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in P.decode(odd, model).collect()] == [None, ""]
