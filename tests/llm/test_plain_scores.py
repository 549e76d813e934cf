"""Scores of the classifiers against plain loops over characters and words, one text at a time."""

import math
import re

import numpy as np

from spherelake.llm import langid, quality, rules
from spherelake.llm.flat import BASE, JOIN, MIX1, MIX2, TOP, Flat
from spherelake.llm.hashed import GRAM

MASK = (1 << 64) - 1
TEXTS = ["", "one", "A few words,\nand a 2nd line: yes!", "tab\tand  spaces \x0b end ", "é ß 中文 words", "x " * 300 + "tail", "The End. " * 70, "\n\n#$%\n\n", "𠀀𰀀 𰀁"]


def bucket(cp, p, n, bits):
    h = n * 0x2545F491 & 0xFFFFFFFF
    for j in range(n):
        if p + j < len(cp):
            h = (h + cp[p + j] * int(GRAM[j])) & 0xFFFFFFFF
    h ^= h >> 15
    return (h * int(GRAM[3]) & 0xFFFFFFFF) >> (32 - bits)


def mix(h):
    h ^= h >> 33
    h = h * MIX1 & MASK
    h ^= h >> 29
    h = h * MIX2 & MASK
    return h ^ (h >> 32)


def word_hash(w):
    return mix((sum(mix(ord(c) + 1) * pow(BASE, k, 1 << 64) for k, c in enumerate(w)) + len(w)) & MASK)


def words_of(text):
    return [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_quality_scores(prose):
    net = quality.Network.fresh(np.random.default_rng(5))
    net.p["platt"] = np.array([1.3, -0.2], np.float32)
    texts = [*TEXTS, prose("a", 400), prose("b", 64, "de"), prose("c", 65, "fr")]
    got = []
    for x, owner, a, b in quality.encode(texts):
        sizes = np.bincount(owner - a, minlength=b - a)
        got += net.probability(x, np.cumsum(sizes) - sizes, sizes).tolist()
    for text, p in zip(texts, got):
        cp = [ord(c) for c in text] + [10]
        words = words_of(text)
        rows = []
        for k in range(0, max(1, len(words)), 64):
            own = words[k : k + 64]
            row = []
            for n in (2, 3):
                count = [0] * 256
                for a, b in own:
                    for q in range(a, b + 1):
                        if q + n - 1 <= len(text):
                            count[bucket(cp, q, n, 8)] += 1
                row += [math.sqrt(c / max(1, sum(count))) for c in count]
            body = "".join(text[a:b] for a, b in own)
            chars = max(1, len(body))
            row += [sum("A" <= c <= "Z" for c in body) / chars, sum("0" <= c <= "9" for c in body) / chars, sum(not c.isalnum() and c > " " for c in body) / chars]
            row += [len({text[a:b] for a, b in own}) / max(1, len(own)), len(own) / 64, chars / max(1, len(own)) / 10, float(not own), 1.0]
            rows.append(row)
        x, w = np.array(rows), {k: v.astype(float) for k, v in net.p.items()}
        h = np.tanh(x @ w["enc"] + w["enc_b"])
        e = [float(np.tanh(r @ w["v"]) * (1 / (1 + np.exp(-(r @ w["u"])))) @ w["w"]) for r in h]
        a = np.exp(np.array(e)) / np.exp(np.array(e)).sum()
        z = float((a @ h) @ w["out"] + w["out_b"][0])
        assert abs(sigmoid(w["platt"][0] * z + w["platt"][1]) - p) < 1e-4


def test_language_cosines(prose):
    rng = np.random.default_rng(6)
    centroids = rng.random((5, 1 << langid.BITS)).astype(np.float32)
    centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    model = langid.Model(rng.random(1 << langid.BITS).astype(np.float32) + 0.1, centroids, ("a", "a", "b", "c", "c"), np.linspace(0.0, 0.9, len(langid.LENGTHS) + 1))
    texts = [*TEXTS, prose("a", 200), prose("b", 30, "de").upper()]
    langs, scores, rejected = langid.classify(model, texts)
    for text, lang, score, no in zip(texts, langs, scores, rejected):
        low = [c.lower() if len(c.lower()) == 1 else c for c in text]
        cp = [ord(x) if c.isalpha() else 32 for c, x in zip(text, low)] + [32]
        count: dict[int, int] = {}
        for p in range(len(cp)):
            if p and cp[p] == 32 and cp[p - 1] == 32 and not text[p - 1 : p].isalpha() and not text[p : p + 1].isalpha():
                continue
            for n in (1, 2, 3):
                if len(text) - p >= max(1, n - 1):
                    k = bucket(cp, p, n, langid.BITS)
                    count[k] = count.get(k, 0) + 1
        letters = sum(c.isalpha() for c in text)
        if not letters:
            assert (lang, score, no) == ("und", 0.0, True)
            continue
        x = np.zeros(1 << langid.BITS)
        for k, c in count.items():
            x[k] = math.log1p(c) * model.idf[k]
        cosine = centroids.astype(float) @ (x / np.linalg.norm(x))
        group = sum(letters >= n for n in langid.LENGTHS)
        assert abs(cosine.max() - score) < 1e-5 and model.langs[int(cosine.argmax())] == lang and no == (score < model.floors[group])


def test_rule_probabilities(prose):
    rng = np.random.default_rng(7)
    model = rules.Model(rng.normal(0, 2, (2 << rules.BITS) + 1).astype(np.float32), 0.7, 0.3)
    texts = [*TEXTS, prose("a", 120), prose("b", 60, "de")]
    flat = Flat(texts)
    _, hashes, doc, _ = rules.word_hashes(flat)
    got = np.concatenate([model.probability(rows) for _, _, rows in rules.vectors(flat, hashes, doc)])
    for text, p in zip(texts, got):
        cp = [ord(c) for c in text] + [10]
        chars, grams = np.zeros(1 << rules.BITS), np.zeros(1 << rules.BITS)
        for q in range(len(cp)):
            for n in (2, 3, 4):
                if len(text) - q >= n - 1:
                    chars[bucket(cp, q, n, rules.BITS)] += 1
        own = [word_hash(text[a:b]) for a, b in words_of(text)]
        for n in (1, 2):
            for k in range(len(own) - n + 1):
                grams[mix(sum(own[k + j] * int(JOIN[j]) for j in range(n)) & MASK) >> (64 - rules.BITS)] += 1
        x = np.concatenate([np.sqrt(chars / max(1, chars.sum())), np.sqrt(grams / max(1, grams.sum()))])
        z = float(x @ model.weights[:-1].astype(float) + model.weights[-1])
        assert abs(sigmoid(0.7 * z + 0.3) - p) < 1e-4


def test_tables_cover_all_letters_and_digits():
    assert not any(chr(c).isalnum() for c in range(TOP, 0x110000))
    model = langid.Model(np.ones(1 << langid.BITS, np.float32), np.eye(1, 1 << langid.BITS, dtype=np.float32), ("a",), np.zeros(len(langid.LENGTHS) + 1))
    assert langid.classify(model, ["𰀀𰀁"])[0] == ["a"] and langid.classify(model, ["12 34"])[0] == ["und"]
