"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words (all of them, the last one shorter).
Each passage is encoded from its hashed character n-grams and a few shape features by
one dense layer.  Gated attention, learned from document labels alone, weighs the
passages; the weighted sum is the document's representation, which a logistic layer
scores.  Scores are calibrated by Platt scaling on a part of the sample kept apart.

The network is fitted on a bounded sample of labelled rows (``SAMPLE``), on all passages
of their texts.  Scoring reads every passage of every text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from spherelake.llm.common import map_texts, schema_with
from spherelake.llm.flat import Flat, alnum_table, look, mix
from spherelake.llm.hashed import gram_index, labelled_sample
from spherelake.llm.secrets import platt

#: Labelled rows that are used for fitting, at most.
SAMPLE = 2500
PASSAGE = 64
SIZES, BITS = (2, 3), 8
SHAPES = 8
WIDTH = (len(SIZES) << BITS) + SHAPES
HIDDEN, ATTEND = 24, 16
GOOD = 0.3
#: Passages whose features are held at once.
ROWS = 4096


def passages(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word begins and ends; the passage of each word; each passage's text; passages by text.

    A text without words is one empty passage.
    """
    begin, end = flat.words()
    doc = flat.doc_of(begin)
    n_words = np.bincount(doc, minlength=flat.n)
    bags = np.maximum(1, -(-n_words // PASSAGE))
    first_passage = np.cumsum(bags) - bags
    first_word = np.cumsum(n_words) - n_words
    passage = first_passage[doc] + (np.arange(len(begin)) - first_word[doc]) // PASSAGE
    return begin, end, passage, np.repeat(np.arange(flat.n), bags), bags


def encode(texts: list[str]):
    """(passage features, text of each passage) in order, in groups of whole texts."""
    flat = Flat(texts)
    begin, end, passage, owner, bags = passages(flat)
    prefix = flat.prefix()
    words = flat.spans(prefix, begin, end)
    tables = {n: gram_index(flat.cp, n, BITS).astype(np.int64) for n in SIZES}
    cp, low = flat.cp, np.minimum(flat.cp, np.uint32(127))
    upper = (low >= 65) & (low <= 90)
    digit = (low >= 48) & (low <= 57)
    symbol = ~look(alnum_table(), cp) & (cp > 32)
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (upper, digit, symbol)]
    last = np.cumsum(bags)
    at = 0
    while at < flat.n:
        # Whole texts, as many as fit.
        start = int(last[at] - bags[at])
        to = max(at + 1, int(np.searchsorted(last, start + ROWS, "right")))
        a, b = start, int(last[to - 1])
        i, j = np.searchsorted(passage, [a, b])
        own = passage[i:j] - a
        x = np.zeros((b - a, WIDTH), np.float32)
        lengths = (end - begin)[i:j]
        # Every position of a word and the space after it, with the passage it belongs to.
        if j > i:
            reach = lengths + 1
            position = np.repeat(begin[i:j] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
            row = np.repeat(own, reach)
            for k, n in enumerate(SIZES):
                # N-grams end at the line end after their text at the latest.
                ok = position + n - 1 <= flat.to[owner[row + a]]
                total = np.bincount((row[ok] << BITS) + tables[n][position[ok]], minlength=(b - a) << BITS).reshape(b - a, -1)
                x[:, k << BITS : (k + 1) << BITS] = np.sqrt(total / np.maximum(total.sum(1, keepdims=True), 1))
        shape = x[:, len(SIZES) << BITS :]
        n_words = np.bincount(own, minlength=b - a)
        n_chars = np.maximum(np.bincount(own, lengths, b - a), 1)
        key = np.unique(words[i:j] ^ mix(own.astype(np.uint64)), return_index=True)[1]
        for k, s in enumerate(sums):
            shape[:, k] = np.bincount(own, s[end[i:j]] - s[begin[i:j]], b - a) / n_chars
        shape[:, 3] = np.bincount(own[key], minlength=b - a) / np.maximum(n_words, 1)
        shape[:, 4] = n_words / PASSAGE
        shape[:, 5] = n_chars / np.maximum(n_words, 1) / 10
        shape[:, 6] = n_words == 0
        shape[:, 7] = 1
        yield x, owner[a:b], at, to
        at = to


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def bag_sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(rows, begins, axis=0)


class Network:
    """Passage encoder, gated attention and logistic output, with their gradients."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        normal = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        p = {"enc": normal(WIDTH, HIDDEN) * 4, "enc_b": np.zeros(HIDDEN, np.float32), "v": normal(HIDDEN, ATTEND), "u": normal(HIDDEN, ATTEND), "w": normal(ATTEND)}
        return Network(p | {"out": normal(HIDDEN), "out_b": np.zeros(1, np.float32), "platt": np.array([1, 0], np.float32)})

    def forward(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), sizes))
        a = e / np.repeat(bag_sums(e, begins), sizes)
        z = bag_sums(a[:, None] * h, begins)
        return z @ p["out"] + p["out_b"][0], (h, t, g, a, z)

    def step(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, (h, t, g, a, z) = self.forward(x, begins, sizes)
        d = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        grad = {"out": z.T @ d, "out_b": d.sum(keepdims=True)}
        dz = np.repeat(np.outer(d, p["out"]), sizes, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(bag_sums(a * da, begins), sizes))
        grad["w"] = (t * g).T @ de
        dt, dg = np.outer(de, p["w"]) * g * (1 - t * t), np.outer(de, p["w"]) * t * g * (1 - g)
        grad |= {"v": h.T @ dt, "u": h.T @ dg}
        dh = (a[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        return grad | {"enc": x.T @ dh, "enc_b": dh.sum(0)}

    def probability(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        a, b = self.p["platt"]
        return sigmoid(a * self.forward(x, begins, sizes)[0] + b)


def train(bags: list[np.ndarray], y: np.ndarray, rounds: int = 12, seed: int = 7) -> Network:
    """Adam over batches of bags; a quarter of the bags is kept apart for the calibration."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    apart = np.arange(len(bags)) % 4 == 0
    if len(set(y[~apart])) < 2 or len(set(y[apart])) < 2:
        apart[:] = False
    learn = np.flatnonzero(~apart)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items() if k != "platt"}

    def batch(index):
        sizes = np.array([len(bags[i]) for i in index])
        return np.concatenate([bags[i] for i in index]), np.cumsum(sizes) - sizes, sizes

    t = 0
    for _ in range(rounds):
        rng.shuffle(learn)
        for i in range(0, len(learn), 64):
            t += 1
            grad = net.step(*batch(learn[i : i + 64]), y[learn[i : i + 64]])
            for k, (m, v) in moments.items():
                m += 0.1 * (grad[k] - m)
                v += 0.001 * (grad[k] ** 2 - v)
                net.p[k] = net.p[k] - np.float32(0.004) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
    on = np.flatnonzero(apart) if apart.any() else learn
    logit = np.concatenate([net.forward(*batch(on[i : i + 64]))[0] for i in range(0, len(on), 64)])
    net.p["platt"] = np.array(platt(logit, y[on]), np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Network | float:
    """A network, or a constant score where the sample has one class or nothing."""

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            out = []
            for x, owner, a, b in encode(texts):
                for i in range(a, b):
                    own = x[np.searchsorted(owner, i) : np.searchsorted(owner, i, "right")]
                    out.append(own.astype(np.float16).tobytes())
            return {"x": out}

        return work

    got = map_texts(labelled_sample(docs, labels, label, most), ["id", "y"], "text", "id bigint, y int, x binary", make).collect()
    if len({r["y"] for r in got}) < 2:
        return float(got[0]["y"] > 0) if got else 1.0
    got.sort(key=lambda r: (r["id"] * 2654435761 % 2**32, r["id"]))
    bags = [np.frombuffer(bytes(r["x"]), np.float16).reshape(-1, WIDTH).astype(np.float32) for r in got]
    return train(bags, np.array([r["y"] > 0 for r in got], np.float32))


def score(docs: DataFrame, model: Network | float, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = GOOD) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and ``predicted`` (1 if the score is at least the threshold) for every row.

    Null and empty texts are one empty passage, and get a score too; of a very long text
    every passage counts.  Repeated rows each give a row, an empty table none.  Columns of
    ``keep`` named score or predicted are left out.
    """
    kept, schema = schema_with(docs, keep, "score double, predicted int")
    parameters = model.p if isinstance(model, Network) else float(model)

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            if isinstance(parameters, float):
                p = np.full(len(texts), parameters)
            else:
                net, parts = Network(parameters), []
                for x, owner, a, b in encode(texts):
                    sizes = np.bincount(owner - a, minlength=b - a)
                    parts.append(net.probability(x, np.cumsum(sizes) - sizes, sizes).astype(float))
                p = np.concatenate(parts)
            return {"score": p, "predicted": (p >= threshold).astype(np.int32)}

        return work

    return map_texts(docs, kept, text, schema, make)
