"""Quality rules: counted base rules, and a logistic regression on hashed n-grams.

The regression reads square-rooted shares of hashed character and word n-grams of the
whole text.  It is fitted on a bounded sample of labelled rows (``SAMPLE``), with a
part kept apart to calibrate its probabilities (Platt scaling); texts are scored in
Arrow batches against the fixed threshold ``KEEP``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from spherelake.llm.common import map_texts, schema_with
from spherelake.llm.flat import Flat, counts, mix, windows
from spherelake.llm.hashed import char_rows, fit_logistic, hellinger, labelled_sample, pack, unpack, word_rows
from spherelake.llm.secrets import platt

#: Labelled rows that are used for fitting, at most.
SAMPLE = 3000
#: A text is kept if its calibrated probability of being good is at least this.
KEEP = 0.3
#: Base rules: the fewest words, and the largest percentage of words in repeated windows (fixed values).
LEAST_WORDS, REPEATED = 50, 50
CHAR_SIZES, WORD_SIZES, BITS = (2, 3, 4), (1, 2), 12
SYMBOLS = tuple("#*$%&|<>")


@dataclass(frozen=True)
class Model:
    """Weights (character buckets, word buckets, bias) and the calibration's scale and shift."""

    weights: np.ndarray
    scale: float
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))


def vectors(flat: Flat, words: np.ndarray, doc: np.ndarray):
    """(begin, end, unit rows) for groups of texts."""
    for a, b, c in char_rows(flat, CHAR_SIZES, BITS):
        yield a, b, np.concatenate([hellinger(c), hellinger(word_rows(flat, words, doc, WORD_SIZES, BITS, a, b))], 1)


def word_hashes(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prefix hashes, word hashes, the text of each word, and word lengths."""
    prefix = flat.prefix()
    begin, end = flat.words()
    return prefix, flat.spans(prefix, begin, end), flat.doc_of(begin), end - begin


def base_counts(flat: Flat, prefix: np.ndarray, words: np.ndarray, doc: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = flat.n
    out = {"n_words": counts(doc, n).astype(np.int64), "word_chars": counts(doc, n, lengths).astype(np.int64)}
    table = np.zeros(128, bool)
    table[[ord(c) for c in SYMBOLS]] = True
    at = np.flatnonzero(table[np.minimum(flat.cp, np.uint32(127))])
    out["n_symbols"] = counts(flat.doc_of(at), n).astype(np.int64)
    # Lines: from one line end to the next.  The first of equal lines in a text doesn't count.
    ends = np.flatnonzero(flat.cp == 10)
    begins = np.append(0, ends[:-1] + 1)[: len(ends)]
    word_at = flat.words()[0]
    has = np.searchsorted(word_at, ends) > np.searchsorted(word_at, begins)
    begins, ends = begins[has], ends[has]
    line_doc = flat.doc_of(begins)
    key = flat.spans(prefix, begins, ends) ^ mix(line_doc.astype(np.uint64) + np.uint64(1))
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    out["n_dup_lines"] = counts(line_doc[~first], n).astype(np.int64)
    # Windows of three words within a text, found twice or more: all their words count, each once.
    cover = np.zeros(len(words) + 1, np.int64)
    if len(words) >= 3:
        whole = np.flatnonzero(doc[:-2] == doc[2:])
        key = windows(words, 3)[whole] ^ mix(doc[whole].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        k = key[order]
        twice = np.zeros(len(k), bool)
        same = k[1:] == k[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        at = whole[order[twice]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + 3, -1) if len(at) and at.max() + 3 <= len(words) else None
        cover = np.cumsum(cover)
    out["n_repeat_words"] = counts(doc[cover[: len(words)] > 0], n).astype(np.int64)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    """Fit on at most ``most`` labelled rows.  With one class, or none, everything is as good as that class."""

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            flat = Flat(texts)
            _, words, doc, _ = word_hashes(flat)
            return {"x": [p for _, _, rows in vectors(flat, words, doc) for p in pack(rows)]}

        return work

    got = map_texts(labelled_sample(docs, labels, label, most), ["id", "y"], "text", "id bigint, y int, x binary", make).collect()
    width = 2 << BITS
    if len({r["y"] for r in got}) < 2:
        only = 8.0 if not got or got[0]["y"] else -8.0
        return Model(np.append(np.zeros(width, np.float32), np.float32(only)), 1.0, 0.0)
    got.sort(key=lambda r: (r["id"] * 2654435761 % 2**32, r["id"]))
    x = np.stack([unpack(bytes(r["x"]), width) for r in got])
    y = np.array([r["y"] for r in got], np.float32)
    apart = np.arange(len(x)) % 4 == 0
    if len(set(y[~apart])) < 2 or len(set(y[apart])) < 2:
        apart[:] = False
    w = fit_logistic(x[~apart], y[~apart], rate=0.2)
    on = apart if apart.any() else ~apart
    scale, shift = platt(x[on] @ w[:-1] + w[-1], y[on])
    return Model(w, max(scale, 0.05), shift)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = KEEP) -> DataFrame:
    """``keep``, base counts, ``base_failed``, ``kept`` and ``probability`` for every row.

    Null texts have no words, and so fail.  Repeated rows each give a row, an empty
    table none.  Words lie between ASCII white space; counts cover the whole text.
    """
    kept, schema = schema_with(docs, keep, "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, probability double")

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            flat = Flat(texts)
            prefix, words, doc, lengths = word_hashes(flat)
            out: dict[str, object] = base_counts(flat, prefix, words, doc, lengths)
            failed = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > REPEATED * out["n_words"])
            p = np.concatenate([model.probability(rows) for _, _, rows in vectors(flat, words, doc)]).astype(float)
            return out | {"base_failed": failed, "kept": ~failed & (p >= threshold), "probability": p}

        return work

    return map_texts(docs, kept, text, schema, make)
