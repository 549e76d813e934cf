"""Hashed n-gram vectors of texts, samples of labelled rows, and small trainers in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherelake.llm.common import fold, map_texts
from spherelake.llm.flat import Flat, windows

#: Odd multipliers of the n-gram hash (fixed values).
GRAM = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))
#: Texts whose vectors are held at once.
ROWS = 256


def gram_index(cp: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each position the bucket of the n-gram that begins there; the last ones wrap over the end."""
    h = np.full(len(cp), np.uint32(n * 0x2545F491 & 0xFFFFFFFF), np.uint32)
    for j in range(n):
        part = cp[j:] * GRAM[j]
        h[: len(part)] += part
    h ^= h >> np.uint32(15)
    h *= GRAM[3]
    return h >> np.uint32(32 - bits)


def char_rows(flat: Flat, sizes: tuple[int, ...], bits: int, cp: np.ndarray | None = None, skip: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, counts of hashed character n-grams) for groups of texts.

    A text's n-grams lie within it and the line end after it, so a row doesn't depend on
    its neighbours.  ``skip`` marks positions at which no n-gram counts.
    """
    cp = flat.cp if cp is None else cp
    index = [gram_index(cp, n, bits) for n in sizes]
    for a in range(0, flat.n, ROWS):
        b = min(flat.n, a + ROWS)
        begin, end = int(flat.at[a]), int(flat.to[b - 1]) + 1
        row = np.repeat(np.arange(b - a), flat.lens[a:b] + 1)
        left = np.repeat(flat.to[a:b], flat.lens[a:b] + 1) - np.arange(begin, end)
        total = np.zeros((b - a) << bits)
        for n, h in zip(sizes, index):
            ok = left >= max(1, n - 1)
            if skip is not None:
                ok &= ~skip[begin:end]
            total += np.bincount(((row << bits) + h[begin:end])[ok], minlength=(b - a) << bits)
        yield a, b, total.reshape(b - a, 1 << bits)


def word_rows(flat: Flat, words: np.ndarray, doc: np.ndarray, sizes: tuple[int, ...], bits: int, a: int, b: int) -> np.ndarray:
    """Counts of hashed word n-grams for the texts [a, b); ``words`` are hashes, ``doc`` their texts in order."""
    i, j = np.searchsorted(doc, [a, b])
    total = np.zeros((b - a) << bits)
    for n in sizes:
        if j - i < n:
            continue
        h = (windows(words[i:j], n) >> np.uint64(64 - bits)).astype(np.int64)
        first, last = doc[i : j - n + 1], doc[i + n - 1 : j]
        ok = first == last
        total += np.bincount((((first - a) << bits) + h)[ok], minlength=(b - a) << bits)
    return total.reshape(b - a, 1 << bits)


def hellinger(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: rows of unit length, or zero."""
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def pack(rows: np.ndarray) -> list[bytes]:
    """Rows as bytes: positions (uint16), then values (float32) of what isn't zero."""
    out = []
    for r in rows:
        at = np.flatnonzero(r)
        out.append(at.astype(np.uint16).tobytes() + r[at].astype(np.float32).tobytes())
    return out


def unpack(packed: bytes, width: int) -> np.ndarray:
    n = len(packed) // 6
    out = np.zeros(width, np.float32)
    out[np.frombuffer(packed, np.uint16, n)] = np.frombuffer(packed, np.float32, n, offset=2 * n) if n % 2 == 0 else np.frombuffer(packed[2 * n :], np.float32)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents for learning, the first by a hash of their id: doc_id, text, y.

    Rows whose crc32(doc_id) mod 5 is 0 are never taken.  Null labels and ids are left out;
    of repeated ids, one label (the largest) and one text (the least) are used.  The bound makes the broadcast safe.
    """
    picked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id", F.desc("y"))
        .limit(most)
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("text").alias("text"))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.5, l2: float = 1e-4) -> np.ndarray:
    """Weights with the bias last, by Adam over all rows."""
    n, d = x.shape
    w = np.zeros(d + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        e = ((p - y) / n).astype(np.float32)
        g = np.append(x.T @ e + l2 * w[:-1], e.sum())
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


__all__ = ["char_rows", "fit_logistic", "fold", "hellinger", "labelled_sample", "map_texts", "pack", "unpack", "word_rows"]
