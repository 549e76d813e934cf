"""Benchmark decontamination by SimHash of item-sized windows.

Words are lower-cased runs of letters and digits.  For each benchmark item of n words,
the documents' windows of n words are compared with it, and a document of fewer words
as one window, whole: a window's SimHash must lie
within RADIUS of the item's, and then the exact similarity of their multisets of
5-word shingles (sum of least counts over sum of largest) must be at least 0.8.

The items' fingerprints are indexed by blocks of bits (``HammingIndex``), which finds
all items within the radius and compares a few percent of the pairs.  At a similarity of 0.8 the shingle vectors
have a cosine of 0.89, so of 128 bits 19.4 differ on average (deviation 4.1); the
radius of 33 is 3.3 deviations above.

A window that shares no shingle with any item of its size has similarity 0 with all of
them and is not fingerprinted; this loses nothing.  The work is one pass over the
documents, without a shuffle: the index of a block of items (``ITEM_WORDS`` words at
most) is what executors get.  A larger benchmark takes several passes.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherelake.llm.common import ROW, map_texts
from spherelake.llm.flat import Flat, alnum_table, look, lowered, mix, windows

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS = 128, 33
#: Parts of a fingerprint in the index, of two blocks each; pairs that are looked at, at a time.
PARTS, MOST_PAIRS = 5, 2_000_000
#: Words of benchmark items that are indexed, and sent to executors, at a time: some 10,000 items, of 12 KB each in the index.
ITEM_WORDS = 500_000
#: Items whose shingles are held counted.
COUNTED = 2000


def tokens(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points; begins, ends, hashes and texts of the words."""
    cp = lowered(flat.cp)
    begin, end = flat.runs(look(alnum_table(), flat.cp) & (flat.cp != 10))
    return cp, begin, end, flat.spans(flat.prefix(cp), begin, end), flat.doc_of(begin)


def bit_rows(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of BITS bits of each shingle."""
    words = np.stack([shingles, mix(shingles + np.uint64(0x51ED27))], 1)
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(shingles), -1), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Rows of two 64-bit words: the bits whose sum is positive."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8")


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def masks(width: int, most: int) -> np.ndarray:
    """All values of so many bits of which at most ``most`` are set."""
    every = np.arange(1 << width, dtype=np.uint16)
    return every[np.bitwise_count(every) <= most]


class HammingIndex:
    """All fingerprints within a radius, by the generalized pigeonhole principle.

    The bits are cut into PARTS parts of two blocks each, and the radius + 1 is dealt out
    over the parts, then over a part's blocks: two fingerprints within the radius differ
    by less than its share in some part, and there by less than its share in some block.
    Every indexed fingerprint is listed under all values that differ from its own block by
    less than the block's share.  What a block's list gives is compared on the block's
    part, and what is left in full.
    """

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        edges = np.linspace(0, BITS, 2 * PARTS + 1).astype(int).tolist()
        self.parts = []
        for k in range(PARTS):
            share = (radius + 1) // PARTS + (k < (radius + 1) % PARTS)
            a, b, c = edges[2 * k : 2 * k + 3]
            lists = []
            for at, width, own in ((a, b - a, share - share // 2), (b, c - b, share // 2)):
                if own:
                    near = masks(width, own - 1)
                    key = (self.value(prints, at, width).astype(np.uint16)[:, None] ^ near).ravel()
                    order = np.argsort(key, kind="stable")
                    lists.append((at, width, key[order], (order // len(near)).astype(np.int32)))
            self.parts.append((a, c - a, share - 1, self.value(prints, a, c - a), lists))

    @staticmethod
    def value(prints: np.ndarray, at: int, width: int) -> np.ndarray:
        word, shift = divmod(at, 64)
        out = prints[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out = out | (prints[:, word + 1] << np.uint64(64 - shift))
        return (out & np.uint64((1 << width) - 1)).astype(np.int64)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, int]:
        """Pairs to compare in full, as row * indexed + indexed row, each once; and how many list entries were read."""
        pairs, read = [np.zeros(0, np.int64)], 0
        for a, width, most, own, lists in self.parts:
            asked = self.value(prints, a, width)
            for at, size, keys, rows in lists:
                key = self.value(prints, at, size).astype(np.uint16)
                begin = np.searchsorted(keys, key)
                n = np.searchsorted(keys, key, "right") - begin
                i, j = np.repeat(np.arange(len(prints)), n), rows[ragged(begin, n)]
                close = np.bitwise_count(asked[i] ^ own[j]) <= most
                pairs.append(i[close] * len(self.prints) + j[close])
                read += len(i)
        return np.unique(np.concatenate(pairs)), read

    def query(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``prints``, indexed row) within the radius, each once."""
        out = [np.zeros((2, 0), np.int64)]
        # So many at a time that what a list gives stays small.
        step = max(16, MOST_PAIRS // max(1, len(self.prints)))
        for a in range(0, len(prints), step):
            both, _ = self.candidates(prints[a : a + step])
            i, j = both // len(self.prints) + a, both % len(self.prints)
            near = np.bitwise_count(prints[i] ^ self.prints[j]).sum(1) <= self.radius
            out.append(np.stack([i[near], j[near]]))
        i, j = np.concatenate(out, 1)
        return i, j


@dataclass
class Group:
    """The items of one length in words."""

    n: int
    k: int
    items: np.ndarray
    shingles: np.ndarray
    words: list[str]
    index: HammingIndex


def shingle_counter(words: list[str], k: int) -> Counter:
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least) if least else 0.0


def word_strings(cp: np.ndarray, begin: np.ndarray, end: np.ndarray, i: int, j: int) -> list[str]:
    return ["".join(map(chr, cp[a:b].tolist())) for a, b in zip(begin[i:j], end[i:j])]


def build(items: list[tuple[int, str]]) -> list[Group]:
    """Index items (id, text) by their length; those without a word are left out."""
    flat = Flat([t for _, t in items])
    cp, begin, end, h, doc = tokens(flat)
    at = np.searchsorted(doc, np.arange(len(items) + 1))
    by_n: dict[int, list[int]] = {}
    for i in range(len(items)):
        if at[i + 1] > at[i]:
            by_n.setdefault(int(at[i + 1] - at[i]), []).append(i)
    out = []
    for n, own in sorted(by_n.items()):
        k = min(SHINGLE, n)
        shingles = [windows(h[at[i] : at[i + 1]], k) for i in own]
        prints = fingerprints(np.stack([bit_rows(s).sum(0, dtype=np.int32) for s in shingles]))
        words = [" ".join(word_strings(cp, begin, end, at[i], at[i + 1])) for i in own]
        out.append(Group(n, k, np.array([items[i][0] for i in own]), np.unique(np.concatenate(shingles)), words, HammingIndex(prints)))
    return out


class Matcher:
    """Finds the items in blocks of texts."""

    def __init__(self, groups: list[Group], least: float = SIMILARITY):
        self.groups, self.least = groups, least
        self.counted: dict[tuple[int, int], Counter] = {}
        self.by_k: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in {g.k for g in groups}:
            known = np.unique(np.concatenate([g.shingles for g in groups if g.k == k]))
            table = np.zeros(1 << 20, bool)
            table[(known >> np.uint64(44)).astype(np.int64)] = True
            self.by_k[k] = known, table

    def match(self, texts: list[str]) -> list[tuple[int, int, float, int]]:
        """(text, item id, similarity, first word): the best window of each text and item, the first of equals."""
        return [x[:4] for x in self.found(texts)]

    def found(self, texts: list[str]) -> list[tuple[int, int, float, int, int]]:
        """What ``match`` returns, and the words of each window: the item's, or all of a text that has fewer."""
        flat = Flat(texts)
        cp, begin, end, h, doc = tokens(flat)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        last = np.searchsorted(doc, np.arange(flat.n), "right")
        first = np.searchsorted(doc, np.arange(flat.n))
        for k, (known, table) in self.by_k.items():
            shingles = windows(h, k)
            maybe = np.flatnonzero(table[(shingles >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, shingles[maybe]), len(known) - 1)
            hits = maybe[known[at] == shingles[maybe]]
            hits = hits[doc[hits] == doc[hits + k - 1]]
            if not len(hits):
                continue
            for g in self.groups:
                if g.k != k:
                    continue
                at = np.minimum(np.searchsorted(g.shingles, shingles[hits]), len(g.shingles) - 1)
                own = hits[g.shingles[at] == shingles[hits]]
                if not len(own):
                    continue
                # All windows of n words in the text that hold a shared shingle.
                a = np.maximum(own - (g.n - k), first[doc[own]])
                b = np.minimum(own, last[doc[own]] - g.n)
                fits = b >= a
                p = np.unique(ragged(a[fits], (b - a + 1)[fits]))
                for i in range(0, len(p), 4096):
                    self._windows(g, g.n, p[i : i + 4096], shingles, cp, begin, end, doc, best)
                # A text of fewer than n words is one window, unless it is too short for the similarity.
                short = np.unique(doc[own[~fits]])
                words = last[short] - first[short]
                for n in np.unique(words[words - k + 1 >= self.least * (g.n - k + 1)]).tolist():
                    p = first[short[words == n]]
                    for i in range(0, len(p), 4096):
                        self._windows(g, n, p[i : i + 4096], shingles, cp, begin, end, doc, best)
        return [(d, item, s, w - int(first[d]), n) for (d, item), (s, w, n) in sorted(best.items())]

    def counter(self, g: Group, item: int) -> Counter:
        """An item's shingles, counted when a window comes near it."""
        got = self.counted.get((g.n, item))
        if got is None:
            if len(self.counted) >= COUNTED:
                self.counted.clear()
            got = self.counted[g.n, item] = shingle_counter(g.words[item].split(" "), g.k)
        return got

    def _windows(self, g: Group, n: int, p, shingles, cp, begin, end, doc, best) -> None:
        if not len(p):
            return
        w = n - g.k + 1
        # Shingle places of all windows, each once; a window's are neighbours among them.
        cover = np.unique(np.concatenate([p + j for j in range(w)])) if w < 64 else np.unique(ragged(p, np.full(len(p), w)))
        at = np.searchsorted(cover, p)
        sums = np.zeros((len(cover) + 1, BITS), np.int32)
        np.cumsum(bit_rows(shingles[cover]), axis=0, dtype=np.int32, out=sums[1:])
        i, j = g.index.query(fingerprints(sums[at + w] - sums[at]))
        counted: dict[int, Counter] = {}
        for x, y in zip(i.tolist(), j.tolist()):
            q = int(p[x])
            if q not in counted:
                counted[q] = shingle_counter(word_strings(cp, begin, end, q, q + n), g.k)
            s = similarity(counted[q], self.counter(g, y))
            key = int(doc[q]), int(g.items[y])
            if s >= self.least and s > best.get(key, (0.0, 0, 0))[0]:
                best[key] = s, q, n


def item_blocks(benchmark: DataFrame, item: str, text: str, most: int, nulls: bool = False):
    """Lists of (id, text) of at most ``most`` words each (or one item); items without an id are left out, or with ``nulls`` get the id -1."""
    rows = benchmark.select(F.col(item).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = (rows.withColumn("i", F.coalesce("i", F.lit(-1))) if nulls else rows.where(F.col("i").isNotNull())).orderBy("i", "t")
    block, words = [], 0
    for r in rows.toLocalIterator():
        n = len(r["t"].split()) + 1
        if block and words + n > most:
            yield block
            block, words = [], 0
        block.append((r["i"], r["t"]))
        words += n
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", most: int = ITEM_WORDS) -> DataFrame:
    """(doc, item, similarity, first_word, n_words) for every row of ``docs`` and item found in it.

    One row for each pair, of its best window; ``n_words`` are the window's, which are the
    item's or, of a text with fewer, all of the text's.  Null and empty texts match nothing, nor
    do items without a word; items of fewer than five words are one shingle.  Repeated
    documents are matched one by one; of items that repeat an id, each pair has the best.
    An item without an id can't be named and gives no row here; ``clean`` heeds it.
    Empty tables give no rows.
    """
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = f"`{doc}` {types[doc]}, `{item}` bigint, similarity double, first_word bigint, n_words bigint"
    out = None
    for block in item_blocks(benchmark, item, text, most):
        out_block = _pass(docs, block, doc, text, item, schema)
        out = out_block if out is None else out.unionByName(out_block)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _pass(docs: DataFrame, block: list[tuple[int, str]], doc: str, text: str, item: str, schema: str) -> DataFrame:
    groups = build(block)
    if not groups:
        return docs.sparkSession.createDataFrame([], schema)
    shared = docs.sparkSession.sparkContext.broadcast(groups)

    def make():
        matcher = Matcher(shared.value)

        def work(texts: list[str]) -> dict[str, object]:
            got = matcher.found(texts)
            return {
                ROW: [x[0] for x in got],
                item: [x[1] for x in got],
                "similarity": [x[2] for x in got],
                "first_word": [x[3] for x in got],
                "n_words": [x[4] for x in got],
            }

        return work

    return map_texts(docs, [doc], text, schema, make)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", most: int = ITEM_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark item was found, whether or not it has an id.

    Null and empty texts hold no item and stay; whole texts are read.  Repeated rows all
    stay or all go; empty tables leave everything as it is.
    """
    out = docs
    for block in item_blocks(benchmark, item, text, most, nulls=True):
        groups = build(block)
        if groups:
            out = _without(out, groups, text)
    return out


def _without(docs: DataFrame, groups: list[Group], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(groups)

    def make():
        matcher = Matcher(shared.value)

        def work(texts: list[str]) -> dict[str, object]:
            found = {x[0] for x in matcher.match(texts)}
            return {ROW: [i for i in range(len(texts)) if i not in found]}

        return work

    return map_texts(docs, docs.columns, text, docs.schema, make)
