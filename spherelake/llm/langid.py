"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed character n-grams over lower-cased letters,
scaled to unit length.  Document frequencies are counted over every learning row.  The
centroids are fitted on a bounded sample (``SAMPLE`` rows a language) by spherical
k-means, ``CENTROIDS`` for each language.  A text gets the language of the centroid of
the largest cosine; it is rejected if that cosine is below a floor, which depends on
the text's length and is set from the sample: short texts are far from any centroid.
A length of which the sample has few texts gets its floor from pieces of that length,
cut out of the sampled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherelake.llm.common import ROW, blocks, cut as cut_lineage, fold, map_texts, released, schema_with, ship, small_batches
from spherelake.llm.flat import Flat, letter_table, look, lowered
from spherelake.llm.hashed import char_rows, pack, unpack

#: Rows of each language used for the centroids, at most; and centroids of each language.
SAMPLE, CENTROIDS = 600, 4
#: Up to so many languages their counts are broadcast; more are joined by a shuffle.
FEW_LANGUAGES = 10_000
SIZES, BITS = (1, 2, 3), 12
#: Texts of fewer letters than these are groups with floors of their own.
LENGTHS = (10, 20, 40, 80, 160, 320)
#: A floor is this part of the cosine that all but QUANTILE of the group's sample exceed.
SLACK, QUANTILE = 0.5, 0.005
#: A group of fewer sampled texts than these takes its floor from pieces too.
FEW = 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """idf by bucket; centroids as rows of unit length with their languages; floors by length group."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: tuple[str, ...]
    floors: np.ndarray


def letters_of(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points with all but letters as spaces; positions that only repeat a space; letters by text."""
    letter = look(letter_table(), flat.cp)
    cp = np.where(letter, lowered(flat.cp), np.uint32(32))
    blank = ~letter
    again = blank.copy()
    again[1:] &= blank[:-1]
    total = np.concatenate([[0], np.cumsum(letter)])
    return cp, again, total[flat.to] - total[flat.at]


def pieces_of(text: str) -> list[str]:
    """For each length group a piece with the least letters of that group, from a word's begin amid the text; empty if the text has fewer."""
    at = [i for i, c in enumerate(text) if c.isalpha()]
    begins = [k for k, i in enumerate(at) if k == 0 or at[k - 1] < i - 1]
    out = []
    for n in (1, *LENGTHS):
        fit_in = [k for k in begins if k + n <= len(at)]
        k = fit_in[len(fit_in) // 2] if fit_in else 0
        out.append(text[at[k] : at[k + n - 1] + 1] if fit_in else "")
    return out


def counted(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, n-gram counts, letters) for groups of texts."""
    flat = Flat(texts)
    cp, again, letters = letters_of(flat)
    for a, b, rows in char_rows(flat, SIZES, BITS, cp, again):
        yield a, b, rows, letters[a:b]


def unit(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(rows) * idf).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are; one row a bucket reaches the driver."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in blocks(texts):
                for _, _, rows, _ in counted(texts[a:b]):
                    total[:-1] += (rows > 0).sum(0)
                    total[-1] += len(rows)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], schema=schema)

    summed = docs.select("text").mapInArrow(released(run), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in summed:
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from spread-out beginnings; deterministic.  Empty clusters are dropped."""
    at = [0]
    near = x @ x[0]
    while len(at) < min(k, len(x)):
        at.append(int(near.argmin()))
        near = np.maximum(near, x @ x[at[-1]])
    c = x[at]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        rows = [x[own == j].sum(0) for j in range(len(c)) if (own == j).any()]
        c = np.stack(rows)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(docs: DataFrame, most: int = SAMPLE, centroids: int = CENTROIDS) -> Model | None:
    """Learn from rows with text and lang whose fold isn't held out; None if there are none.

    Every language of those rows is learned; each adds ``centroids`` rows of 16 KB to the model.
    """
    learn = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    df, n = frequencies(learn)
    if n == 0:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    # The first ids of each language by a hash.  Ids whose hash is far beyond the last of them are left
    # out beforehand, so that a language's rows that meet are a few times ``most``, however many it has.
    count = cut_lineage(learn.groupBy("lang").agg(F.count(F.lit(1)).alias("of")))
    count = F.broadcast(count) if count.count() <= FEW_LANGUAGES else count
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    likely = learn.select("lang", F.col("doc_id").alias("id"), rank.alias("h")).join(count, "lang").where(F.col("h") * F.col("of") < 3 * most)
    order = Window.partitionBy("lang").orderBy("h", "id")
    ids = likely.select("lang", "id", "h").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("lang", "id")
    texts = learn.select("lang", F.col("doc_id").alias("id"), "text").join(F.broadcast(ids), ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            x, letters = [], []
            for _, _, rows, n in counted(texts):
                x += pack(rows)
                letters += n.tolist()
            return {"x": x, "letters": letters, "pieces": [pieces_of(t) for t in texts]}

        return work

    got = sorted(map_texts(texts, ["lang", "id"], "text", "lang string, id bigint, x binary, letters bigint, pieces array<string>", make).collect(), key=lambda r: (r["lang"], r["id"]))
    got = [r for r in got if r["letters"] > 0]
    if not got:
        return None
    group = np.searchsorted(LENGTHS, [r["letters"] for r in got], "right")
    few = [g for g in range(len(LENGTHS) + 1) if (group == g).sum() < FEW]
    rows, langs, best = [], [], []
    cut: list[list[float]] = [[] for _ in range(len(LENGTHS) + 1)]
    for lang in dict.fromkeys(r["lang"] for r in got):
        own = [r for r in got if r["lang"] == lang]
        x = unit(np.stack([unpack(bytes(r["x"]), 1 << BITS) for r in own]), idf)
        c = k_means(x, centroids)
        rows.append(c)
        langs += [lang] * len(c)
        best.append((x @ c.T).max(1))
        for g in few:
            for _, _, own_rows, _ in counted([r["pieces"][g] for r in own if r["pieces"][g]]):
                cut[g] += (unit(own_rows, idf) @ c.T).max(1).tolist()
    best = np.concatenate(best)
    floors = np.full(len(LENGTHS) + 1, np.nan)
    for g in range(len(floors)):
        near = np.concatenate([best[group == g], cut[g]])
        if len(near):
            floors[g] = SLACK * np.quantile(near, QUANTILE)
        else:  # longer than all texts of the sample, as pieces of those fill the shorter groups
            floors[g] = floors[g - 1]
    # A shorter group is never stricter than a longer one.
    for g in range(len(floors) - 2, -1, -1):
        floors[g] = min(floors[g], floors[g + 1])
    return Model(idf, np.concatenate(rows), tuple(langs), floors)


def classify(model: Model | None, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
    """Languages, cosines, and whether each text is rejected."""
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    langs: list[str] = []
    scores: list[float] = []
    rejected: list[bool] = []
    for _, _, rows, letters in counted(texts):
        cosine = np.clip(unit(rows, model.idf) @ model.centroids.T, 0, 1).astype(float)
        at = cosine.argmax(1)
        best = np.where(letters > 0, cosine[np.arange(len(at)), at], 0.0)
        floor = model.floors[np.searchsorted(LENGTHS, letters, "right")]
        langs += [model.langs[i] if n else UNKNOWN for i, n in zip(at, letters)]
        scores += best.tolist()
        rejected += ((letters == 0) | (best < floor)).tolist()
    return langs, scores, rejected


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected`` for every row.

    A text that is null or has no letter is ``und`` with score 0, and rejected.  Ties go
    to the first language by name.  Without anything learned every text is ``und``.
    Repeated rows each give a row, an empty table none.
    """
    kept, schema = schema_with(docs, keep, "lang_pred string, score double, rejected boolean")
    def make():
        def work(texts: list[str]) -> dict[str, object]:
            langs, scores, rejected = classify(model, texts)
            return {"lang_pred": langs, "score": scores, "rejected": rejected}

        return work

    return map_texts(docs, kept, text, schema, make)


def accepted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text isn't rejected.

    Null texts and those without a letter are rejected; without a model all are.  Whole
    texts are read.  Repeated rows all stay or all go, and an empty table stays empty.
    """

    def make():
        return lambda texts: {ROW: [i for i, no in enumerate(classify(model, texts)[2]) if not no]}

    return map_texts(docs, docs.columns, text, docs.schema, make)
