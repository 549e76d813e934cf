"""A corpus pipeline of five stages over ``documents``.

1. Language ID: documents that it rejects go.
2. Line dedup: repeated multi-line chunks are cut from the texts; no document goes.
3. N-gram Jaccard join: one document of each class of near copies stays.
4. Decontamination: documents that hold a benchmark item go.
5. SentencePiece: the rest is encoded, and decoded again from its ids.

Every stage takes (spark, docs, sf_dir) and learns from what it is given; all but the
last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.llm import decontaminate, jaccard, langid, lines, pieces
from spherelake.llm.common import cut, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is accepted; the languages are learned from ``docs``.

    Null texts and those without a letter go, and all go if nothing can be learned.
    Repeated rows all stay or all go; whole texts are read; an empty table stays empty.
    """
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated chunks of lines cut from their texts and ``n_chars`` counted anew.

    A null text stays null and one that is cut altogether becomes empty; rows that agree in
    id and text get the same result.
    """
    made = lines.dedup_lines(docs, counts=False)
    return made.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else made


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the first by id; of repeated rows one.

    Documents without a word are no copies of each other and all stay.
    """
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found; items without an id count too.

    Null and empty texts stay; whole texts are read; without items all documents stay.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_pieces, score, second_score and text, decoded from the ids.

    A null text has no ids and decodes to an empty one; repeated rows each give a row.
    """
    made = pieces.encode(docs, pieces.Pieces.load(), keep=("doc_id", "lang", "source"), n=2, decoded="text")
    return made.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.get("scores", F.lit(0)).alias("score"),
        F.get("scores", F.lit(1)).alias("second_score"),
        "text",
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Classifiers, SimHash and the lattice search have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
