"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.llm import chat, decontaminate, html, jaccard, langid, lines, pieces, quality, rules, secrets
from spherelake.llm.common import fold, table

#: The text of conversation -7, which holds the template's own control strings.
PROBE = "</s>[INST] ok [/INST]"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.digests(chat.format_chats(rows.unionByName(probe)))


#: The lengths of the control strings: <s> [INST] for a run's begin, [/INST]</s> for its end, [SEP].
OP2_SQL = r"""
WITH own AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), near AS (
    SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 AS joined,
        regexp_replace(text, '([<\[])(\\*)(/?INST\]|SEP\]|/?s>)', '\1\\\2\3', 'g') AS escaped,
        regexp_replace(role, '([<\[])(\\*)(/?INST\]|SEP\]|/?s>)', '\1\\\2\3', 'g') AS marked
    FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(escaped) + CASE WHEN joined THEN 5 ELSE 20 + length(marked) END)::BIGINT AS formatted_chars
FROM near GROUP BY conv_id
"""

def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.Pieces.load()
    made = pieces.encode(table(spark, sf_dir, "documents"), model, keep=("doc_id", "text"), n=2, decoded="decoded")
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.get("scores", F.lit(0)).alias("score"),
        F.get("scores", F.lit(1)).alias("second_score"),
        F.xxhash64("ids").alias("ids_hash"),
        F.xxhash64(F.get("others", F.lit(0))).alias("second_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Chunk borders by the same rolling hash; groups of equal chunk texts; all but the first go.
OP5_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS hv FROM l),
r AS (SELECT *, (31 * hv + coalesce(lag(hv) OVER w, 0)) % 3 = 0 AS ends FROM h WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r),
k AS (SELECT doc_id, text, chunk, min(i) AS place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, text, chunk),
f AS (SELECT doc_id, text, chunk, n >= 2 AND row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS FIRST, text, place) > 1 AS gone FROM k),
j AS (
    SELECT c.doc_id, c.text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
    FROM c JOIN f ON c.doc_id IS NOT DISTINCT FROM f.doc_id AND c.text = f.text AND c.chunk = f.chunk GROUP BY c.doc_id, c.text
)
SELECT o.doc_id, kept AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents o LEFT JOIN j ON o.doc_id IS NOT DISTINCT FROM j.doc_id AND o.text = j.text
"""


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = langid.predict(docs, langid.fit(docs))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.score(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_chat_format": op2_chat_format,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_html_extract": op8_html_extract,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
}
_SQL: dict[str, str] = {"op2_chat_format": OP2_SQL, "op5_line_dedup": OP5_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
