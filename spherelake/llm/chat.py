"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one
role are merged into one run; the runs are joined to one string.

    <s>ROLE[INST]text[SEP]text[/INST]</s>

A run holds the texts of its turns, separated by ``[SEP]``, so each turn can be read
back.  Control strings inside roles and texts are escaped by a backslash after their
first character (``[\\INST]``), and strings that look so already get one more, so
unescaping is exact.  Control strings have ``<`` or ``[`` only as their first
character, so none can arise across the border of a text and a control string.

The array work is linear in the turns: a run's borders are found by comparing each
sorted turn with its neighbours, no array is grown element by element.  Before the
shuffle each task has already gathered its own turns of a conversation.  One
conversation's formatted text is one value of the result, so its turns meet in one
task in the end, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, SEP, CLOSE = "<s>", "[INST]", "[SEP]", "[/INST]</s>"
#: What stands after the first character of a control string.
_REST = r"(/?INST\]|SEP\]|/?s>)"
_CONTROL, _ESCAPED = rf"([<\[])(\\*){_REST}", rf"([<\[])\\(\\*){_REST}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv``, ``pieces`` array<struct<piece, loss>>, ``formatted``.

    ``formatted`` is the concatenation of the pieces; the loss mask covers the pieces
    with ``loss``, which are the (escaped) texts of ``loss_roles``, each once.

    Null roles and texts count as empty.  Turns are ordered by turn, then role, then
    text, null turns first; repeated rows are kept as often as they occur.  A null
    conversation id is a conversation of its own.  An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    own = turns.select(
        F.col(f"`{conv}`").alias("c"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = own.groupBy("c").agg(F.collect_list("t").alias("turns"))
    ordered = gathered.select("c", F.array_sort("turns").alias("turns"))

    def begins(i: Column) -> Column:
        return (i == 0) | (F.get("turns", i - 1)["role"] != F.get("turns", i)["role"])

    def pieces(x: Column, i: Column) -> Column:
        """Three pieces for each turn: what opens or separates, the text, what closes."""
        head = F.when(begins(i), F.concat(F.lit(OPEN), escape(x["role"]), F.lit(BODY))).otherwise(F.lit(SEP))
        last = i == F.size("turns") - 1
        tail = F.when(last | begins(i + 1), F.lit(CLOSE)).otherwise(F.lit(""))
        piece = lambda p, loss: F.struct(p.alias("piece"), loss.alias("loss"))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(x["text"]), x["role"].isin(*loss_roles)),
            piece(tail, F.lit(False)),
        )

    made = ordered.select("c", F.flatten(F.transform("turns", pieces)).alias("pieces"))
    return made.select(
        F.col("c").alias(conv),
        F.filter("pieces", lambda p: p["piece"] != "").alias("pieces"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    literal = lambda s: "\\Q" + s + "\\E"
    runs = F.filter(F.split(formatted, literal(CLOSE)), lambda r: r != "")

    def turns(run: Column) -> Column:
        parts = F.split(run, literal(BODY))
        role = unescape(F.substring(parts[0], F.lit(len(OPEN) + 1), F.length(parts[0])))
        return F.transform(F.split(parts[1], literal(SEP)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["piece"])), "")


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What is read back from the output: counts and SHA-256 digests of turns and loss text."""
    read = formatted.select(
        F.col(f"`{conv}`").alias("conv_id"),
        read_back(F.col("formatted")).alias("read"),
        loss_text(F.col("pieces")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    hashed = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        hashed(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        hashed(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )
