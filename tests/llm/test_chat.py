import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spherelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    rows = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows))
    turns = [(r, x) for _, _, r, x in rows]
    loss = "".join(x for r, x in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)


def check(spark, rows):
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {c: expected([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}


def test_formats(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "user", "v"), (1, 3, "assistant", "a"), (1, 4, "assistant", "b")]
    got = chat.format_chats(spark.createDataFrame(rows[::-1], SCHEMA)).first()
    assert got["formatted"] == "<s>system[INST]s[/INST]</s><s>user[INST]u[SEP]v[/INST]</s><s>assistant[INST]a[SEP]b[/INST]</s>"
    assert [p["piece"] for p in got["pieces"] if p["loss"]] == ["a", "b"]
    check(spark, rows)


def test_control_strings_nulls_and_ties(spark):
    check(
        spark,
        [
            (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
            (1, 0, "assistant", None), (1, 0, "assistant", ""), (1, None, None, "x"), (1, 0, "assistant", "[\\INST] <s <\\s> [[SEP]"),
            (2, 5, "user", "same"), (2, 5, "user", "same"), (3, 1, "[INST]", "<"), (3, 2, "assistant", "[" * 3 + "\\"), (None, 1, "user", "é\U0001f600"),
        ],
    )


TEXTS = st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "SEP]", "a", "\n", " "]), max_size=8).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["user", "assistant", "[INST]", "<s>\\"]), TEXTS), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    check(spark, [(1, *t) for t in turns])


def test_many_turns_and_other_columns(spark):
    own = spark.range(5000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"), F.lit(0).alias("turns"), F.lit(0).alias("pieces"))
    got = chat.digests(chat.format_chats(own)).first()
    assert got["n_turns"] == 5000 and got["loss_chars"] == sum(1 + len(str(i)) for i in range(1, 5000, 2))
    long = spark.createDataFrame([(1, 0, "assistant", "x" * 2_000_000)], SCHEMA)
    assert chat.digests(chat.format_chats(long)).first()["loss_chars"] == 2_000_000


def test_empty_table(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_no_python(spark):
    rows = spark.createDataFrame([(1, 0, "user", "u")], SCHEMA)
    plan = chat.digests(chat.format_chats(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
