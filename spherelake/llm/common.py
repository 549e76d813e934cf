"""What the operators share: tables, lineage cuts, row keys, Arrow batches of texts."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spherelake.session import cut, ship

#: Texts are handled in blocks of so many characters, which bounds the arrays made from them.
BLOCK_CHARS = 1_000_000
ROW = "\0row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Fewer rows, and bytes, in an Arrow batch than Spark's default, as a row holds a whole text.

    Both settings are the session's, are only ever lowered, and change no result.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def release() -> None:
    """Give freed memory back to the system: a Python worker waits for its next task with what its last one freed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not a GNU system
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a task's batches, and ``release`` at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


@contextlib.contextmanager
def planned_once(spark: SparkSession) -> Iterator[None]:
    """Without adaptive re-planning, for small rounds of an iteration that are run at once.

    Re-planning after every stage of every round costs the driver more than the rounds
    themselves do; their keys are salted, so they need no skew handling.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 5; 0 marks held-out rows.  A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def blocks(texts: list[str | None], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` of at most ``most`` characters each, or one text."""
    begin = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(texts):
        yield begin, len(texts)


def schema_with(df: DataFrame, keep: list[str] | tuple[str, ...], added: str) -> tuple[list[str], str]:
    """The kept columns, less those whose names the added ones take, and the schema of both."""
    taken = {part.split()[0].strip("`").lower() for part in added.split(",")}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kept = [c for c in keep if c.lower() not in taken]
    return kept, ", ".join([*(f"`{c}` {types[c]}" for c in kept), added])


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    schema: str,
    make: Callable[[], Callable[[list[str]], dict[str, object]]],
    most: int = BLOCK_CHARS,
) -> DataFrame:
    """Run a function over blocks of texts in Arrow batches.

    ``make()`` is called once a task and returns the function, which takes a list of
    texts (null: empty) and returns columns with a value for each text.  If one of them
    is named ``ROW``, it says which text each value belongs to, and there may be any
    number of values.  ``schema`` names ``keep``, then those columns.
    """
    from pyspark.sql.types import StructType

    spark = df.sparkSession
    ship(spark)
    small_batches(spark)
    picked = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    out_type = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    assert isinstance(out_type, StructType)
    arrow = [_arrow_field(f) for f in out_type.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for a, b in blocks(texts, most):
                made = work([t or "" for t in texts[a:b]])
                columns = []
                rows = made.pop(ROW, None)
                for field in arrow:
                    if field.name in made:
                        x = made[field.name]
                        columns.append(x.cast(field.type) if isinstance(x, pa.Array) else pa.array(x, field.type, from_pandas=False))
                    else:
                        kept = batch.column(field.name).slice(a, b - a)
                        columns.append(kept if rows is None else kept.take(pa.array(rows, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in arrow])

    return picked.mapInArrow(released(run), out_type)


def _arrow_field(field) -> pa.Field:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.field(field.name, to_arrow_type(field.dataType))


__all__ = ["BLOCK_CHARS", "ROW", "blocks", "cut", "fold", "map_texts", "planned_once", "release", "released", "schema_with", "small_batches", "table"]
