"""N-gram Jaccard self-join by chosen paths.

A document is the set of its 5-word shingles; two documents are linked if the Jaccard
similarity of their sets is at least 0.8.

1. Every set is embedded as the T tokens (coordinate, least hash of the set under that
   coordinate's hash function); two sets share a token with a probability equal to
   their similarity.  Equal sets are one node from here on.
2. Chosen paths: in each of RUNS runs every set follows a tree.  A node of the tree
   samples CHILDREN coordinates by a hash of the path to it, and a set goes on to the
   child that its token in that coordinate names.  Nodes of at most SMALL sets are
   compared by brute force on their tokens; larger ones split again, at most DEPTH
   times.  A large child that holds half of its parent or more is dense: its sets agree
   on a token that was drawn by chance, so splitting doesn't part them.  Its sets, and
   those of nodes that are still large at DEPTH, are linked to the least of them.  A
   pair at the threshold survives a run with a probability of ``survival``;
   ``runs_for`` gives the runs that the target recall needs.
3. The links found make candidate groups (connected components), which only have to
   hold every true link.  Inside a group similarity is computed exactly for all pairs,
   by products of blocks of the sets' incidence matrices: groups of more than TILE sets
   are cut into blocks, and each pair of blocks is a tile of its own, so neither a task
   nor the driver ever holds a group, and no pair becomes a row.  A tile gives each set
   its number of links and the root of its linked neighbours.
4. The exact links' components are the classes.

Work on a group of many similar but different texts grows with the square of its size
over TILE; its links are counted, not listed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherelake.llm.common import blocks as text_blocks, cut, map_texts, released, ship, small_batches
from spherelake.llm.flat import Flat, mix, windows
from spherelake.llm.graph import components

SHINGLE = 5
#: The threshold as a fraction, so that comparisons are exact.
NUMERATOR, DENOMINATOR = 4, 5
#: Tokens of the embedding; children of a tree node; levels; sets that are compared by brute force.
T, CHILDREN, DEPTH, SMALL = 64, 2, 4, 128
RECALL = 0.999
#: Sets whose tokens agree in this share are candidates: three to four deviations below the threshold.
MARGIN = 0.6
#: Sets, and words, of a block of a group.
TILE, TILE_WORDS = 1024, 300_000
SALTS = 16
#: Rows of a matrix that are worked on at once, and characters of texts: smaller than elsewhere, as tiles are held beside them.
STRIP, CHARS = 128, 250_000


def survival(threshold: float = NUMERATOR / DENOMINATOR, children: int = CHILDREN, depth: int = DEPTH) -> float:
    """The chance that a pair at the threshold shares some path of full depth in a run."""
    s = 1.0
    for _ in range(depth):
        s = 1 - (1 - threshold * s) ** children
    return s


def runs_for(recall: float = RECALL) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival())))


def shingles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle, ordered; fewer than five words are one shingle."""
    flat = Flat(texts)
    begin, end = flat.words()
    doc = flat.doc_of(begin)
    h = flat.spans(flat.prefix(), begin, end)
    w = windows(h, SHINGLE)
    at = np.flatnonzero(doc[: len(w)] == doc[SHINGLE - 1 :][: len(w)]) if len(w) else np.zeros(0, np.int64)
    owner, value = doc[at], w[at]
    n = np.bincount(doc, minlength=flat.n)
    for k in range(1, SHINGLE):
        few = np.flatnonzero(n == k)
        if len(few):
            first = np.searchsorted(doc, few)
            owner = np.concatenate([owner, few])
            value = np.concatenate([value, windows(h, k)[first] + np.uint64(k)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


_COORDINATES = mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def embed(texts: list[str]) -> dict[str, object]:
    """Set keys (128 bits), sizes and tokens of texts; a text without words has no tokens."""
    owner, value = shingles_of(texts)
    n = len(texts)
    size = np.bincount(owner, minlength=n)
    has = np.flatnonzero(size)
    begin = np.searchsorted(owner, has)
    keys = np.zeros((2, n), np.uint64)
    tokens = np.zeros((len(has), T), np.uint32)
    if len(has):
        keys[0, has] = np.add.reduceat(mix(value + np.uint64(1)), begin)
        keys[1, has] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), begin)
        for i in range(T):
            v = value * _COORDINATES[i]
            v ^= v >> np.uint64(31)
            tokens[:, i] = np.minimum.reduceat((v * _COORDINATES[T - 1 - i]) >> np.uint64(32), begin)
    sketch: list[bytes] = [b""] * n
    for i, row in zip(has.tolist(), tokens):
        sketch[i] = row.tobytes()
    return {"s1": keys[0].view(np.int64), "s2": keys[1].view(np.int64), "n": size.astype(np.int32), "sketch": sketch}


def children_of(path: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The paths of a set's children at a node: one row a set, CHILDREN columns."""
    out = np.zeros((len(path), CHILDREN), np.uint64)
    draw = mix(path + np.uint64(0x632BE59BD9B4E019))
    first = (draw % np.uint64(T)).astype(np.int64)
    for c in range(CHILDREN):
        step = (draw >> np.uint64(8 + 8 * c)) % np.uint64((T - 1) // CHILDREN) if c else np.uint64(0)
        at = (first + (c * ((T - 1) // CHILDREN) + step.astype(np.int64) + 1 if c else 0)) % T
        token = tokens[np.arange(len(path)), at].astype(np.uint64) | (at.astype(np.uint64) << np.uint64(32))
        out[:, c] = mix(path ^ mix(token + np.uint64(0x2545F4914F6CDD1D)))
    return out


def _met(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join without a broadcast: both sides grow with the documents."""
    return left.join(right.hint("merge"), keys)


def _python(df: DataFrame, schema: str, run: Callable) -> DataFrame:
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(released(run), schema)


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, T)


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _step(df: DataFrame, roots: int = 0) -> DataFrame:
    """(path, id, of) of the children; from the roots of so many runs, or from columns path and n.

    ``of`` is the number of sets at the parent, 0 for a root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tokens, ids = _tokens(b.column("sketch")), _longs(b.column("id"))
            if roots:
                starts = [np.full(len(ids), mix(np.array([r + 1], np.uint64))[0]) for r in range(roots)]
                of = np.zeros(len(ids), np.int64)
            else:
                starts = [_longs(b.column("path")).view(np.uint64)]
                of = _longs(b.column("n"))
            paths = np.concatenate([children_of(s, tokens) for s in starts], 1)
            each = paths.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(paths.ravel().view(np.int64)), pa.array(np.repeat(ids, each)), pa.array(np.repeat(of, each))], ["path", "id", "of"])

    return _python(df, "path bigint, id bigint, of bigint", run)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, whole across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [_longs(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def roots_of(adjacent: np.ndarray) -> np.ndarray:
    """The least member of each member's component in a symmetric boolean matrix with a true diagonal."""
    n = len(adjacent)
    root = np.arange(n)
    while True:
        least = np.concatenate([np.where(adjacent[a : a + STRIP], root, n).min(1) for a in range(0, n, STRIP)])
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root
        root = least


def _brute_force(rows: DataFrame) -> DataFrame:
    """Candidate links (a, b) in small nodes: each set to the root of those it resembles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []
        size = 0
        for g in grouped(batches, ["path"]):
            g = g.combine_chunks()
            ids, tokens = g.column("id").to_numpy(), _tokens(g.column("sketch"))
            same = (tokens[:, None, :] == tokens[None, :, :]).sum(2, dtype=np.int16)
            root = roots_of(same >= MARGIN * T)
            linked = root != np.arange(len(root))
            out_a.append(ids[linked])
            out_b.append(ids[root[linked]])
            size += int(linked.sum())
            if size >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
                out_a, out_b, size = [], [], 0
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    parts = rows.repartition("path").sortWithinPartitions("path", "id")
    return _python(parts, "a bigint, b bigint", run)


def candidate_links(sets: DataFrame, recall: float = RECALL) -> DataFrame:
    """Candidate links (a, b) between sets (id, sketch), by chosen paths."""
    lean = sets.select("id", "sketch")
    level = _step(lean, roots=runs_for(recall))
    found: list[DataFrame] = []
    for depth in range(1, DEPTH + 1):
        # Counted by node and salt first, so a node's rows are few when they are summed and many keys when they join.
        salted = level.withColumn("salt", F.pmod(F.col("id"), F.lit(SALTS)).cast("int"))
        part = salted.groupBy("path", "salt").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
        node = Window.partitionBy("path")
        whole = part.select("path", "salt", F.sum("n").over(node).alias("n"), F.min("least").over(node).alias("least")).where("n > 1")
        met = cut(_met(salted, whole, ["path", "salt"]).select("path", "id", "n", "least", "of"))
        links = _brute_force(_met(met.where(F.col("n") <= SMALL).select("path", "id"), lean, ["id"]))
        large = met.where(F.col("n") > SMALL)
        last = depth == DEPTH or large.isEmpty()
        dense = (2 * F.col("n") >= F.col("of")) & (F.col("of") > 0) if depth < DEPTH else F.lit(True)
        if depth > 1:
            links = links.unionByName(large.where(dense & (F.col("id") != F.col("least"))).select(F.col("id").alias("a"), F.col("least").alias("b")))
        # Level by level, so that no plan holds them all.
        found.append(cut(links.distinct()))
        if last:
            break
        level = _step(_met(large.where(~dense).select("path", "id", "n"), lean, ["id"]))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def exact_links(owner: np.ndarray, value: np.ndarray, rows: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the sets ``left`` are linked to which of ``right``, by exact similarity."""
    size = np.bincount(owner, minlength=rows).astype(np.float32)
    _, inverse, count = np.unique(value, return_inverse=True, return_counts=True)
    # A shingle in one set alone is in no intersection.
    shared = count[inverse] > 1
    place = np.cumsum(count > 1) - 1
    column, row = place[inverse[shared]], owner[shared]
    width = int((count > 1).sum())
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    step = 512
    for c in range(0, width, step):
        a, b = np.searchsorted(column, [c, c + step])
        part = np.zeros((rows, min(step, width - c)), np.float32)
        part[row[a:b], column[a:b] - c] = 1
        both += part[left] @ part[right].T
    # J >= p / q  <=>  (p + q) * both >= p * (size + size): integers, exact in double precision.
    linked = np.zeros(both.shape, bool)
    for a in range(0, len(left), STRIP):
        part = both[a : a + STRIP].astype(np.float64)
        total = size[left[a : a + STRIP]][:, None].astype(np.float64) + size[right][None, :]
        linked[a : a + STRIP] = (part > 0) & ((NUMERATOR + DENOMINATOR) * part >= NUMERATOR * total)
    return linked


def _tiles(rows: DataFrame) -> DataFrame:
    """(id, links, root, whole) for each set of each tile (g, i, j): its links there, weighted by copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, ["g", "i", "j"]):
            ids, block, copies = (g.column(c).to_numpy() for c in ("id", "block", "copies"))
            i, j, blocks = g.column("i")[0].as_py(), g.column("j")[0].as_py(), g.column("blocks")[0].as_py()
            texts = g.column("text").to_pylist()
            parts = [(a, shingles_of(texts[a:b])) for a, b in text_blocks(texts, CHARS)]
            owner, value = np.concatenate([a + x for a, (x, _) in parts]), np.concatenate([x for _, (_, x) in parts])
            del texts, parts
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            linked = exact_links(owner, value, len(ids), left, right)
            adjacent = np.eye(len(ids), dtype=bool)
            adjacent[np.ix_(left, right)] |= linked
            adjacent[np.ix_(right, left)] |= linked.T
            links = np.concatenate([adjacent[a : a + STRIP].astype(np.float64) @ copies for a in range(0, len(ids), STRIP)]) - copies
            # Rows are sorted by id, so the root is the least id too.
            root = roots_of(adjacent)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(ids[root]), pa.array(np.full(len(ids), blocks == 1))], ["id", "links", "root", "whole"])

    parts = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "id")
    return _python(parts, "id bigint, links bigint, root bigint, whole boolean", run)


class Joined:
    """The result of a join.

    ``rows``: doc_id, r1, r2 (the row's key), s1, s2 (the set's key), n (shingles).
    ``sets``: id, s1, s2, copies, least (document id), first (struct of the first row's doc_id, r1, r2).
    ``classes``: id, root, links; only sets that have a link to another.
    """

    def __init__(self, rows: DataFrame, sets: DataFrame, classes: DataFrame):
        self.rows, self.sets, self.classes = rows, sets, classes


def row_key(doc: str, text: str) -> list:
    columns = F.col(f"`{doc}`"), F.col(f"`{text}`")
    return [F.xxhash64(*columns).alias("r1"), F.xxhash64(F.lit("r"), *columns).alias("r2")]


def join(docs: DataFrame, doc: str = "doc_id", text: str = "text", recall: float = RECALL) -> Joined:
    own = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), *row_key(doc, text))
    types = dict(own.dtypes)
    schema = f"doc_id {types['doc_id']}, r1 bigint, r2 bigint, s1 bigint, s2 bigint, n int, sketch binary"
    embedded = cut(map_texts(own, ["doc_id", "r1", "r2"], "text", schema, lambda: embed, CHARS))
    rows = embedded.select("doc_id", "r1", "r2", "s1", "s2", "n")
    sets = cut(
        embedded.where("n > 0")
        .groupBy("s1", "s2", "n", "sketch")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "r1", "r2")).alias("first"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    groups = cut(components(candidate_links(sets, recall)))
    # How many blocks a group needs, by its sets and by its words.
    member = _met(groups.select("id", F.col("root").alias("g")), sets.select("id", "n", "copies", "first"), ["id"])
    blocks = member.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n") / TILE_WORDS)).cast("int").alias("blocks"))
    spread = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    member = _met(member.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), spread, ["g", "salt"])
    member = member.select("id", "g", "copies", "blocks", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int").alias("block"), F.col("first.r1").alias("r1"), F.col("first.r2").alias("r2"))
    # Repeated rows have one key; each set needs its text once.
    texts = _met(own.select("r1", "r2", "text"), member, ["r1", "r2"])
    texts = texts.groupBy("r1", "r2", "id", "g", "copies", "blocks", "block").agg(F.min("text").alias("text"))
    tiled = texts.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = tiled.select("id", "g", "copies", "blocks", "block", "text", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    got = cut(_tiles(tiled))
    roots = got.where("whole").select("id", "root")
    parted = got.where("NOT whole").select(F.col("id").alias("a"), F.col("root").alias("b"))
    if not parted.isEmpty():
        roots = roots.unionByName(components(parted))
    links = got.groupBy("id").agg(F.sum("links").alias("links")).where("links > 0")
    return Joined(rows, sets, cut(_met(links, roots, ["id"]).select("id", "root", "links")))


def classes(docs: DataFrame, doc: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """(doc, class_id, n_links) for every row of ``docs``.

    ``class_id`` is the least document id of the row's class: documents connected by
    links.  ``n_links`` counts the other rows of similarity 0.8 or more, copies
    included.  Null and empty texts, and those without a word, have no links and are
    classes of their own; fewer than five words are one shingle.  Repeated rows each
    give a row, and count as links of each other.  An empty table gives no rows.  Null
    ids are allowed; a class of null ids alone has a null class_id.
    """
    got = join(docs, doc, text, recall)
    sets = got.sets.select("id", "s1", "s2", "copies", "least", F.col("first.r1").alias("r1"))
    labelled = sets.join(got.classes.hint("merge"), "id", "left")
    # A class of one set needs no further look.
    several = labelled.where(F.col("root").isNotNull())
    least = several.groupBy("root").agg(F.min("least").alias("class_least"))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    several = _met(several.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), spread, ["root", "salt"])
    keys = ["s1", "s2", "r1", "copies"]
    of_set = several.select(*keys, F.col("class_least").alias("class_id"), (F.col("links") + F.col("copies") - 1).alias("n_links"))
    of_set = of_set.unionByName(labelled.where(F.col("root").isNull()).select(*keys, F.col("least").alias("class_id"), (F.col("copies") - 1).alias("n_links")))
    # The rows of one set are dealt over SALTS keys; a set of one row needs that row's key alone.
    salt = F.pmod(F.col("r1"), F.lit(SALTS)).cast("int")
    salts = F.when(F.col("copies") == 1, F.array(salt)).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = of_set.select("s1", "s2", "class_id", "n_links", F.explode(salts).alias("salt"))
    # Copies of a text have different ids, so their row keys differ.
    worded = _met(got.rows.where("n > 0").withColumn("salt", salt), dealt, ["s1", "s2", "salt"]).select("doc_id", "class_id", "n_links")
    empty = got.rows.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return worded.unionByName(empty).withColumnRenamed("doc_id", doc)


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """All columns of one row of each class, the first by document id; rows without words all stay.

    Null and empty texts have no words, so their rows stay, repeated ones too.  Of rows
    that agree in id and text the one whose other columns come first as JSON stays.  A
    null id comes before all others.  An empty table gives no rows.
    """
    got = join(docs, doc, text, recall)
    labelled = got.sets.select("id", "first").join(got.classes.select("id", "root").hint("merge"), "id", "left")
    first = labelled.groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("first").alias("first")).select("first.r1", "first.r2")
    wordless = got.rows.where("n = 0").select("r1", "r2").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(doc, text))
    stay = packed.join(wordless.unionByName(first).hint("merge"), ["r1", "r2"], "left_semi")
    # Equal rows have one key: one of them stays, but all of those without words.
    has_word = F.coalesce(F.col("row").getField(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    others = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (doc, text)]
    order = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    once = stay.where(has_word).groupBy("r1", "r2").agg(F.min_by("row", order).alias("row")).select("row")
    kept = once.unionByName(stay.where(~has_word).select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
