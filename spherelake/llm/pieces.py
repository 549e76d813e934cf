"""SentencePiece encoding and decoding with N-best segmentations.

A text becomes the lattice of all pieces that match its characters; a path's score is
the sum of its pieces' scores from the model file.  Forward Viterbi gives every
position the best score from the beginning.  For the N best paths an A-star search
goes backward from the end: what it has collected plus the forward score of where it
stands is exactly the best complete path through it, so paths come off the queue in
order of their scores.

The lattice falls apart wherever no piece can cross: before a space mark that follows
another character, and around characters that no longer piece holds.  Between such
places lie units, so the work is done once for each distinct unit of a block, by array
operations over all units of a length, and the A-star search only runs for units that
can be in an N-best path: a document's N best are its units' best, but for the units
whose second best costs least.  Longer units are searched one by one.

Spaces are marked by U+2581 and one is put before the text, as the model asks for.
Characters without a piece become their UTF-8 bytes; so does a U+2581 that stands in
the text itself, which makes decoding exact for every text.  Control pieces never match.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from spherelake.llm.common import map_texts, released, schema_with, ship, small_batches
from spherelake.llm.flat import Flat, mix, powers

MARK = "▁"
#: Stands for a U+2581 of the text: no character, so no piece matches it.
OWN_MARK = 0x110000
#: Units up to this length are searched by array operations, longer ones by ``n_best``; both give the same paths, ties included.
SHORT = 24
#: Distinct units whose N best are remembered by a task.
REMEMBER = 20_000
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Pieces:
    """Ids, strings and scores of the pieces that match text; ids of the 256 bytes; the score of a character without a piece."""

    ids: np.ndarray
    strings: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    size: int
    _made: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def load(path: str = MODEL_PATH) -> Pieces:
        """Read a model file on the driver; executors get the table, not the path."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, strings, scores, byte_ids = [], [], [], np.full(256, -1, np.int32)
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids.append(i)
                strings.append(sp.id_to_piece(i))
                scores.append(sp.get_score(i))
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        scores = np.array(scores, np.float64)
        return Pieces(np.array(ids, np.int32), strings, scores, byte_ids, float(scores.min()) - 10, sp.get_piece_size())

    def __getstate__(self):
        return {**self.__dict__, "_made": {}}

    def _once(self, name: str, make):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def longest(self) -> int:
        return self._once("longest", lambda: max(map(len, self.strings)))

    @property
    def by_string(self) -> dict[str, tuple[int, float]]:
        return self._once("by_string", lambda: {s: (int(i), float(x)) for s, i, x in zip(self.strings, self.ids, self.scores)})

    @property
    def joined(self) -> np.ndarray:
        """Code points that stand in some piece beside another character."""

        def make():
            out = np.zeros(0x110002, bool)
            for s in self.strings:
                if len(s) > 1:
                    out[[ord(c) for c in s]] = True
            return out

        return self._once("joined", make)

    @property
    def mark_begins(self) -> bool:
        """Whether no piece has a mark after another character."""
        return self._once("mark", lambda: not any(MARK in s.lstrip(MARK) for s in self.strings))

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Open-addressed table from the hash of a piece to its place; 0 is an empty slot."""

        def make():
            flat = np.concatenate([np.fromiter(map(ord, s), np.uint32, len(s)) for s in self.strings])
            end = np.cumsum([len(s) for s in self.strings])
            begin = np.append(0, end[:-1])
            f = Flat([])
            h = f.spans(f.prefix(flat), begin, end)
            if len(np.unique(h)) != len(h) or (h == 0).any():
                raise ValueError("pieces share a hash")
            keys, place = np.zeros(1 << 18, np.uint64), np.full(1 << 18, -1, np.int32)
            for i, x in enumerate(h.tolist()):
                slot = x >> 46
                while keys[slot]:
                    slot = (slot + 1) & 0x3FFFF
                keys[slot], place[slot] = x, i
            return keys, place

        return self._once("table", make)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash among the pieces, or -1."""
        keys, place = self.table
        slot = (h >> np.uint64(46)).astype(np.int64)
        got = keys[slot]
        out = np.where(got == h, place[slot], -1)
        open_ = np.flatnonzero((got != h) & (got != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & 0x3FFFF
            got = keys[slot[open_]]
            hit = got == h[open_]
            out[open_[hit]] = place[slot[open_[hit]]]
            open_ = open_[~hit & (got != 0)]
        return out

    @property
    def bytes_of(self) -> tuple[np.ndarray, np.ndarray]:
        """For each id its bytes' begin and end in one array; marks are spaces, control pieces nothing."""

        def make():
            parts = [b""] * self.size
            for i, s in zip(self.ids.tolist(), self.strings):
                parts[i] = s.replace(MARK, " ").encode()
            for b, i in enumerate(self.byte_ids.tolist()):
                parts[i] = bytes([b])
            return np.cumsum([0, *map(len, parts)]), np.frombuffer(b"".join(parts), np.uint8)

        return self._once("bytes", make)


class Unit(tuple):
    """A unit as a tuple of code points (U+2581 of the text as OWN_MARK)."""

    __slots__ = ()


def edges(pieces: Pieces, unit: Unit) -> list[list[tuple[int, float, int]]]:
    """For each end, the (length, score, id or -1 for bytes) of the pieces that end there, shortest first."""
    text = "".join("\ufffe" if c == OWN_MARK else chr(c) for c in unit)
    known, longest = pieces.by_string, pieces.longest
    out: list[list[tuple[int, float, int]]] = [[]]
    for e in range(1, len(unit) + 1):
        own = []
        for n in range(1, min(e, longest) + 1):
            if unit[e - n] == OWN_MARK:
                if n == 1:
                    own.append((1, pieces.unknown, -1))
                break
            got = known.get(text[e - n : e])
            if got:
                own.append((n, got[1], got[0]))
            elif n == 1:
                own.append((1, pieces.unknown, -1))
        out.append(own)
    return out


def n_best(pieces: Pieces, unit: Unit, n: int) -> list[tuple[float, list[int]]]:
    """The n best paths through a unit as (score, ids), best first.

    Equal scores are ordered by the lengths of the pieces from the end, shorter first.
    """
    into = edges(pieces, unit)
    forward = [0.0] + [0.0] * len(unit)
    for e in range(1, len(unit) + 1):
        forward[e] = max(forward[e - k] + s for k, s, _ in into[e])
    out: list[tuple[float, list[int]]] = []
    count = 0
    # Of equal scores the one that was pushed last comes first; shorter pieces are pushed last.
    queue: list[tuple] = [(-forward[-1], 0, len(unit), 0.0, None)]
    while queue and len(out) < n:
        f, _, at, back, path = heapq.heappop(queue)
        if at == 0:
            ids = []
            while path is not None:
                end, piece, path = path
                ids += [piece] if piece >= 0 else _bytes(pieces, unit[end - 1])
            out.append((-f, ids))
            continue
        for k, s, piece in reversed(into[at]):
            count -= 1
            heapq.heappush(queue, (-(forward[at - k] + back + s), count, at - k, back + s, (at, piece, path)))
    return out


def _bytes(pieces: Pieces, c: int) -> list[int]:
    return pieces.byte_ids[list((MARK if c == OWN_MARK else chr(c)).encode("utf-8", "surrogatepass"))].tolist()


def best_sums(lists: list[list[tuple[float, list[int]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best sums of one entry from each list, with the entries' places."""
    start = (0,) * len(lists)
    queue, seen, out = [(-sum(x[0][0] for x in lists), start)], {start}, []
    while queue and len(out) < n:
        total, at = heapq.heappop(queue)
        out.append((-total, at))
        for i, x in enumerate(lists):
            if at[i] + 1 < len(x):
                to = (*at[:i], at[i] + 1, *at[i + 1 :])
                if to not in seen:
                    seen.add(to)
                    heapq.heappush(queue, (total - (x[to[i]][0] - x[at[i]][0]), to))
    return out


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of the ranges [begin, begin + size), one after the other."""
    total = int(size.sum())
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)


class Encoder:
    """Encodes blocks of texts; remembers the N best of units."""

    def __init__(self, pieces: Pieces, n: int = 1):
        self.pieces, self.n = pieces, n
        self.known: dict[Unit, list[tuple[float, list[int]]]] = {}

    def best_of(self, unit: Unit) -> list[tuple[float, list[int]]]:
        got = self.known.get(unit)
        if got is None:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            got = self.known[unit] = n_best(self.pieces, unit, max(2, self.n))
        return got

    def viterbi(self, cp: np.ndarray, prefix: np.ndarray, begin: np.ndarray, length: int):
        """Of units of one length: best score, second best score, ids in order (-2 - code point for bytes), counts."""
        p, w = self.pieces, len(begin)
        at = begin[:, None] + np.arange(length + 1)
        inverse = powers(len(prefix))[1]
        sums, undo = prefix[at], inverse[at[:, :-1]]
        one = np.full((length + 1, w), -np.inf)
        two = np.full((length + 1, w), -np.inf)
        one[0] = 0
        last = np.zeros((length + 1, w), np.int8)
        piece = np.full((length + 1, w), -1, np.int32)
        for e in range(1, length + 1):
            for n in range(1, min(e, p.longest) + 1):
                s = e - n
                h = (sums[:, e] - sums[:, s]) * undo[:, s]
                h += np.uint64(n)
                found = p.find(mix(h))
                if n == 1:
                    score = np.where(found >= 0, p.scores[found], p.unknown)
                    one[e], two[e], last[e], piece[e] = one[s] + score, two[s] + score, 1, found
                else:
                    on = np.flatnonzero(found >= 0)
                    if not len(on):
                        continue
                    f = found[on]
                    score = p.scores[f]
                    a, b = one[s][on] + score, two[s][on] + score
                    was, then = one[e][on], two[e][on]
                    better = a > was
                    two[e][on] = np.where(better, np.maximum(was, b), np.maximum(then, a))
                    one[e][on] = np.where(better, a, was)
                    last[e][on] = np.where(better, n, last[e][on])
                    piece[e][on] = np.where(better, f, piece[e][on])
        ids = np.full((w, length), -1, np.int64)
        at, rows, column = np.full(w, length), np.arange(w), length - 1
        while len(rows):
            f = piece[at, rows]
            ids[rows, column] = np.where(f >= 0, p.ids[f], -2 - cp[begin[rows] + at - 1].astype(np.int64))
            at = at - last[at, rows]
            keep = at > 0
            at, rows, column = at[keep], rows[keep], column - 1
        return one[length], two[length], ids[ids != -1], (ids != -1).sum(1)

    def encode(self, texts: list[str]):
        """(ids, offsets by text, scores [texts x n], alternatives by text).

        An alternative is a list of (begin, end, ids): what to put in place of the best
        path's ids between begin and end (counted within the text).
        """
        p = self.pieces
        flat = Flat([" " + t for t in texts])
        cp = flat.cp.copy()
        mark = cp == 0x20
        cp[flat.cp == ord(MARK)] = OWN_MARK
        cp[mark] = ord(MARK)
        alone = ~p.joined[cp]
        cut = alone.copy()
        cut[1:] |= alone[:-1]
        cut[flat.at] = True
        if p.mark_begins:
            cut[1:] |= mark[1:] & ~mark[:-1]
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(cp))
        # The line ends between texts are no text, nor is the space before an empty one.
        none = np.zeros(len(cp), bool)
        none[flat.to] = True
        none[flat.at[flat.lens == 1]] = True
        own = ~none[begin]
        begin, end = begin[own], end[own]
        doc = flat.doc_of(begin)
        prefix = flat.prefix(cp)
        key = flat.spans(prefix, begin, end)
        _, first, unit = np.unique(key, return_index=True, return_inverse=True)
        u_begin, u_len = begin[first], (end - begin)[first]
        m = len(first)
        one, two = np.zeros(m), np.full(m, -np.inf)
        size, offset = np.zeros(m, np.int64), np.zeros(m, np.int64)
        store: list[np.ndarray] = []
        stored = 0
        for length in range(1, SHORT + 1):
            group = np.flatnonzero(u_len == length)
            if not len(group):
                continue
            one[group], two[group], ids, counts = self.viterbi(cp, prefix, u_begin[group], length)
            if (ids < -1).any():
                # Characters without a piece become bytes.
                row = np.repeat(np.arange(len(group)), counts)
                wide = [_bytes(p, -2 - int(i)) if i < -1 else [int(i)] for i in ids.tolist()]
                counts = np.bincount(row, [len(x) for x in wide], len(group)).astype(np.int64)
                ids = np.fromiter((i for x in wide for i in x), np.int64)
            size[group] = counts
            offset[group] = stored + np.cumsum(counts) - counts
            store.append(ids.astype(np.int32))
            stored += len(ids)
        for g in np.flatnonzero(u_len > SHORT).tolist():
            got = self.long_unit(cp[u_begin[g] : u_begin[g] + u_len[g]])
            one[g], two[g] = got[0][0], got[1][0] if len(got) > 1 else -np.inf
            size[g], offset[g] = len(got[0][1]), stored
            store.append(np.array(got[0][1], np.int32))
            stored += size[g]
        table = np.concatenate([*store, np.zeros(0, np.int32)])
        ids = table[ragged(offset[unit], size[unit])]
        by_unit = np.concatenate([[0], np.cumsum(size[unit])])
        at = np.searchsorted(doc, np.arange(flat.n + 1))
        offsets = by_unit[at]
        scores = np.full((flat.n, self.n), -np.inf)
        # Sums by text, not differences of running sums, which would lose digits.
        scores[:, 0] = np.bincount(doc, one[unit], minlength=flat.n) if len(doc) else 0
        alternatives: list[list[list[tuple[int, int, list[int]]]]] = [[] for _ in range(flat.n)]
        if self.n > 1 and len(unit):
            loss = (one - two)[unit]
            order = np.lexsort((loss, doc))
            for d in range(flat.n):
                near = [i for i in order[at[d] : min(at[d] + self.n - 1, at[d + 1])].tolist() if np.isfinite(loss[i])]
                if not near:
                    continue
                near.sort()
                lists = [self.best_of(Unit(cp[begin[i] : end[i]].tolist())) if end[i] - begin[i] <= SHORT else self.long_unit(cp[begin[i] : end[i]]) for i in near]
                base = sum(x[0][0] for x in lists)
                for k, (total, places) in enumerate(best_sums(lists, self.n)):
                    if k:
                        scores[d, k] = scores[d, 0] + (total - base)
                        alternatives[d].append([(int(by_unit[i] - offsets[d]), int(by_unit[i + 1] - offsets[d]), x[j][1]) for i, x, j in zip(near, lists, places) if j])
        return ids, offsets, scores, alternatives

    def long_unit(self, cp: np.ndarray) -> list[tuple[float, list[int]]]:
        """The N best of a long unit, which is first cut wherever none of its own pieces crosses."""
        unit = Unit(cp.tolist())
        reach = np.zeros(len(unit) + 2, np.int64)
        for e, own in enumerate(edges(self.pieces, unit)):
            for k, _, _ in own:
                reach[e - k + 1] += 1
                reach[e] -= 1
        free = np.flatnonzero(np.cumsum(reach)[1 : len(unit)] == 0) + 1
        parts = [unit[a:b] for a, b in zip([0, *free.tolist()], [*free.tolist(), len(unit)])]
        n = max(2, self.n)
        lists = [self.best_of(Unit(x)) for x in parts]
        losses = sorted((x[0][0] - x[1][0], i) for i, x in enumerate(lists) if len(x) > 1)[: n - 1]
        near = sorted(i for _, i in losses)
        total = sum(x[0][0] for x in lists)
        picked = [lists[i] for i in near]
        base = sum(x[0][0] for x in picked)
        out = []
        for got, places in best_sums(picked, n) if near else [(0.0, ())]:
            choice = dict(zip(near, places))
            out.append((total + got - base, [i for k, x in enumerate(lists) for i in x[choice.get(k, 0)][1]]))
        return out


def apply_alternative(ids: list[int], changes: list[tuple[int, int, list[int]]]) -> list[int]:
    for a, b, new in reversed(changes):
        ids = [*ids[:a], *new, *ids[b:]]
    return ids


def encode(docs: DataFrame, pieces: Pieces, keep: tuple[str, ...] = ("doc_id",), text: str = "text", n: int = 2, decoded: str | None = None) -> DataFrame:
    """``keep``, ``ids`` (the best path), ``scores`` of the n best, ``others`` (the ids of the second to n-th best).

    With ``decoded``, a column of that name holds the text decoded from the ids, made in
    the same pass over the data.  Null and empty texts have no ids and one score, 0.  A
    text with fewer than n paths has fewer scores.  A very long text is one block.
    Repeated rows each give a row, an empty table none; columns of the input that have
    the name of a new one are left out.
    """
    kept, schema = schema_with(docs, keep, "ids array<int>, scores array<double>, others array<array<int>>" + (f", `{decoded}` string" if decoded else ""))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def make():
        encoder = Encoder(shared.value, n)

        def work(texts: list[str]) -> dict[str, object]:
            ids, offsets, scores, alternatives = encoder.encode(texts)
            others = []
            for d, alts in enumerate(alternatives):
                own = ids[offsets[d] : offsets[d + 1]]
                full = []
                for changes in alts:
                    parts, at = [], 0
                    for a, b, new in changes:
                        parts += [own[at:a], np.array(new, np.int32)]
                        at = b
                    full.append(np.concatenate([*parts, own[at:]]))
                others.append(full)
            flat_others = [x for full in others for x in full]
            inner = pa.ListArray.from_arrays(np.cumsum([0, *map(len, flat_others)]).astype(np.int32), pa.array(np.concatenate([*flat_others, np.zeros(0, np.int32)]).astype(np.int32)))
            return ({decoded: decode_ids(shared.value, ids.astype(np.int64), offsets)} if decoded else {}) | {
                "ids": pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids.astype(np.int32))),
                "scores": [[x for x in row if x > -np.inf] for row in scores.tolist()],
                "others": pa.ListArray.from_arrays(np.cumsum([0, *map(len, others)]).astype(np.int32), inner),
            }

        return work

    return map_texts(docs, kept, text, schema, make)


def decode_ids(pieces: Pieces, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of rows of ids: their bytes, without the space that encoding put before the text."""
    begin, raw = pieces.bytes_of
    size = begin[ids + 1] - begin[ids]
    out = raw[ragged(begin[ids], size)].tobytes()
    at = np.concatenate([[0], np.cumsum(size)])[offsets]
    return [out[a + 1 : b].decode("utf-8", "replace") if out[a : a + 1] == b" " else out[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def decode(rows: DataFrame, pieces: Pieces, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns and ``to``: the text of the ids.  Null ids give a null text, no ids an empty one.

    A column that is named ``to`` already is replaced.
    """
    rows = rows.drop(to)
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    out_type = StructType([*rows.schema.fields, StructField(to, StringType())])
    arrow = to_arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lens = np.array([0 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
            texts = decode_ids(shared.value, flat, np.concatenate([[0], np.cumsum(lens)]))
            null = column.is_null().to_pylist()
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, arrow)], pa.array([None if z else t for z, t in zip(null, texts)], arrow.field(to).type)], schema=arrow)

    return rows.mapInArrow(released(run), out_type)
