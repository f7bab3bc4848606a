"""Repeated passages by a sparse suffix array of the corpus.

A passage is repeated where at least ``LEAST`` words in a row also stand in another document (words as
in ``words``: ASCII case and the kind of white space don't count). Suffixes are retained at
minimisers: positions whose hash of ``GRAM`` words is the least among ``WINDOW`` such hashes in a row,
so that every ``LEAST`` words hold one whose gram lies inside. Steps:

1. Every text gives its retained positions with the gram's hash and a hash of the context (``LEFT``
   words before, ``RIGHT`` from there on). Positions with the same context are one class, whatever
   their number, so copies cost little; a class of two documents is repeated over its whole context.
2. Only grams that have two contexts or more need sorting. One document of each such class is read
   again for the words of the context.
3. These suffixes are range-partitioned and sorted by gram and following words. For each way to lay
   LEAST words around the gram, suffixes with the same LEAST words are grouped, and the smallest and
   largest document of each group are found. What can go on beyond a partition's edge is gathered
   across partitions by these words, and what more than one has goes back to each.
4. Words that another document has are marked at every member of their classes; marks are joined by
   document into spans.

Every LEAST words hold a retained position at the same place in all documents that have them, so the
spans are exactly the LEAST words in a row that another (or an earlier) document has, joined.

Null, empty and short texts have no suffixes. Rows of null doc_id take no part and stay as they are.
Rows that repeat a doc_id with the same text count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .tables import Scratch, apart, frugal, ship
from .words import gram_hashes, mixed, texts, words

LEAST, GRAM = 50, 12
WINDOW = LEAST - GRAM + 1
LEFT, RIGHT = WINDOW, LEAST
_WEIGHT = np.random.default_rng(77).integers(1, 2**63, LEFT + RIGHT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MATCHED = "kind int, part int, kg long, ctx long, first long, last long, l int, r int, ll int, rr int, left binary, right binary"


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def retained(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of all minimisers of a text, tied ones too, and their grams' hashes. What is kept
    must depend on the words around alone, so that documents which share them keep the same."""
    g = gram_hashes(h, GRAM)
    if len(h) < LEAST:
        return np.empty(0, dtype=np.int64), g[:0]
    least = _sliding(g, WINDOW, np.minimum)
    around = np.concatenate((np.zeros(WINDOW - 1, dtype=np.uint64), least, np.zeros(WINDOW - 1, dtype=np.uint64)))
    at = np.flatnonzero(_sliding(around, WINDOW, np.maximum) == g)
    return at, g[at]


def contexts(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words around each position, a row each: LEFT before and RIGHT from there on; 0 beyond the text."""
    padded = np.concatenate((np.zeros(LEFT, dtype=np.uint64), h, np.zeros(RIGHT, dtype=np.uint64)))
    return np.lib.stride_tricks.sliding_window_view(padded, LEFT + RIGHT)[at]


def _context_hash(c: np.ndarray) -> np.ndarray:
    return mixed((c * _WEIGHT).sum(axis=1, dtype=np.uint64))


def context_hashes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the contexts, a bounded number of them at a time."""
    return np.concatenate([_context_hash(contexts(h, at[i : i + 10_000])) for i in range(0, max(len(at), 1), 10_000)])


def _text_hash(h: np.ndarray) -> int:
    """A signed hash of a text's words in their order."""
    at = np.arange(len(h), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return int(mixed((h * at).sum(keepdims=True, dtype=np.uint64)).view(np.int64)[0])


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _lcp(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of a and the row b."""
    same = a == b
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))


def _windows(kg: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All ways to lay LEAST words around the gram: how many of them stand before it, the suffixes that
    have so many, and a hash of the LEAST words of each."""
    h = kg.view(np.uint64).copy()
    for i in range(LEAST):
        h += right[:, i].astype(np.uint64) * _WEIGHT[LEFT + i]
    for before in range(WINDOW):
        if before:
            h += left[:, before - 1].astype(np.uint64) * _WEIGHT[LEFT - before]
            h -= right[:, LEAST - before].astype(np.uint64) * _WEIGHT[LEFT + LEAST - before]
        there = right[:, LEAST - before - 1] != 0
        if before:
            there &= left[:, before - 1] != 0
        rows = np.flatnonzero(there)
        if len(rows):
            yield before, rows, mixed(h[rows] ^ np.uint64(before)).view(np.int64)


class _Marks:
    """How far each suffix's LEAST words reach that another document has (l, r), or an earlier one (ll, rr)."""

    def __init__(self, first: np.ndarray):
        self.first = first
        self.l, self.r, self.ll, self.rr = (np.zeros(len(first), dtype=np.int32) for _ in range(4))

    def add(self, before: int, rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> None:
        """least, most: the smallest and largest document that has these words, for each of the rows."""
        for some, l, r in ((rows[least != most], self.l, self.r), (rows[least < self.first[rows]], self.ll, self.rr)):
            l[some] = np.maximum(l[some], before)
            r[some] = np.maximum(r[some], LEAST - before)

    def table(self, kg: np.ndarray, ctx: np.ndarray) -> pa.Table:
        some = np.flatnonzero(self.r > 0)
        return _rows(0, -1, kg[some], ctx[some], self.first[some], self.first[some], [x[some] for x in (self.l, self.r, self.ll, self.rr)])


def _rows(kind: int, part: int, kg, ctx, first, last, marks=None, left=None, right=None) -> pa.Table:
    n = len(kg)
    marks = marks or [np.zeros(n, dtype=np.int32)] * 4
    none = pa.nulls(n, pa.binary())
    columns = [np.full(n, kind, dtype=np.int32), np.full(n, part, dtype=np.int32), kg, ctx, first, last, *marks, none if left is None else left, none if right is None else right]
    return pa.table(dict(zip(("kind", "part", "kg", "ctx", "first", "last", "l", "r", "ll", "rr", "left", "right"), columns, strict=True)))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, width)


def _matches(table: pa.Table, part: int) -> pa.RecordBatch:
    """Marks of a sorted partition's suffixes (kind 0). Its first and last gram can go on in others: of
    these it also gives the suffixes (kind 2) and what it has of the words that others can have (kind 1).
    As suffixes are sorted by the words from the gram on, words that stand in another partition too begin
    there as its own first or last suffix does."""
    kg, ctx, first, last = (np.array(table.column(c), dtype=np.int64) for c in ("kg", "ctx", "first", "last"))
    left, right = _matrix(table.column("left"), LEFT), _matrix(table.column("right"), RIGHT)
    reach = np.zeros(len(kg), dtype=np.int64)
    for end in {0, len(kg) - 1}:
        of = np.flatnonzero(kg == kg[end])
        reach[of] = np.maximum(reach[of], _lcp(right[of], right[end]))
    marks, parts = _Marks(first), []
    for before, rows, key in _windows(kg, left, right):
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        least, most = np.minimum.reduceat(first[rows], start), np.maximum.reduceat(last[rows], start)
        size = np.diff(np.append(start, len(rows)))
        marks.add(before, rows, np.repeat(least, size), np.repeat(most, size))
        out = reach[rows[start]] >= LEAST - before
        parts.append(_rows(1, part, kg[rows[start]][out], key[start][out], least[out], most[out]))
    rim = np.flatnonzero(reach)
    of = table.take(rim)
    parts += [marks.table(kg, ctx), _rows(2, part, kg[rim], ctx[rim], first[rim], last[rim], None, of.column("left"), of.column("right"))]
    return pa.concat_tables(parts).combine_chunks()


@frugal
def _sorted_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        yield from _matches(pa.Table.from_batches(got), TaskContext.get().partitionId()).to_batches(100_000)


def _across(suffixes: pa.Table, shared: pa.Table) -> pa.Table:
    """Marks of a partition's suffixes by words that other partitions have too."""
    kg, ctx, first = (np.array(suffixes.column(c), dtype=np.int64) for c in ("kg", "ctx", "first"))
    marks = _Marks(first)
    if len(kg) and shared.num_rows:
        key, least, most = (np.array(shared.column(c), dtype=np.int64) for c in ("key", "least", "most"))
        order = np.argsort(key)
        key, least, most = key[order], least[order], most[order]
        for before, rows, k in _windows(kg, _matrix(suffixes.column("left"), LEFT), _matrix(suffixes.column("right"), RIGHT)):
            at = np.minimum(np.searchsorted(key, k), len(key) - 1)
            there = key[at] == k
            marks.add(before, rows[there], least[at[there]], most[at[there]])
    return marks.table(kg, ctx)


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(map(tuple, spans.tolist())):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        elif e > s:
            out.append((s, e))
    return out


def _spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, th (a hash of the words), every and later: lists of repeated spans of words, packed as
    start << 32 | end; ``later`` has those that an earlier document (one of a smaller doc_id) has too."""
    spark = docs.sparkSession
    ship(spark)

    @frugal
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, b in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                h = words(b)[2]
                at, g = retained(h)
                if len(at) and doc is not None:
                    c = context_hashes(h, at)
                    # in a few words over and over, the same context comes again and again: one row for its first and last place
                    new = np.concatenate(([True], (c[1:] != c[:-1]) | (g[1:] != g[:-1]) | (np.diff(at) > LEAST)))
                    start = np.flatnonzero(new)
                    to = at[np.append(start[1:], len(at)) - 1]
                    at, g, c = at[start], g[start], c[start]
                    for column, x in zip(out, (g, c, np.full(len(at), doc, dtype=np.int64), np.full(len(at), _text_hash(h)), at, to, np.full(len(at), len(h))), strict=True):
                        column.append(x.view(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([_as_long(np.concatenate(c)) for c in out], names=["kg", "ctx", "doc_id", "th", "at", "to", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    anchors = scratch.keep(rows.mapInArrow(measure, "kg long, ctx long, doc_id long, th long, at long, to long, n long"), "anchors")
    classes = scratch.keep(anchors.groupBy("kg", "ctx").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "classes")
    several = classes.groupBy("kg").agg(F.count("*").alias("k")).where("k > 1").select(F.col("kg").alias("of"))
    wanted = classes.join(several, F.col("kg") == F.col("of"), "left_semi")
    lists = wanted.groupBy("first").agg(F.collect_list(F.struct("kg", "ctx", "last")).alias("wanted"))

    @frugal
    def regain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, b, w in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2), strict=True):
                h = words(b)[2]
                at, g = retained(h)
                if not len(at):
                    continue
                kg, ctx, last = (np.array(w.values.field(i), dtype=np.int64) for i in range(3))
                some = np.isin(g.view(np.int64), kg)
                at, g = at[some], g[some]
                place = {k: i for i, k in enumerate(zip(g.view(np.int64).tolist(), context_hashes(h, at).view(np.int64).tolist(), strict=True))}
                for k, x, z in zip(kg.tolist(), ctx.tolist(), last.tolist(), strict=True):
                    if (i := place.get((k, x))) is not None:
                        c = contexts(h, at[i : i + 1])[0]
                        small = np.maximum(c >> np.uint64(32), 1).astype(">u4")
                        small[c == 0] = 0
                        for column, v in zip(out, (k, x, doc, z, small[:LEFT][::-1].tobytes(), small[LEFT:].tobytes()), strict=True):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), *(pa.array(c, pa.binary()) for c in out[4:])], names=["kg", "ctx", "first", "last", "left", "right"])

    suffixes = rows.join(lists, F.col("doc_id") == F.col("first")).select("doc_id", "text", "wanted")
    suffixes = scratch.keep(suffixes.mapInArrow(regain, "kg long, ctx long, first long, last long, left binary, right binary"), "suffixes")
    array = suffixes.repartitionByRange("kg", "right", "left").sortWithinPartitions("kg", "right", "left")
    matches = scratch.keep(array.mapInArrow(_sorted_partition, MATCHED), "matches")
    shared = matches.where("kind = 1").groupBy("kg", "ctx").agg(F.min("first").alias("least"), F.max("last").alias("most"), F.collect_list("part").alias("parts"))
    shared = shared.where(F.size("parts") > 1).select(F.explode("parts").alias("part"), F.col("ctx").alias("key"), "least", "most")
    across = matches.where("kind = 2").groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_across, MATCHED)
    marks = matches.where("kind = 0").unionByName(across).groupBy("kg", "ctx").agg(*(F.max(c).alias(c) for c in ("l", "r", "ll", "rr")))
    copies = classes.where("first < last").select("kg", "ctx", F.col("first").alias("of"))
    info = marks.join(copies, ["kg", "ctx"], "full")
    info = scratch.keep(info.select(F.col("kg").alias("k"), F.col("ctx").alias("c"), "of", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("l", "r", "ll", "rr"))), "marks")
    scratch.drop("suffixes", "matches", "classes")

    here = anchors.join(info, (F.col("kg") == F.col("k")) & (F.col("ctx") == F.col("c")))
    whole_l, whole_r = F.least("at", F.lit(LEFT)), F.least(F.col("n") - F.col("at"), F.lit(RIGHT))
    whole = F.col("of").isNotNull() & (whole_l + whole_r >= LEAST)
    span = lambda left, right: F.shiftleft(F.col("at") - left, 32).bitwiseOR(F.col("to") + right)
    every = span(F.when(whole, whole_l).otherwise(F.col("l")), F.when(whole, whole_r).otherwise(F.col("r")))
    again = whole & (F.col("doc_id") > F.col("of"))
    later = F.when(again, span(whole_l, whole_r)).when(F.col("rr") > 0, span(F.col("ll"), F.col("rr")))
    here = here.where(whole | (F.col("r") > 0)).select("doc_id", "th", every.alias("every"), later.alias("later"))
    return here.groupBy("doc_id", "th").agg(F.collect_set("every").alias("every"), F.collect_set("later").alias("later"))


def _unpacked(value: pa.Scalar) -> list[tuple[int, int]]:
    x = np.array(value.values, dtype=np.int64)
    return _merged(np.column_stack((x >> 32, x & 0xFFFFFFFF)))


def repeats(docs: DataFrame) -> DataFrame:
    """One row for each repeated passage of each document: doc_id, first_word (from 0), n_words, and
    n_later, how many of these words an earlier document has as part of a repeated passage."""
    scratch = Scratch(docs.sparkSession, "suffix-dedup")

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, every, later in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                later = _unpacked(later)
                for s, e in _unpacked(every):
                    out.append((doc, s, e - s, sum(max(min(e, b) - max(s, a), 0) for a, b in later)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4, names=["doc_id", "first_word", "n_words", "n_later"])

    return _spans(docs, scratch).select("doc_id", "every", "later").mapInArrow(run, "doc_id long, first_word long, n_words long, n_later long")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages that an earlier document has; ``n_chars``, where there is
    such a column, follows. A document of which nothing is left goes. Others stay byte for byte."""
    return apart(docs, ["doc_id", "text", "n_chars"], _cut)


def _cut(docs: DataFrame) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    found = _spans(docs, scratch).where(F.size("later") > 0).select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), F.col("later").alias("__later"))
    found = scratch.keep(found, "found")
    scratch.drop("anchors", "marks")
    columns = docs.columns
    spans = found.groupBy("__doc").agg(F.collect_list(F.struct("__th", "__later")).alias("__spans"))
    joined = docs.join(spans, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")
    schema = StructType([*docs.schema.fields, StructField("__stays", BooleanType())])
    place, length = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else -1

    def without(b: np.ndarray, spans_of: list[dict]) -> str:
        starts, ends, h = words(b)
        th = _text_hash(h)
        keep, at = [], 0
        for one in spans_of:
            if one["__th"] == th:
                x = np.array(one["__later"], dtype=np.int64)
                for s, e in _merged(np.column_stack((x >> 32, x & 0xFFFFFFFF))):
                    keep.append(bytes(b[at : starts[s]]))
                    at = ends[e - 1]
        keep.append(bytes(b[at:]))
        return b"".join(keep).decode("utf-8", "replace")

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays, stays = list(batch.columns[: len(columns)]), np.ones(batch.num_rows, dtype=bool)
            spans_of = batch.column(len(columns))
            if spans_of.null_count < batch.num_rows:
                new, chars = arrays[place].to_pylist(), arrays[length].to_pylist() if length >= 0 else []
                for i, b in enumerate(texts(arrays[place])):
                    if (found_here := spans_of[i].as_py()) is not None:
                        cut = without(b, found_here)
                        stays[i] = cut == new[i] or bool(cut.split())
                        if chars and cut != new[i]:
                            chars[i] = len(cut)
                        new[i] = cut
                arrays[place] = pa.array(new, arrays[place].type)
                if length >= 0:
                    arrays[length] = pa.array(chars, arrays[length].type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(stays)], names=[*columns, "__stays"])

    return joined.mapInArrow(run, schema).where("__stays").select(*columns)
