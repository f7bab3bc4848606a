"""Self-join of documents on the Jaccard similarity of their word n-gram sets, by prefix filtering.

Two sets link when PERCENT * union <= 100 * intersection. What is linked must share an n-gram among the
rarest ``n - ceil(t n) + 1`` of each (the prefix, in one order for all). The steps:

1. Every text gives its set's size, fingerprint and parity bits, and counts of its n-grams go to a
   sketch of ``1 << SKETCH_BITS`` counters. Rare-first is the order of these counters, then of the
   n-gram's hash: any order is right, and frequent passages come last. Texts with the same set are one
   node.
2. Prefix n-grams are dealt out once by n-gram; only those of two nodes or more stay, with the size of
   their block.
3. In a block of at most ``SMALL`` nodes the pairs that pass the length and the positional filter are
   candidates. Parity bits rule out those that surely differ in too much, so that only the sets of the
   others are fetched; each distinct pair is verified once, by suffix filter and then exactly.
4. A larger block, without the nodes that pass the positional filter with none in it, goes to one task
   (or, beyond ``BLOCK_GRAMS`` n-grams, is dealt into parts of which every two meet in a task), which
   verifies inside and gives only the links that join what it hasn't joined yet, so that groups of near
   copies make no quadratic output. A pair is verified in the block of its first common prefix n-gram
   alone.
5. Components are those of the links between nodes; a document's is the smallest doc_id among all
   documents of all nodes of its component.

A node's name is a 64-bit hash of its set, and the set's size.

Null or wordless texts have an empty set and link with nothing; fewer words than n make one n-gram.
Rows of null doc_id link with nothing and keep a null component_id. Repeated rows are repeated.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .tables import Scratch, apart, frugal, ship
from .words import shingle_set, texts, words

SKETCH_BITS, CHUNK_BITS, SMALL, BLOCK_GRAMS = 20, 14, 64, 150_000
#: doc_ids sent to all executors to pick their texts; more go by an exchange of the texts.
SENT_ROWS = 2_000_000
#: Sets a task remembers so as not to give their n-grams again for the next copy.
COPIES = 200_000
_SHIFT = np.uint64(64 - SKETCH_BITS)
_NONE = np.empty(0, dtype=np.uint64)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> _SHIFT).astype(np.int64)


def _hash(grams: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "big", signed=True)


def _node(hash_: int, n: int) -> bytes:
    return struct.pack(">qi", hash_, n)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def rare_first(grams: np.ndarray, sketch: np.ndarray, length: int) -> np.ndarray:
    return grams[np.lexsort((grams, sketch[_bucket(grams)]))[:length]]


def needed(n1, n2, percent: int):
    """The least intersection of sets of these sizes that link."""
    return -(-percent * (n1 + n2) // (100 + percent))


def parity_bits(grams: np.ndarray) -> bytes:
    """For each value of the low bits of a set's elements, whether an odd number of them has it; a power
    of two of bits, one for each element or more."""
    width = max(64, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """In how many elements two sets differ at least, by their parity bits: each element that only one
    of them has turns one bit. The longer bits are folded to the other's length."""
    x, y = sorted((np.frombuffer(v, dtype="<u8") for v in (a, b)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def suffix_filter(a: np.ndarray, b: np.ndarray, allowed: int, depth: int = 3) -> bool:
    """False if sorted a and b surely differ in more than ``allowed`` elements: split both at a's
    median; what lies on one side of one can only meet what lies there of the other."""
    if abs(len(a) - len(b)) > allowed:
        return False
    if not depth or len(a) < 2 or not len(b):
        return True
    m = len(a) // 2
    k = int(np.searchsorted(b, a[m]))
    low, high = abs(m - k), abs((len(a) - m) - (len(b) - k))
    if low + high > allowed:
        return False
    return suffix_filter(a[:m], b[:k], allowed - high, depth - 1) and suffix_filter(a[m:], b[k:], allowed - low, depth - 1)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link, exactly."""
    need = needed(len(a), len(b), percent)
    if not suffix_filter(a, b, len(a) + len(b) - 2 * need):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum()) >= need


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<u4")


def _sketch(tables: DataFrame, scratch: Scratch) -> np.ndarray:
    """Sum of all partitions' counters, chunk by chunk, 64 partitions at a time, so no task holds many."""
    spark = scratch.spark
    now = tables.where("chunk is not null").select("chunk", F.col("part").alias("part"), "counts")

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
        for c in table.column("counts"):
            total += _unpacked(c.as_py())
        total = np.minimum(total, 2**32 - 1).astype("<u4")
        return pa.table({"chunk": table.column("chunk")[:1].cast(pa.int32()), "part": table.column("next")[:1].cast(pa.int32()), "counts": pa.array([_packed(total)], pa.binary())})

    level = 0
    while (now.agg(F.max("part")).first()[0] or 0) > 0 or level == 0:
        level += 1
        now = now.withColumn("next", F.expr("cast(part div 64 as int)")).groupBy("chunk", "next").applyInArrow(add, "chunk int, part int, counts binary")
        now = scratch.keep(now, f"sketch{level}")
        if level > 1:
            scratch.drop(f"sketch{level - 1}")
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for r in now.collect():  # as many numbers as the sketch has, whatever the input
        out[r["chunk"] << CHUNK_BITS : (r["chunk"] + 1) << CHUNK_BITS] = _unpacked(r["counts"])
    scratch.drop(f"sketch{level}")
    return out


def _block_links(sketch, percent: int):
    """Links within a block of nodes that share a prefix n-gram; only as many as join them."""

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes]] = []
        sets = [np.array(g.values, dtype=np.int64).view(np.uint64) for g in table.column("grams")]
        keys, side = table.column("node").to_pylist(), np.array(table.column("side"))
        token = np.uint64(table.column("token")[0].as_py() % (1 << 64))
        n = np.array([len(s) for s in sets])
        order = np.argsort(n, kind="stable")
        sets, keys, side, n = [sets[i] for i in order], [keys[i] for i in order], side[order], n[order]
        before, place = [], np.empty(len(sets), dtype=np.int64)
        for i, s in enumerate(sets):
            p = rare_first(s, sketch.value, prefix_length(len(s), percent))
            place[i] = int(np.flatnonzero(p == token)[0])
            before.append(p[: place[i]])
        at = np.concatenate(([0], np.cumsum(n)))
        grams, rank = np.unique(np.concatenate(sets), return_inverse=True)
        first_at = np.concatenate(([0], np.cumsum(place)))
        first = np.searchsorted(grams, np.concatenate(before)) if first_at[-1] else np.empty(0, dtype=np.int64)
        mark, early = np.zeros(len(grams), dtype=np.int64), np.zeros(len(grams), dtype=bool)
        root = np.arange(len(sets))
        for i in range(1, len(sets)):
            low = int(np.searchsorted(n[:i], -(-percent * n[i] // 100)))
            js = np.arange(low, i)
            js = js[(root[js] != root[i]) & ((side[js] != side[i]) | (side[i] < 0))]
            need = needed(n[js], n[i], percent)
            ok = np.minimum(n[js] - place[js], n[i] - place[i]) >= need  # positional filter
            js, need = js[ok], need[ok]
            if not len(js):
                continue
            mine = rank[at[i] : at[i + 1]]
            mark[mine] = 1
            early[first[first_at[i] : first_at[i + 1]]] = True
            size = np.add.reduceat(mark[rank[at[low] : at[i]]], at[low:i] - at[low])[js - low]
            sums = np.concatenate(([0], np.cumsum(early[first[first_at[low] : first_at[i]]])))
            earlier = (sums[first_at[low + 1 : i + 1] - first_at[low]] - sums[first_at[low:i] - first_at[low]])[js - low]
            for j in js[(size >= need) & (earlier == 0)].tolist():
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    out.append((keys[i], keys[j]))
            mark[mine] = 0
            early[first[first_at[i] : first_at[i + 1]]] = False
        return pa.table({"u": pa.array([x for x, _ in out], pa.binary()), "v": pa.array([y for _, y in out], pa.binary())})

    return run


def join(docs: DataFrame, n: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "jaccard-join")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    fields = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("bits", pa.binary()), ("part", pa.int32()), ("chunk", pa.int32()), ("counts", pa.binary())])

    @frugal
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, part = np.zeros(1 << SKETCH_BITS, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            sizes, nodes, bits = [], [], []
            for b in texts(batch.column(1)):
                s = shingle_set(words(b)[2], n)
                sizes.append(len(s))
                nodes.append(_node(_hash(s), len(s)) if len(s) else None)
                bits.append(parity_bits(s) if len(s) else None)
                np.add.at(counts, _bucket(s), 1)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bits, pa.binary()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], schema=fields)
        chunks = counts.clip(0, 2**32 - 1).astype("<u4").reshape(-1, 1 << CHUNK_BITS)
        some = [i for i, c in enumerate(chunks) if c.any()]
        for i in some:
            yield pa.RecordBatch.from_pydict({"doc_id": [None], "n": [None], "node": [None], "bits": [None], "part": [part], "chunk": [i], "counts": [_packed(chunks[i])]}, schema=fields)

    measured = scratch.keep(rows.mapInArrow(measure, "doc_id long, n long, node binary, bits binary, part int, chunk int, counts binary"), "measured")
    sketch = spark.sparkContext.broadcast(_sketch(measured, scratch))

    @frugal
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            got: tuple[list, list, list] = ([], [], [])
            size = 0
            known = batch.column(0).is_valid().to_pylist()
            for ok, b in zip(known, texts(batch.column(1)), strict=True):
                s = shingle_set(words(b)[2], n) if ok else _NONE
                if not len(s) or (h := _hash(s)) in done:
                    continue
                if len(done) < COPIES:
                    done.add(h)
                p = rare_first(s, sketch.value, prefix_length(len(s), percent))
                got[0].append(p.view(np.int64))
                got[1].append(np.full(len(p), h))
                got[2].append(np.arange(len(p)) + (len(s) << 32))
                size += len(p)
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in got], names=["token", "h", "np"])
                    got, size = ([], [], []), 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in got], names=["token", "h", "np"])

    block = Window.partitionBy("token")
    postings = rows.mapInArrow(prefixes, "token long, h long, np long").repartition("token")
    shared = postings.withColumns({"a": F.min("h").over(block), "b": F.max("h").over(block)}).where("a <> b").select("token", "h", "np").distinct()
    size = F.shiftright("np", 32).cast("int")
    named = F.concat(F.unhex(F.lpad(F.hex("h"), 16, "0")), F.unhex(F.lpad(F.hex(size), 8, "0")))
    shared = shared.select("token", named.alias("node"), size.alias("n"), F.col("np").bitwiseAND(0xFFFFFFFF).cast("int").alias("place"))
    shared = scratch.keep(shared.withColumns({"nodes": F.count("*").over(block), "grams": F.sum("n").over(block), "shortest": F.min("n").over(block)}), "shared")
    # what passes the positional filter with no size that the block has and the length filter allows isn't dealt out
    partner = F.expr(f"greatest(shortest, ceil(n * {percent} / 100D))")
    may_pair = F.col("n") - F.col("place") >= F.ceil((F.col("n") + partner) * percent / F.lit(100.0 + percent))
    small, large = shared.where(F.col("nodes") <= SMALL), shared.where((F.col("nodes") > SMALL) & may_pair)
    a, b = (small.select("token", *(F.col(c).alias(f"{c}{i}") for c in ("node", "n", "place"))) for i in (1, 2))
    ordered = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("node1") < F.col("node2")))
    long_enough = F.col("n1") * 100 >= F.col("n2") * percent
    need = F.expr(f"-floor(-({percent} * (n1 + n2)) / {100 + percent}D)")
    positional = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) >= need
    pairs = scratch.keep(a.join(b, "token").where(ordered & long_enough & positional).select("node1", "node2").distinct(), "pairs")

    # one document and the parity bits of all nodes that are candidates or in large blocks
    met = pairs.select(F.col("node1").alias("w")).union(pairs.select("node2")).union(large.select("node")).distinct()
    known = measured.where("node is not null and doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "bits")).alias("least"))
    known = known.join(met, F.col("node") == F.col("w"), "left_semi").select("node", F.col("least.doc_id").alias("one"), "least.bits")
    known = scratch.keep(known, "known")

    @frugal
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for u, v, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                n1, n2 = (int.from_bytes(w[8:], "big") for w in (u, v))
                kept.append(least_difference(x, y) <= n1 + n2 - 2 * needed(n1, n2, percent))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    bits1, bits2 = (known.select(F.col("node").alias(f"node{i}"), F.col("bits").alias(f"bits{i}")) for i in (1, 2))
    marked = pairs.join(bits1, "node1").join(bits2, "node2").select("node1", "node2", "bits1", "bits2")
    pairs = scratch.keep(marked.mapInArrow(likely, "node1 binary, node2 binary"), "likely")

    # the sets of all nodes that are to be verified, each from one of its documents
    ends = pairs.select("node1").union(pairs.select("node2")).toDF("w").withColumn("large", F.lit(False))
    wanted = ends.union(large.select("node", F.lit(True))).groupBy("w").agg(F.max(~F.col("large")).alias("in_pair"), F.max("large").alias("in_large"))
    one = scratch.keep(known.join(wanted, F.col("node") == F.col("w")).select("node", "one", "in_pair", "in_large"), "one")
    scratch.drop("pairs", "known")
    if one.count() <= SENT_ROWS:
        one = F.broadcast(one)

    @frugal
    def regain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at, (node, b) in enumerate(zip(batch.column(1).to_pylist(), texts(batch.column(0)), strict=True)):
                s = shingle_set(words(b)[2], n)
                if _node(_hash(s), len(s)) == node:
                    kept.append((node, s.view(np.int64), at))
            rest = [batch.column(i).take(pa.array([k for *_, k in kept], pa.int64())) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, *_ in kept], pa.binary()), pa.array([s for _, s, _ in kept], pa.list_(pa.int64())), *rest], names=["node", "grams", "in_pair", "in_large"])

    texts_of = rows.join(one, F.col("doc_id") == F.col("one")).select("text", "node", "in_pair", "in_large")
    sets = scratch.keep(texts_of.mapInArrow(regain, "node binary, grams array<long>, in_pair boolean, in_large boolean"), "found-sets")
    if sets.groupBy("node").count().where("count > 1").limit(1).count():  # a doc_id came more than once with one text
        sets = scratch.keep(sets.dropDuplicates(["node"]), "sets")

    @frugal
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([np.array(g.values, dtype=np.int64).view(np.uint64) for g in batch.column(i)] for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array([links(x, y, percent) for x, y in zip(one, two, strict=True)], pa.bool_()))

    sets1, sets2 = (sets.where("in_pair").select(F.col("node").alias(f"node{i}"), F.col("grams").alias(f"grams{i}")) for i in (1, 2))
    both = pairs.join(sets1, "node1").join(sets2, "node2")
    found = scratch.keep(both.select(F.col("node1").alias("u"), F.col("node2").alias("v"), "grams1", "grams2").mapInArrow(verify, "u binary, v binary"), "found")
    if large.limit(1).count():
        dealt = large.withColumn("parts", F.greatest(F.ceil(F.col("grams") / F.lit(BLOCK_GRAMS)), F.lit(1)).cast("int")).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        meets = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.select("token", "node", "mine", meets.alias("other"))
        dealt = dealt.select("token", "node", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).alias("side"))
        within = dealt.join(sets.where("in_large").select("node", "grams"), "node").groupBy("token", "p", "q").applyInArrow(_block_links(sketch, percent), "u binary, v binary")
        found = found.union(scratch.keep(within, "within"))
    roots = scratch.keep(components(found, scratch), "roots")
    scratch.drop("shared", "one", "likely", "found-sets", "sets", "found", "within")

    documents = measured.where("chunk is null").select("doc_id", "n", "node")
    least = documents.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    least = least.select("node", "least", F.coalesce("root", "node").alias("root"))
    smallest = least.groupBy("root").agg(F.min("least").alias("component"))
    named = scratch.keep(least.join(smallest, "root").select(F.col("node").alias("of"), "component"), "named")
    out = documents.join(named, F.col("node") == F.col("of"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id. Rows of null doc_id stay;
    so do all rows of a doc_id that one of its rows keeps."""
    scratch = Scratch(docs.sparkSession, "keep-one")
    alone = F.max(F.col("doc_id") == F.col("component_id"))
    gone = join(docs, n, percent, doc_id, text).where("doc_id is not null").groupBy("doc_id").agg(alone.alias("__stays")).where("not __stays").select(F.col("doc_id").alias("__gone"))
    gone = scratch.keep(gone, "gone")
    if gone.count() <= SENT_ROWS:
        gone = F.broadcast(gone)
    return apart(docs, [doc_id, text], lambda d: d.join(gone, F.col(doc_id).cast("long") == F.col("__gone"), "left_anti"))
