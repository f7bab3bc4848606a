"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the rows (``SAMPLE`` of them, those with the smallest key hashes) the graph of
nearest neighbours is built exactly and cut into balanced partitions: from balanced seeds, every vector
moves to the partition that most of its neighbours are in, as long as there is room. A small
classifier (softmax regression on the unit vectors) then learns each vector's distribution of
neighbours over partitions. Every row of the table is indexed under its most probable partition. A
query goes to as many partitions as it takes for the recall measured on sample queries, against brute
force, to reach ``RECALL``; where vectors have no structure that is nearly all of them. Candidates are
reranked by exact cosine in double precision on the original vectors.

Partitions that hold many rows are split by hash into cells of bounded size, all of which a query of
that partition meets. Null, zero and unsound vectors take no part (see ``vectors``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .tables import Scratch, ship

SAMPLE, NEIGHBOURS, PARTITIONS, RECALL = 10_000, 10, 16, 0.96
#: A partition for so many rows, PARTITIONS at least and so many at most (the sample has about 80 rows of each).
ROWS_A_PARTITION, MOST = 8192, 128
FOUND = "query string, query_id long, vec_id long, score double"


def neighbour_graph(u: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of each unit vector's k nearest others, in blocks."""
    out = np.empty((len(u), k), dtype=np.int64)
    for at in range(0, len(u), 1024):
        s = u[at : at + 1024] @ u.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(graph: np.ndarray, u: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """A partition of the graph's nodes in which none has over 1.05 times its share."""
    n = len(u)
    room = int(np.ceil(1.05 * n / parts))
    centre = u[rng.choice(n, parts, replace=False)]
    label = np.full(n, -1)
    for _ in range(rounds):  # balanced seeds: nodes choose centres, the surest first, while there is room
        s = u @ centre.T
        label[:] = -1
        left = np.full(parts, room)
        order = np.argsort(-s, axis=1)
        for i in np.argsort(-(s.max(axis=1))):
            for p in order[i]:
                if left[p]:
                    label[i] = p
                    left[p] -= 1
                    break
        centre = np.stack([u[label == p].mean(axis=0) if (label == p).any() else centre[p] for p in range(parts)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    both = [*map(list, graph)]
    for i, near in enumerate(graph):
        for j in near:
            both[j].append(i)
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):  # refinement on the graph
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(label[both[i]], minlength=parts)
            votes[(size >= room) & (np.arange(parts) != label[i])] = -1
            p = int(votes.argmax())
            if votes[p] > votes[label[i]]:
                size[label[i]] -= 1
                size[p] += 1
                label[i] = p
                moved += 1
        if moved < n // 200:
            break
    return label


class Router:
    """Softmax regression from unit vectors to partitions, and how many partitions a query goes to."""

    def __init__(self, dim: int, parts: int):
        self.w, self.b, self.probes = np.zeros((dim, parts)), np.zeros(parts), parts

    def scores(self, u: np.ndarray) -> np.ndarray:
        return u @ self.w + self.b

    def fit(self, u: np.ndarray, target: np.ndarray, steps: int = 300, rate: float = 4.0) -> None:
        for t in range(steps):
            s = self.scores(u)
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - target) / len(u)
            r = rate * (1 - t / steps) * 10
            self.w -= r * (u.T @ g + 1e-5 * self.w)
            self.b -= r * g.sum(axis=0)


def learn(x: np.ndarray, parts: int = PARTITIONS, recall: float = RECALL, k: int = 5, seed: int = 11) -> Router:
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    if len(u) < 4 * parts:
        return Router(x.shape[1], 1)
    near = min(NEIGHBOURS, len(u) - 1)
    graph = neighbour_graph(u, near)
    label = balanced_partition(graph, u, parts, np.random.default_rng(seed))
    target = np.zeros((len(u), parts))
    for column in graph.T:
        target[np.arange(len(u)), label[column]] += 1 / (near + 1)
    target[np.arange(len(u)), label] += 1 / (near + 1)
    router = Router(x.shape[1], parts)
    router.fit(u, target)
    s = router.scores(u)
    index, tested = s.argmax(axis=1), np.random.default_rng(seed).permutation(len(u))[:1000]
    order = np.argsort(-s[tested], axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    sims = u[tested] @ u.T
    sims[np.arange(len(tested)), tested] = -np.inf
    exact = np.argpartition(-sims, min(k, len(u) - 1) - 1, axis=1)[:, :k]
    at = np.take_along_axis(place, index[exact], axis=1)
    for m in range(1, parts + 1):
        router.probes = m
        if (at < m).mean() >= recall:
            break
    return router


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            matrix = lambda t, c: np.array(t.column(c).combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)
            x, q, ids = matrix(left, "vec"), matrix(right, "q_vec"), np.array(left.column("vec_id"))
            nx, nq = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            about = (q / nq[:, None]) @ (x / nx[:, None]).T
            for i, (key, own) in enumerate(zip(right.column("q_key").to_pylist(), right.column("q_vec_id").to_pylist(), strict=True)):
                s = np.where(ids == own, -np.inf, about[i])
                cut = np.partition(s, -k)[-k] if len(s) > k else -np.inf
                near = np.flatnonzero((s >= cut - 1e-9) & (s > -np.inf))
                #: The exact measure, summed in the same order wherever a row stands.
                score = (x[near] * q[i]).sum(axis=1) / (nx[near] * nq[i])
                keep = np.lexsort((ids[near], -score))[:k]
                out["query"] += [key] * len(keep)
                out["query_id"] += [own] * len(keep)
                out["vec_id"] += ids[near][keep].tolist()
                out["score"] += score[keep].tolist()
        return pa.table(out, schema=pa.schema([("query", pa.string()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return run


def search(df: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine) for each query, a row whose id is divisible by ``every``."""
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "ann-search")
    nonzero = F.exists("vec", lambda x: x != 0)
    rows = scratch.keep(vectors.clean(df, vec_id, vector).where(nonzero), "rows")
    dims = [(r["dim"], r["count"]) for r in rows.groupBy("dim").count().orderBy(F.desc("count")).limit(64).collect()]
    routers: dict[int, Router] = {}
    for dim, n in dims:  # one router for each vector length; lengths beyond these share one partition
        got = rows.where(F.col("dim") == dim).orderBy("key").limit(sample).select("vec").toArrow()
        x = np.array(got.column("vec").combine_chunks().flatten(), dtype=np.float64).reshape(got.num_rows, -1)
        routers[dim] = learn(x, parts=min(max(PARTITIONS, n // ROWS_A_PARTITION), MOST), k=k)
    shared = spark.sparkContext.broadcast(routers)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for vec, is_query in zip(batch.column("vec"), batch.column("is_query").to_pylist(), strict=True):
                x = np.array(vec.values, dtype=np.float64)
                router = shared.value.get(len(x))
                if router is None:
                    parts.append([0])
                    continue
                order = np.argsort(-router.scores(x / np.sqrt((x * x).sum())), kind="stable")
                parts.append(order[: router.probes if is_query else 1].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int32()))], names=[*batch.schema.names, "parts"])

    flagged = rows.withColumn("is_query", F.col("vec_id") % every == 0)
    routed = scratch.keep(flagged.mapInArrow(route, flagged.withColumn("parts", F.array(F.lit(0))).schema), "routed")
    indexed = routed.withColumn("part", F.col("parts")[0]).drop("parts")
    counts = indexed.groupBy("dim", "part").agg(F.count("*").alias("n")).select("dim", "part", vectors.cells_of(F.col("n"), vectors.CELL_ROWS).alias("cells"))
    blocks = vectors.cells_of(F.lit(routed.where("is_query").count()), vectors.CELL_QUERIES)
    key = ["dim", "part", "cell", "block"]
    data = indexed.join(counts, ["dim", "part"]).withColumn("cell", vectors.spread(F.col("key"), F.col("cells")))
    data = data.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(*key, "vec_id", "vec")
    queries = routed.where("is_query").withColumn("block", vectors.spread(F.col("key"), blocks)).withColumn("part", F.explode("parts"))
    queries = queries.join(counts, ["dim", "part"]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(*[F.col(c).alias(f"q_{c}") for c in (*key, "key", "vec_id", "vec")])
    return vectors.best(data.groupBy(*key).cogroup(queries.groupBy(*[f"q_{c}" for c in key])).applyInArrow(_cell(k), FOUND), k, "double")
