"""Exact top-k by inner product over KD-trees, one for each shard of the rows.

Components become floor(SCALE * x), so scores are integers and ties are exact. A tree splits at the
median of its widest dimension down to leaves of ``LEAF`` rows and keeps each node's tight box. A query
walks it best first: the queue is ordered by the largest inner product that a box allows, and a node
whose bound is below the kth score so far ends the walk. Each query first meets its home shard; the
kth score found there goes with it to all other shards. A bound equal to the kth score is followed,
since ties go to smaller ids. Products are exact: in doubles as long as these hold every sum, else in
whole numbers of any size. Nulls and repeated rows: see ``vectors``. Fewer than k candidates give
fewer rows, an empty table none.
"""

from __future__ import annotations

import heapq
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .tables import Scratch, ship

SCALE, LEAF = 256, 128
FOUND = "query string, query_id long, vec_id long, score decimal(38,0)"


class Tree:
    """Rows of doubles that hold integers; ids ascend with equal scores when results are cut."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.lo, self.hi, self.children, self.leaf = [], [], [], []
        order = np.arange(len(x))
        todo = [(order, None)]
        self.rows: list[np.ndarray] = []
        while todo:
            rows, parent = todo.pop()
            node = len(self.lo)
            if parent is not None:
                self.children[parent].append(node)
            part = x[rows]
            lo, hi = part.min(axis=0), part.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.children.append([])
            if len(rows) <= LEAF or (lo == hi).all():
                self.leaf.append(len(self.rows))
                self.rows.append(rows)
                continue
            self.leaf.append(-1)
            mid, by = len(rows) // 2, np.argpartition(part[:, int(np.argmax(hi - lo))], len(rows) // 2)
            todo += [(rows[by[:mid]], node), (rows[by[mid:]], node)]
        self.low, self.high = np.array(self.lo), np.array(self.hi)
        self.points = [x[r] for r in self.rows]
        self.ids = [ids[r] for r in self.rows]
        self.largest = float(np.abs(x).max()) if x.size else 0.0

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The largest inner product of each query (row) with any point of each node's box."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T

    def _whole(self, leaf: int) -> np.ndarray:
        return np.array([[int(v) for v in row] for row in self.points[leaf]], dtype=object)

    def search(self, q: np.ndarray, bound: np.ndarray, own: int, k: int, kth: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the query's k best here that may still count, given a kth score from elsewhere."""
        ids, scores = np.empty(0, dtype=np.int64), np.empty(0)
        #: Beyond 2^53 doubles don't hold the sums: then in whole numbers, and bounds with room for rounding.
        slack = float(np.abs(q).sum()) * self.largest
        exact = slack < 2.0**53
        whole = None
        if not exact:
            whole = np.array([int(v) for v in q], dtype=object)
            bound, scores = bound + slack * 1e-12, scores.astype(object)
        queue = [(-bound[0], 0)]
        while queue:
            b, node = heapq.heappop(queue)
            if -b < kth:
                break
            if (leaf := self.leaf[node]) < 0:
                for c in self.children[node]:
                    if bound[c] >= kth:
                        heapq.heappush(queue, (-bound[c], c))
                continue
            s, i = self.points[leaf] @ q if exact else self._whole(leaf) @ whole, self.ids[leaf]
            good = (s >= kth) & (i != own)
            if good.any():
                ids, scores = np.concatenate((ids, i[good])), np.concatenate((scores, s[good]))
                if len(ids) > k:
                    keep = np.lexsort((ids, -scores))[:k] if exact else np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k])
                    ids, scores = ids[keep], scores[keep]
                if len(ids) >= k:
                    kth = max(kth, scores.min())
        return ids, scores


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            matrix = lambda t, c: np.array(t.column(c).combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)
            tree, q = Tree(matrix(left, "vec"), np.array(left.column("vec_id"))), matrix(right, "q_vec")
            for i, (key, own, kth) in enumerate(zip(*(right.column(c).to_pylist() for c in ("q_key", "q_vec_id", "q_kth")), strict=True)):
                ids, scores = tree.search(q[i], tree.bounds(q[i : i + 1])[0], own, k, -np.inf if kth is None else int(kth))
                out["query"] += [key] * len(ids)
                out["query_id"] += [own] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += [Decimal(int(x)) for x in scores]
        return pa.table(out, schema=pa.schema([("query", pa.string()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))]))

    return run


def top_k(df: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each query, a row whose id is divisible by ``every``."""
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "kd-search")
    rows = vectors.clean(df, vec_id, vector).withColumn("vec", F.transform("vec", lambda x: F.floor(x * SCALE).cast("double")))
    is_query = F.col("vec_id") % every == 0
    rows = scratch.keep(rows.withColumn("is_query", is_query), "rows")
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"))
    plan = F.broadcast(counts.select("dim", vectors.cells_of(F.col("n"), vectors.CELL_ROWS).alias("shards"), vectors.cells_of(F.col("q"), vectors.CELL_QUERIES).alias("blocks")))
    dealt = rows.join(plan, "dim").withColumns({"shard": vectors.spread(F.col("key"), F.col("shards")), "block": vectors.spread(F.col("key"), F.col("blocks"))})
    data = dealt.drop("block", "is_query").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = dealt.where("is_query").withColumnRenamed("shard", "home").withColumn("kth", F.lit(None).cast("decimal(38,0)"))
    cell = ["dim", "shard", "block"]
    columns = [*cell, "key", "vec_id", "vec"]

    def search(q: DataFrame) -> DataFrame:
        q = q.select(*[F.col(c).alias(f"q_{c}") for c in (*columns, "kth")])
        return data.select(*columns).groupBy(*cell).cogroup(q.groupBy(*[f"q_{c}" for c in cell])).applyInArrow(_cell(k), FOUND)

    first = scratch.keep(search(queries.withColumn("shard", F.col("home"))), "first")
    kth = first.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    away = queries.drop("kth").join(kth.withColumnRenamed("query", "key"), "key", "left")
    away = away.withColumn("shard", F.explode(F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != F.col("home"))))
    return vectors.best(first.unionByName(search(away)), k, "long")
