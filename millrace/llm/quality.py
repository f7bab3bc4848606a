"""Quality by naive Bayes support vectors.

Features are indicators of n-grams: the text's two-, three- and four-byte grams, its words and word
pairs, and whether any word stands twice or three times in a row, hashed to ``1 << BITS`` numbers. Each is scaled by the log ratio of its smoothed share in the two
classes, the vector is brought to unit length, and a linear hinge-loss model is fitted by dual
coordinate descent. A logistic curve, fitted on labelled documents held back, gives the probability.

Labelled rows are taken in the order of a hash of doc_id, at most ``SAMPLE`` of each class; nothing but
their texts and labels enters. Null and empty texts have no features and score by the intercept.
Repeated rows are scored each; doc_id may be null; an empty table gives an empty table. Without labels
of both classes every score is 1 (nothing speaks against a text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .tables import Scratch, ship
from .words import gram_hashes, mixed, texts, words

SAMPLE, BITS, ROUNDS, COST = 1500, 17, 15, 1.0
_BLOCK = 1 << 20


def features(b: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams that a text has; ``mark`` is 1 << BITS false values, left as found."""
    if not len(b):
        return np.empty(0, dtype=np.int64)
    shift = np.uint64(64 - BITS)
    for at in range(0, len(b), _BLOCK):  # bounds the memory that a very long text takes
        x = b[max(at - 3, 0) : at + _BLOCK].astype(np.uint64)
        for n in (2, 3, 4):
            if len(x) >= n:
                code = np.full(len(x) - n + 1, n, dtype=np.uint64)
                for i in range(n):
                    code = code * np.uint64(256) + x[i : len(x) - n + 1 + i]
                mark[(code * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)] = True
    h = words(b)[2]
    mark[(h >> shift).astype(np.int64)] = True
    mark[(gram_hashes(h, 2) >> shift).astype(np.int64)] = True
    again = h[1:] == h[:-1]  # the pairs and triples of one word with itself, whatever the word
    for n in (1, 2):
        if len(again) >= n and (again[n - 1 :] & again[: len(again) - n + 1]).any():
            mark[n] = True
    out = np.flatnonzero(mark)
    mark[out] = False
    return out


class Model:
    def fit(self, docs: list[np.ndarray], y: np.ndarray) -> None:
        """y: +1 or -1 for each document."""
        n = 1 << BITS
        share = []
        for of in (1, -1):
            c = np.ones(n)
            for d, label in zip(docs, y, strict=True):
                if label == of:
                    c[d] += 1
            share.append(np.log(c / c.sum()))
        self.ratio = share[0] - share[1]
        #: Grams that one document of the sample has say nothing.
        seen = np.zeros(n, dtype=np.int64)
        for d in docs:
            seen[d] += 1
        self.ratio[seen < 3] = 0.0
        values = [self.ratio[d] / self._norm(d) for d in docs]
        cost = np.where(y > 0, COST * len(y) / (2 * max((y > 0).sum(), 1)), COST * len(y) / (2 * max((y < 0).sum(), 1)))
        w, bias, alpha = np.zeros(n), 0.0, np.zeros(len(docs))
        rng = np.random.default_rng(3)
        for _ in range(ROUNDS):
            for i in rng.permutation(len(docs)):
                d, v = docs[i], values[i]
                q = v @ v + 1.0
                g = y[i] * (w[d] @ v + bias) - 1
                new = min(max(alpha[i] - g / q, 0.0), cost[i])
                if new != alpha[i]:
                    step = (new - alpha[i]) * y[i]
                    w[d] += step * v
                    bias += step
                    alpha[i] = new
        self.weights, self.bias = w * self.ratio, bias

    def _norm(self, d: np.ndarray) -> float:
        r = self.ratio[d]
        return max(float(np.sqrt(r @ r)), 1e-9)

    def margin(self, d: np.ndarray) -> float:
        return float(self.weights[d].sum() / self._norm(d) + self.bias) if len(d) else float(self.bias)

    def calibrate(self, docs: list[np.ndarray], y: np.ndarray) -> None:
        x = np.column_stack([[self.margin(d) for d in docs], np.ones(len(docs))])
        t, w = (y > 0).astype(float), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(2), x.T @ (t - p) - 1e-2 * w)
        self.curve = w

    def score(self, d: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(d) * self.curve[0] + self.curve[1], -30, 30))))


def learn(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int = SAMPLE) -> Model | None:
    """docs: doc_id, text; labels: doc_id and the 0/1 column; train: which doc_ids may be learnt from."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "quality")
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(train & F.col("y").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y")).withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    some = known.where("y = 1").orderBy("h", "doc_id").limit(sample).unionByName(known.where("y = 0").orderBy("h", "doc_id").limit(sample))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            got = [features(b, mark).astype(np.int32) for b in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int32())), batch.column(1), batch.column(2)], names=["grams", "y", "h"])

    #: At most 2 * sample ids, so the broadcast is bounded.
    got = docs.join(F.broadcast(scratch.keep(some, "sample")), "doc_id").select("text", "y", "h").mapInArrow(found, "grams array<int>, y int, h long")
    got = scratch.keep(got, "grams").toArrow().sort_by("h")
    rows = [np.array(v.values, dtype=np.int64) for v in got.column("grams")]
    y = np.where(np.array(got.column("y").to_pylist(), dtype=np.int64) > 0, 1, -1)
    if len(set(y.tolist())) < 2:
        return None
    model, held = Model(), np.arange(len(rows)) % 4 == 0
    model.fit([rows[i] for i in np.flatnonzero(~held)], y[~held])
    model.calibrate([rows[i] for i in np.flatnonzero(held)], y[held])
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1) in place of any of that name."""
    spark = docs.sparkSession
    ship(spark)
    rest = docs.drop("score")
    if model is None:
        return rest.withColumn("score", F.lit(1.0))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, mark = shared.value, np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            got = [m.score(features(b, mark)) for b in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, "score"])

    return rest.mapInArrow(run, StructType([*rest.schema, StructField("score", DoubleType())]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    few = docs.select("doc_id", "text")
    out = score(few, learn(few, labels, "quality", ~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
