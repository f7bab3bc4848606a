import numpy as np
import pytest
from conftest import same_rows

from millrace.llm import ann_search, kd_search, queries, vectors


def table(spark, n=1200, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[1] = x[0]
    rows = [(i, v.tolist(), "k") for i, v in enumerate(x)]
    rows += [(n, None, "k"), (n + 1, [None] * dim, "k"), (n + 2, [float("nan")] * dim, "k"), (n + 3, [float("inf")] * dim, "k"), (n + 4, [1.0, 2.0], "k"), (0, x[0].tolist(), "k"), (None, x[3].tolist(), "k")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string"), x


def exact(score, n, k):
    out = {}
    for q in range(0, n, 50):
        ids = [i for i in np.lexsort((np.arange(n), -score[q])) if i != q][:k]
        out[q] = [(int(i), score[q, i]) for i in ids]
    return out


@pytest.mark.parametrize("cell", [100_000, 150])
def test_kd_search_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL_ROWS", cell)
    monkeypatch.setattr(kd_search, "LEAF", 16)
    df, x = table(spark)
    y = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    got = {}
    for r in kd_search.top_k(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == exact(y @ y.T, len(x), 5)
    assert kd_search.top_k(df.limit(0)).count() == 0


def test_kd_search_query_equals_its_sql(spark, duck, sf):
    same_rows(queries.op3_kd_search(spark, sf), duck, queries.OP3_SQL)


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in kd_search.top_k(df).collect()] == [(0, 1, 1)]
    assert [(r.query_id, r.rank, r.vec_id) for r in ann_search.search(df).collect()] == [(0, 1, 1)]


@pytest.mark.parametrize("cell", [100_000, 40])
def test_ann_recall_and_scores(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL_ROWS", cell)
    df, x = table(spark)
    zero = spark.createDataFrame([(5000, [0.0] * 12, "k")], df.schema)
    x = x.astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = exact(u @ u.T, len(x), 5)
    rows = ann_search.search(df.unionByName(zero)).collect()
    found = {(r.query_id, r.vec_id): r.score for r in rows}
    hit = sum((q, i) in found for q, near in want.items() for i, _ in near)
    assert hit / sum(map(len, want.values())) >= 0.9 and 5000 not in {r.vec_id for r in rows}
    assert all(s == pytest.approx(u[q] @ u[i], abs=1e-12) for (q, i), s in found.items())
    assert ann_search.search(df.limit(0)).count() == 0


def test_products_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**23), 2**23, size=(300, 3)) * 1.0 + rng.integers(0, 256, size=(300, 3)) / 256
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    y = [[int(np.floor(256 * v)) for v in row] for row in x]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for q in range(0, 300, 50):
        order = sorted((-sum(a * b for a, b in zip(y[q], y[i], strict=True)), i) for i in range(300) if i != q)[:5]
        got = [(-r.score, r.vec_id) for r in kd_search.top_k(df).where(f"query_id = {q}").orderBy("rank").collect()]
        assert got == order


def test_more_rows_get_more_partitions(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "ROWS_A_PARTITION", 40)
    seen, learn = [], ann_search.learn
    monkeypatch.setattr(ann_search, "learn", lambda x, parts, k: (seen.append(parts), learn(x, parts, k=k))[1])
    ann_search.search(table(spark)[0])
    assert max(seen) == 30
