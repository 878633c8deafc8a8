import numpy as np
import pytest

from closebook.llm import top_k as t


def brute(rows, k, every):
    out = []
    use = [(i, np.floor(np.array(v, dtype=float) * 1024).astype(int)) for i, v in rows
           if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, x in {(i, tuple(v)) for i, v in use if i % every == 0}:
        scored = sorted((-int(np.dot(x, v)), i) for i, v in use if i != q and len(v) == len(x))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    draws = np.random.default_rng(seed)
    near = draws.standard_normal((20, 12)) * 3
    rows = [(i, (near[i % 20] + draws.standard_normal(12) * 0.3).tolist()) for i in range(1500)]
    rows += [(i, rows[7][1]) for i in range(1500, 1560)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in t.top_k(df, 10, 100).collect())
    assert found == brute(rows, 10, 100)


def test_small_leaves_prune_and_stay_exact():
    draws = np.random.default_rng(3)
    vectors = np.floor(draws.standard_normal((3000, 6)) * 100)
    queries = np.floor(draws.standard_normal((40, 6)) * 100)
    best = t.Best(np.full(40, -1), 5, np.full(40, -np.inf))
    t.search(t.Tree(vectors, 16), np.arange(3000), queries, best)
    want = np.sort(queries @ vectors.T, axis=1)[:, ::-1][:, :5]
    assert (best.scores == want).all()


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, None, 2), (2, [None, 1.0], 3), (3, [float("nan"), 1.0], 3),
            (4, [float("inf"), 1.0], 3), (None, [1.0, 1.0], 3), (5, [2.0, 2.0], 3), (6, [2.0, 2.0], 3), (7, [1.0], 3),
            (8, [], 3), (100, [3.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in t.top_k(df, 2, 100).collect())
    two, half = 1024 * 1024, 1024 * 1024
    assert [x for x in found if x[0] == 0] == [(0, 1, 5, 6 * two), (0, 2, 6, 6 * half)]
    assert t.top_k(df.where("false")).count() == 0
