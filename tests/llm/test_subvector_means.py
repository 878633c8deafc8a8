import hashlib
import random

import numpy as np
import pytest

from closebook.llm import subvector_means as means

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance long"


def brute(rows, k=8, rounds=10, dims=64):
    """Plain rounds with Python's whole numbers."""
    kept = [(i, [int(np.floor(x * 1024.0)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in kept)
    centroids = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((gaps.index(min(gaps)), min(gaps)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (a, _) in zip(kept, own) if a == c]
            if members:
                centroids[c] = [sum(column) // len(members) for column in zip(*members)]
    own = assign()
    total = sum(d for _, d in own)
    inertia = [sum(d for a, d in own if a == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, a, d, inertia[a], total, digest[a]) for (i, _), (a, d) in zip(kept, own)), key=str)


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    found = means.cluster_vectors(df, **options)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, found.select(*columns).collect()), key=str)


def vectors(seed, n, dims, of=None):
    rng = random.Random(seed)
    return [(i, [rng.choice(of) if of else rng.gauss(0, 0.2) for _ in range(dims)]) for i in range(n)]


def test_equal_to_brute_force(spark):
    rows = vectors(1, 300, 64)
    assert clustered(spark, rows) == brute(rows)


def test_repeating_values_and_ties(spark):
    rows = vectors(2, 400, 6, [-0.25, 0.0, 0.25])
    assert clustered(spark, rows, dims=6) == brute(rows, dims=6)


def test_a_third_of_all_vectors_are_equal(spark):
    rows = [(i, [0.5] * 4 if i % 3 == 0 else v) for i, v in vectors(3, 300, 4)]
    assert clustered(spark, rows, dims=4, k=3) == brute(rows, dims=4, k=3)


def test_odd_rows(spark):
    good = vectors(4, 20, 3)
    rows = [*good, (50, None), (51, []), (52, [1.0, 2.0]), (53, [1.0, None, 2.0]), (54, [1.0, float("nan"), 2.0]),
            (55, [1.0, float("inf"), 2.0]), (1, good[1][1]), (1, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0])]
    assert clustered(spark, rows, dims=3, k=5) == brute(rows, dims=3, k=5)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(5, 3, 2)
    assert clustered(spark, rows, dims=2) == brute(rows, dims=2)
    assert clustered(spark, [], dims=2) == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [x * 3e5 for x in v]) for i, v in vectors(6, 60, 2)]
    assert clustered(spark, rows, dims=2, k=3) == brute(rows, dims=2, k=3)
    with pytest.raises(Exception, match="62 bits"):
        clustered(spark, [(1, [1e18, 0.0]), (2, [0.0, 0.0])], dims=2)


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(7)
    for high in (2, 5, 10_000):
        values = rng.integers(-high, high, (500, 16))
        blocks = means.dictionaries(values)
        assert np.array_equal(np.hstack([entries[codes] for _, entries, codes in blocks]), values)
        for _, entries, _ in blocks:
            assert len(np.unique(entries, axis=0)) == len(entries)
    assert len(means.dictionaries(rng.integers(0, 2, (500, 16)))) < 16  # neighbours share a dictionary where it pays
