import random

import pytest
from pyspark.sql import functions as F

from closebook.operators.ordering import ranks, row_numbers


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one scope and one leading key."""
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0
        rows.append(("hot" if hot else rng.choice("abc"), 7 if hot else rng.randrange(50), i, rng.randrange(40)))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "scope string, lead int, id int, value int").repartition(8)


def brute(rows, scope, key):
    numbers, seen = {}, {}
    for row in sorted(rows, key=key):
        seen[scope(row)] = seen.get(scope(row), 0) + 1
        numbers[row[2]] = seen[scope(row)]
    return numbers


def test_row_numbers_per_scope(skewed):
    rows, df = skewed
    found = {r.id: r.rn for r in row_numbers(df, ["lead", "id"], ["scope"]).collect()}
    assert found == brute(rows, lambda r: r[0], lambda r: (r[1], r[2]))


def test_row_numbers_over_all(skewed):
    rows, df = skewed
    found = {r.id: r.rn for r in row_numbers(df, [F.desc("lead"), "id"]).collect()}
    assert found == brute(rows, lambda r: 0, lambda r: (-r[1], r[2]))


def test_hot_scope_is_spread(skewed):
    """The hot scope must not end up in one sort partition."""
    from closebook.operators.ordering import sorted_runs

    _, df = skewed
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, runs = sorted_runs(df, ["lead", "id"], ["scope"])
        hot = runs.where("scope = 'hot'").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) >= 2
    assert max(r["_rows"] for r in hot) <= 6000 / 8 * 2


def test_null_scope_is_a_scope(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "scope string, id int")
    assert sorted((r.id, r.rn) for r in row_numbers(df, ["id"], ["scope"]).collect()) == [(1, 1), (2, 2), (3, 1)]


def test_empty(spark):
    df = spark.createDataFrame([], "scope string, id int")
    assert row_numbers(df, ["id"], ["scope"]).collect() == []


def test_ranks_share_ties(skewed):
    rows, df = skewed
    found = {r.id: r.best for r in ranks(df, "value", ["id"], "best", ["scope"]).collect()}
    for scope, _, identity, value in rows:
        better = sum(1 for r in rows if r[0] == scope and r[3] > value)
        assert found[identity] == better + 1


def test_rank_of_missing_values_is_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id int, value int")
    assert sorted((r.id, r.best) for r in ranks(df, "value", ["id"], "best").collect()) == [(1, 2), (2, 1), (3, 2)]
