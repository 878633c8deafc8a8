from collections import Counter

import pytest

from closebook.llm import mixing as m


def filled(sizes, weights, repeats):
    """Targets by handing the excess of full sources to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > repeats * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: repeats * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, None: 50}, {"a": 0, "b": 9}, {"a": 5}, {"b": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    found = {r.source: r.target for r in m.source_targets(rows).collect()}
    want = filled(sizes, m.WEIGHTS, m.REPEATS)
    assert found == pytest.approx({s: want.get(s, 0.0) for s in sizes})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 40 + 1)), "abc"[min(i % 7, 2)]) for i in range(600)]
    rows += [(1000, "x " * 5000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_come_near_their_targets(docs):
    found = m.mix(docs, blocks=64, shards=4).collect()
    assert len(found) == 601
    taken = Counter()
    for r in found:
        assert len({d.epoch for d in r.draws}) == len(r.draws) <= 3
        taken[r.source] += r.size * len(r.draws)
    for r in found:
        longest = max(x.size for x in found if x.source == r.source)
        assert abs(taken[r.source] - r.target) <= longest
    again = {r.doc_id: r.draws for r in m.mix(docs.repartition(5), blocks=64, shards=4).collect()}
    assert again == {r.doc_id: r.draws for r in found}


def test_shards_share_out_all_blocks(spark, docs):
    quotas = spark.createDataFrame([(["a", "b", None], [40, 7, 1])], "sources array<string>, quotas array<long>")
    leaves = m.shard_quotas(quotas, 8).collect()
    assert [r.shard for r in sorted(leaves, key=lambda r: r.shard)] == list(range(8))
    assert [sum(r.quotas[i] for r in leaves) for i in range(3)] == [40, 7, 1]
    assert {sum(r.quotas) for r in leaves} == {6}
    rows = m.shard_rows(m.mix(docs, blocks=64, shards=4))
    assert {r["shard"] for r in rows.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_draws_are_hypergeometric(spark):
    """The share of a source on the left varies as a draw without replacement does."""
    nodes = spark.range(2000).selectExpr("id as node", "array(6L, 10L) as quotas")
    left = nodes.select(m.split(nodes.quotas, nodes.node, 1).alias("x")).collect()
    assert {sum(r.x) for r in left} == {8}
    mean = sum(r.x[0] for r in left) / 2000
    variance = sum((r.x[0] - mean) ** 2 for r in left) / 2000
    assert abs(mean - 3) < 0.1
    assert abs(variance - 8 * (6 / 16) * (10 / 16) * (8 / 15)) < 0.1


def test_odd_rows(odd_docs, no_docs):
    found = m.mix(odd_docs, blocks=16, shards=2)
    assert found.count() == odd_docs.count()
    assert found.columns.count("size") == 1
    assert m.mix(no_docs, blocks=16, shards=2).count() == 0
    wordless = m.mix(odd_docs.where("doc_id in (3, 4, 5)"), blocks=16, shards=2)
    assert {(r.size, r.target) for r in wordless.collect()} == {(0, 0.0)}


def test_written_shards_are_shuffled_and_whole(spark, docs, tmp_path):
    mixed = m.mix(docs, blocks=64, shards=4)
    m.write_shards(mixed, str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.count() == m.shard_rows(mixed).count()
