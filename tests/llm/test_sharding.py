from collections import Counter

import pytest

from closebook.llm import sharding as s


def slow(shards, slots):
    owner, free = {}, slots
    starts = {x: s.preference(x, slots) for x in shards}
    tries = dict.fromkeys(shards, 0)
    while free:
        for x in sorted(shards):
            while free:
                at = (starts[x][0] + tries[x] * starts[x][1]) % slots
                tries[x] += 1
                if at not in owner:
                    owner[at], free = x, free - 1
                    break
    return [owner[i] for i in range(slots)]


def test_table_is_as_the_turns_say():
    names = [f"n{i}" for i in range(7)]
    assert [names[i] for i in s.lookup(names, 211)] == slow(names, 211)
    counts = Counter(s.lookup(names, 211))
    assert max(counts.values()) - min(counts.values()) <= 1
    assert [names[i] for i in s.lookup(names, 211)] == [names[::-1][i] for i in s.lookup(names[::-1], 211)]


def test_a_lost_shard_moves_little_else():
    names = [f"n{i}" for i in range(10)]
    old, new = s.lookup(names, 10_007), s.lookup(names[:-1], 10_007)
    moved = sum(a != b for a, b in zip(old, new) if a != 9)
    assert moved < 0.1 * 10_007


@pytest.mark.parametrize("slots", [4, 1, 100])
def test_slots_must_be_a_prime_that_holds_the_shards(slots):
    with pytest.raises(ValueError):
        s.lookup(["a", "b", "c"], slots)


def test_odd_rows(odd_docs, no_docs):
    found = s.assign_shards(odd_docs.withColumn("slot", odd_docs.doc_id), "doc_id", ["a", "b", "c"], 31)
    assert found.count() == odd_docs.count()
    owner = s.lookup(["a", "b", "c"], 31)
    assert all(r.shard == ["a", "b", "c"][owner[r.slot]] for r in found.collect())
    assert s.assign_shards(no_docs, "doc_id", ["a"], 31).count() == 0
