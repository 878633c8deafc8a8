"""The join against all pairs, on texts built to sit on both sides of the threshold."""

import random

import numpy as np
import pytest

from closebook.llm import near_join
from closebook.llm.near_join import near_duplicates
from closebook.llm.shingles import shingle_sets, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = [w for w in (text or "").translate(LOWER).replace("\v", " ").replace("\f", " ").split() if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, num, den):
    ids = [i for i, _ in rows]
    sets = [shingles(t, width) for _, t in rows]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and den * both >= num * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(ids[x]), root(ids[y])))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def variants(seed, n_base=12, copies=9):
    draws = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for b in range(n_base):
        base = [draws.choice(words) for _ in range(draws.choice([2, 5, 12, 40, 120, 300]))]
        for c in range(copies):
            text = list(base)
            for _ in range(draws.randint(0, max(1, len(base) // 25))):
                place = draws.randrange(len(text))
                if draws.random() < 0.5:
                    text[place] = draws.choice(words)
                else:
                    text.insert(place, draws.choice(words))
            rows.append((i * 3 % 331, draws.choice([" ", "  ", "\n"]).join(text)))
            i += 1
    return rows


@pytest.mark.parametrize(("seed", "width", "num"), [(1, 3, 90), (2, 5, 80), (3, 1, 70)])
def test_equals_all_pairs(spark, seed, width, num):
    rows = variants(seed)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, num, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, width, num, 100)


def test_a_family_larger_than_its_leaders(spark):
    draws = random.Random(4)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(120):
        text = list(base)
        for place in draws.sample(range(150), 2):
            text[place] = f"x{draws.randrange(9)}"
        rows.append((i, " ".join(text)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 3, 90, 100)


def test_odd_rows(odd_docs, no_docs):
    found = {r.doc_id: r.component_id for r in near_duplicates(odd_docs, 3, 90, 100).collect()}
    assert found[1] == found[2] == 1
    assert found[7] == found[8] == 7
    assert found[3] == 3 and found[4] == 4 and found[5] == 5 and found[6] == 6
    assert found[None] is None or found[None] == 1
    assert near_duplicates(odd_docs).count() == odd_docs.count()
    assert near_duplicates(no_docs).count() == 0


def test_words_are_runs_of_non_blanks():
    hashes, counts = word_hashes(["Ab c", None, "", "ab\tC d", "É é"])
    assert counts.tolist() == [2, 0, 0, 3, 2]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3]
    assert hashes[5] != hashes[6]
    sets, sizes = shingle_sets(["a b a b a b", "a", "", "a b c"], 3)
    assert sizes.tolist() == [2, 1, 0, 1]


def test_crowded_tokens_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_join, "CROWD", 2)
    monkeypatch.setattr(near_join, "BLOCK", 8)
    monkeypatch.setattr(near_join, "LEADERS", 2)
    rows = variants(9, n_base=6, copies=14)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 3, 90, 100)


def test_stars_are_the_components_of_links():
    draws = np.random.default_rng(2)
    base = draws.integers(0, 1 << 60, 60)
    sets = [np.unique(np.concatenate([base[: 60 - i % 9], draws.integers(0, 1 << 60, i % 7)])) for i in range(40)]
    stars = near_join.linked_stars(np.concatenate(sets), np.array([len(s) for s in sets]), 90, 100, columns=16)
    for i in range(40):
        both = [len(np.intersect1d(sets[i], s)) for s in sets]
        near = [k for k in range(40) if 100 * both[k] >= 90 * (len(sets[i]) + len(sets[k]) - both[k])]
        assert len({stars[k] for k in near}) == 1 and stars[i] <= i


def test_settings_are_as_before(spark, odd_docs):
    from closebook.llm.common import prepared

    before = dict(prepared(spark).conf.getAll)
    near_duplicates(odd_docs, 3, 90, 100).count()
    assert dict(spark.conf.getAll) == before


def test_frequent_tokens_come_last(spark):
    """Passages that very many texts share do not crowd the prefixes, wherever their hashes fall."""
    rng = np.random.default_rng(11)
    shared = [" ".join(f"s{j}-{i}" for i in range(40)) for j in range(3)]
    texts = [shared[i % 3] + " " + " ".join(f"w{x}" for x in rng.integers(0, 10**9, 30)) for i in range(600)]
    texts += [texts[i] + " end" for i in range(0, 600, 50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(df, 3, 90, 100).collect()}
    assert found == {i: (i - 600) * 50 if i >= 600 else i for i in range(len(texts))}
