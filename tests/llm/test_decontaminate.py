import random

import numpy as np

from closebook.llm import decontaminate as d
from closebook.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for i, y in enumerate(b):
            row.append(last[i] + 1 if x == y else max(row[-1], last[i + 1]))
    return row[-1]


def test_common_subsequence():
    draws = random.Random(1)
    for _ in range(40):
        a = [draws.randrange(6) for _ in range(draws.randrange(5, 80))]
        b = [draws.randrange(6) for _ in range(draws.randrange(0, 90))]
        answer = draws.randrange(len(a))
        assert d.Item(1, a, answer).common(b) == (plain(a, b), plain(a[answer:], b))


def test_last_sentence():
    assert d.last_sentence("One two three. Four five six") == 3
    assert d.last_sentence("One two. Three four.") == 0
    assert d.last_sentence("No end here") == 0


def test_leading_directions_are_found():
    draws = np.random.default_rng(0)
    left, _ = np.linalg.qr(draws.standard_normal((60, 60)))
    gram = left @ np.diag(2.0 ** -np.arange(60)) @ left.T
    sketch = draws.standard_normal((60, 20))
    basis = d.nystroem(gram @ sketch, sketch)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)
    assert np.linalg.norm(left[:, :4] - basis @ (basis.T @ left[:, :4])) < 0.01


def test_whole_passages_are_found_and_nothing_else(spark):
    docs, benchmark = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, benchmark).collect()}
    texts = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
    items = {r.item_id: " ".join(r.text.lower().split()) for r in benchmark.collect()}
    assert found == {(i, k) for i, text in texts.items() for k, item in items.items() if item in text}


def test_paraphrases(spark):
    """Items with words dropped and put in between, at any place of longer texts."""
    draws = random.Random(7)
    docs, benchmark = table(spark, SF_DIR, "documents").limit(40).collect(), table(spark, SF_DIR, "benchmark").collect()
    rows, want = [], set()
    for n, item in enumerate(benchmark):
        words = [w for w in item.text.split() if draws.random() > 0.12]
        for _ in range(3):
            words.insert(draws.randrange(len(words)), "filler")
        base = docs[n % len(docs)].text.split()
        at = draws.randrange(len(base) + 1)
        rows.append((n, " ".join(base[:at] + words + base[at:])))
        want.add((n, item.item_id))
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), table(spark, SF_DIR, "benchmark")).collect()}
    assert len(found & want) >= 0.9 * len(want)


def test_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    items = [(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "a b"), (None, "seven geese look on the bank"),
             (5, "while seven geese look on near the river")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in d.find_leaks(odd_docs, benchmark).collect())
    assert [x for x in found if x[2] == 1] == [(False, 1, 1), (False, 1, 1), (False, 2, 1), (True, 0, 1)]
    monkeypatch.setattr(d, "ITEMS", 1)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in d.find_leaks(odd_docs, benchmark).collect()) == found
    assert d.find_leaks(no_docs, benchmark).count() == 0
    assert d.find_leaks(odd_docs, benchmark.where("false")).count() == 0


def test_an_item_lies_in_one_window_whole():
    for n in range(d.LEAST, 2000):
        span, step = d.windows(n)
        assert (span - step) * d.STRIDE >= n + n // 4


def test_paraphrases_at_all_offsets(spark):
    """Items of 34 to 47 words with words replaced are found wherever the whole text matches."""
    draws = random.Random(3)
    items, rows, want = [], [], set()
    for k in range(14):
        words = [f"i{k}x{j}" for j in range(34 + k)]
        items.append((k, " ".join(words)))
        item = d.Item(k, words, 0)
        for at in range(0, 64):
            changed = [w if draws.random() > 0.35 else f"c{draws.randrange(1 << 30)}" for w in words]
            text = [f"o{draws.randrange(1 << 30)}" for _ in range(at)] + changed + ["after"] * 70
            rows.append((64 * k + at, " ".join(text)))
            if item.common(text)[0] >= d.MATCH * len(words):
                want.add((64 * k + at, k))
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, benchmark).collect()}
    assert found == want


def test_a_large_block_loses_no_verbatim_item(spark):
    """1,000 items, each planted once within another text; some more with words replaced."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(6000)]
    words = lambda n: [vocabulary[int(6000 * rng.random() ** 2)] for _ in range(n)]
    items = [words(rng.randint(15, 59)) for _ in range(1000)]
    docs, loose = [], set()
    for k, item in enumerate(items):
        docs.append((k, " ".join(words(rng.randint(20, 200)) + item + words(rng.randint(20, 200)))))
        changed = [x if rng.random() > 0.25 else rng.choice(vocabulary) for x in item]
        whole, answer = d.Item(k, [hash(x) for x in item], 0).common([hash(x) for x in changed])
        if whole >= d.MATCH * len(item):
            loose.add(k)
        docs.append((1000 + k, " ".join(words(40) + changed + words(40))))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(frame, benchmark).collect()}
    assert {(k, k) for k in range(1000)} <= found
    caught = sum((1000 + k, k) in found for k in loose)
    assert caught >= 0.97 * len(loose)
    assert len(found) < 2200


def test_sums_by_group():
    """Groups of one row, of some and of far more than a piece."""
    draws = np.random.default_rng(2)
    group = np.repeat(np.arange(0, 40, 2), draws.choice([1, 2, 31, 32, 33, 500], 20))
    table, at = draws.standard_normal((30, 4)).astype(np.float32), draws.integers(0, 30, len(group))
    factor = draws.random(len(group)).astype(np.float32)
    for times in (None, factor):
        want = np.zeros((41, 4))
        np.add.at(want, group, table[at] * (1 if times is None else times[:, None]))
        assert np.allclose(d._segments(table, at, group, 41, times), want, atol=1e-3)
    assert not d._segments(table, at[:0], group[:0], 3).any()


def test_only_what_may_match_is_compared(monkeypatch):
    """Few of the item's words in a text rule it out; the last sentence is compared only if the whole item matches."""
    draws, calls, found = random.Random(4), [], 0
    real = d._subsequence
    monkeypatch.setattr(d, "_subsequence", lambda *a: calls.append(1) or real(*a))
    for _ in range(300):
        words = [draws.randrange(40) for _ in range(draws.randrange(5, 40))]
        item = d.Item(1, words, draws.randrange(len(words)))
        text = [w if draws.random() < 0.7 else -1 for w in words] if draws.random() < 0.5 else [draws.randrange(60) for _ in range(50)]
        whole, answer = (x / n for x, n in zip(item.common(text), (len(words), len(words) - item.answer)))
        calls.clear()
        want = (whole, answer) if whole >= d.MATCH and answer >= d.ANSWER else None
        assert item.match(text) == want
        assert len(calls) <= (2 if whole >= d.MATCH else 1)
        assert sum(w in words for w in text) >= d.MATCH * len(words) or not calls
        found += want is not None
    assert 0 < found < 300
