import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, doc_id long, score long"


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    n_docs, n_terms = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counted:
            size, score = c.total(), 0
            for term in set(split(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * (10 + (90 * size * n_docs) // n_terms)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda r: r[:3])
        out += [(item_id, place + 1, r[3], -r[0]) for place, r in enumerate(found[:k])]
    return Counter(out)


def searched(spark, docs, items, k=10):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, bound long, item long")
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    found = lexical.search(lexical.build_index(docs), docs, items, k)
    return Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())


def text(rng, size, vocabulary=3000):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(size))


def test_equal_to_brute_force(spark):
    rng = random.Random(1)
    docs = [(i, text(rng, rng.choice([1, 5, 40, 200, 900]))) for i in range(1500)]
    items = [(i, text(rng, rng.choice([1, 3, 20, 60]))) for i in range(40)]
    assert searched(spark, docs, items) == brute(docs, items)


def test_a_third_of_all_rows_are_copies(spark):
    rng = random.Random(2)
    copy = text(rng, 50)
    docs = [(i, copy if i % 3 == 0 else text(rng, 30)) for i in range(1200)]
    items = [(1, copy), (2, " ".join(copy.split()[:4])), (3, "w1"), (4, text(rng, 10))]
    assert searched(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    long = " ".join(f"t{i % 5000}" for i in range(300_000))
    docs = [
        (1, "Straße STRASSE İstanbul istanbul"), (1, "straße again"), (None, "straße null id"), (2, None), (3, ""), (4, "--- \t..."),
        (5, "a-b_c{d}e~f"), (6, "a b c"), (6, "a b c"), (7, long), (8, "x1y2 X1Y2 " * 50), (9, "日本 日本語 straße"),
    ]
    items = [(1, "straße"), (1, "a b c d"), (None, "istanbul t7 x1y2"), (2, None), (3, ""), (4, "unknown words"), (5, "日本語 T4999"), (6, long)]
    assert searched(spark, docs, items) == brute(docs, items)


def test_few_items_at_a_time_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_TOGETHER", 20)
    monkeypatch.setattr(lexical, "CELLS", 200)
    rng = random.Random(3)
    docs = [(i, text(rng, 60)) for i in range(300)]
    items = [(i, text(rng, 8)) for i in range(12)]
    assert searched(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert not searched(spark, [], [(1, "a")])
    assert not searched(spark, [(1, "a")], [])
    assert not searched(spark, [(1, None)], [(1, "a")])


def test_terms_are_whole_across_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 7)
    rng = random.Random(4)
    for _ in range(200):
        some = "".join(rng.choice("abcZ09-_ ./{äß日") for _ in range(rng.randint(0, 60)))
        assert [t.decode() for piece in lexical.terms_of(some.encode()) for t in piece] == split(some)


@pytest.mark.parametrize("size", [1, 8, 9, 1000])
def test_bounds_are_never_below_the_scores(size):
    rng = random.Random(size)
    texts = [text(rng, rng.choice([2, 30, 300])) for _ in range(size)]
    indexer = lexical.Indexer()
    rows = [*indexer.add(list(range(size)), [t.encode() for t in texts]), *indexer.finish()]
    counts = [Counter(split(t)) for t in texts]
    n_terms = sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    chosen = sorted(df)[:60]
    pairs = [(t.encode(), df[t]) for t in chosen]
    asked = lexical.asked_of([{"item": 7, "terms": pairs}], size)
    seen = {}
    for block in lexical._blocks([r for r in rows if r.column("width")[0].is_valid], len(chosen)):
        for _, bound in lexical.block_bounds(block, asked, size, n_terms):
            seen.update(zip(block["ids"].tolist(), bound.tolist()))
    for doc, c in enumerate(counts):
        damp = lexical.damping(c.total(), size, n_terms)
        exact = sum(lexical.weight(size, df[t]) * lexical.impact(c[t], damp) for t in chosen if c[t])
        assert exact <= seen.get(doc, 0)


def test_the_index_counts_all_documents(spark):
    rng = random.Random(5)
    docs = [(i, text(rng, 50)) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    index = lexical.build_index(frame)
    df = Counter(t for _, s in docs for t in set(split(s)))
    assert {bytes(r.term).decode(): r.df for r in index.terms.collect()} == df
    assert index.blocks.agg(F.sum("docs")).first()[0] == 500
    assert (index.n_docs, index.n_terms) == (500, 25_000)


def test_most_documents_are_excluded_by_their_bounds(spark):
    """A planted item leaves few documents to score exactly."""
    rng = random.Random(6)
    docs = [(i, text(rng, 100, 100_000)) for i in range(2000)]
    items = [(i, " ".join(docs[i][1].split()[:30])) for i in range(20)]
    docs += [(10_000 + 20 * j + i, items[i][1]) for i in range(20) for j in range(10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = lexical.build_index(frame)
    asked = lexical.asked_of(
        lexical.item_terms(index, spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").orderBy("item").collect(),
        index.n_docs,
    )
    floors = {item: (score, 0) for (item, rank, _, score) in brute(docs, list(zip(asked.items, [t for _, t in items]))) if rank == 10}
    look = lexical._reaching(asked, index.n_docs, index.n_terms, floors)
    assert index.blocks.select("width", "docs", "ids", "sizes", "slices").mapInArrow(look, lexical.PAIR).count() < 1000
    assert np.all(asked.weights >= 0)
