import numpy as np
from pyspark.sql import functions as F

from closebook.llm import toxicity as x
from closebook.llm.common import held_out, table

SF_DIR = "/root/testdata/sf0.1"


def test_slopes_are_right():
    words = x.Words(["one two three two", "bad words here and there", ""])
    rows, doc = words.windows()
    wanted, weights = np.array([0, 1, 0], np.float32), np.array([0.5, 0.2, 0.3])
    network = x.Network(3)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    _, slopes = network.gradients(words, rows, wanted, weights)
    draws = np.random.default_rng(0)
    for name, value in network.p.items():
        used = np.argwhere(np.abs(slopes[name]) > 1e-7)
        for place in used[draws.permutation(len(used))[:4]]:
            place, old = tuple(place), value[tuple(place)]
            losses = []
            for step in (1e-4, -1e-4):
                value[place] = old + step
                losses.append(network.gradients(words, rows, wanted, weights)[0])
            value[place] = old
            assert abs((losses[0] - losses[1]) / 2e-4 - slopes[name][place]) < 2e-3 * max(1.0, abs(slopes[name][place]))


def test_windows_cover_all_words_and_overlap():
    words = x.Words([" ".join(f"a{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)) for n in (0, 1, 32, 33, 100)])
    rows, doc = words.windows()
    assert np.bincount(doc).tolist() == [1, 1, 1, 2, 6]
    for d, n in enumerate((0, 1, 32, 33, 100)):
        seen = rows[doc == d]
        assert len(np.unique(seen[seen < len(words.bucket)])) == n


def test_held_out_texts(spark):
    docs, labels = table(spark, SF_DIR, "documents").select("doc_id", "text"), table(spark, SF_DIR, "labels")
    out = held_out(F.col("doc_id"))
    network = x.train(docs.where(~out), labels.where(~out))
    scored = x.score(docs, network).join(labels, "doc_id").where(out)
    by = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert by.get((1, 1), 0) >= 0.9 * (by.get((1, 1), 0) + by.get((1, 0), 0))
    assert by.get((0, 1), 0) <= 0.02 * (by.get((0, 0), 0) + by.get((0, 1), 0))


def test_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (9, 0), (7, 0), (None, 1), (5, None), (4, 0)], "doc_id long, toxic int")
    network = x.train(odd_docs, labels)
    found = x.score(odd_docs.withColumn("score", F.lit("old")), network).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert len({r.score for r in found if r.text is None or not r.text.strip()}) == 1
    assert x.score(no_docs, network).count() == 0
    assert {r.score for r in x.score(odd_docs, x.train(no_docs, labels)).collect()} == {0.0}
    assert {r.score for r in x.score(odd_docs, x.train(odd_docs, labels.where("toxic = 1"))).collect()} == {1.0}
