import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import language as g
from closebook.llm.common import held_out, table

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_texts_are_recognised(spark):
    docs = table(spark, SF_DIR, "documents")
    out = held_out(F.col("doc_id"))
    found = g.identify(docs, g.train(docs.where(~out))).where(out)
    right, total = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 150
    assert right >= 0.98


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8, 30])
def test_codewords_are_far_apart(n):
    code = g.codewords(n)
    apart = (code[:, None] != code[None]).sum(2) + np.eye(n, dtype=int) * 99
    assert apart.min() >= max(1, code.shape[1] // 4)
    assert (code.any(0) & ~code.all(0)).all() or n == 1


def test_a_wrong_bit_is_corrected():
    code = g.codewords(4)
    weights = np.zeros((1, code.shape[1]), np.float32)
    for row in range(4):
        for bit in range(code.shape[1]):
            signs = code[row].astype(np.float32) * 2 - 1
            signs[bit] *= -0.5
            model = g.Model(list("abcd"), code, weights, signs * 3, np.ones(code.shape[1], np.float32))
            best, score, _ = model.predict(np.zeros((1, 1), np.float32))
            assert best[0] == row and 0 < score[0] <= 1


def test_odd_rows(spark, odd_docs, no_docs):
    model = g.train(table(spark, SF_DIR, "documents"))
    found = g.identify(odd_docs, model).collect()
    assert len(found) == odd_docs.count()
    by = {r.doc_id: (r.lang_pred, r.score, r.ambiguous) for r in found}
    assert by[3] == by[4] == by[5] == by[6] == ("und", 0.0, False)
    assert g.identify(no_docs, model).count() == 0
    assert g.train(no_docs) is None
    assert {r.lang_pred for r in g.identify(odd_docs, None).collect()} == {"und"}
    one = g.train(odd_docs.where("lang = 'en'"))
    assert {r.lang_pred for r in g.identify(odd_docs, one).collect()} == {"und", "en"}


def test_long_text_is_read_whole():
    text = "abc " * 400_000
    whole = g.features(text + "xyzzy" * 9)
    assert not np.allclose(whole, g.features(text))
