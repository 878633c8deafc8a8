import struct
import zlib
from pathlib import Path

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from closebook.llm import token_output as t

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "A\x1cb c", "<|startoftext|>Hi <|STARTOFTEXT|> x", "É. é, ÉE.", "don't it's X.Y, 12.5, ... , .", "ΑΣ. ς,",
       "naïve_foo, a_b.", "İx K.", " a b\u0085c.", "x" * 5000, "é. ́a"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("known", [t.KNOWN_WORDS, 3])
def test_ids_equal_the_tokenizers(tokenizer, known):
    use = t.WordEncoder(PATH, 2, known)
    for texts in (ODD, ODD[::-1], ["The cat. THE CAT, the cat"] * 3):
        ids, sizes = use.encode(texts)
        want = [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == sum(want, [])


def test_round_trip(spark, odd_docs, no_docs, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    t.write_tokens(odd_docs.repartition(4), path, PATH, 2)
    rows = t.read_tokens(spark, path).collect()
    docs = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = [tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs]
    found = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r.doc_id for r in docs]
    assert sorted(map(tuple, want)) == sorted(tuple(r.token_ids) for r in found)
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, len(r.token_ids))
        start += r.n_tokens
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in t.checksums(t.read_tokens(spark, path)).collect()}
    assert sums == {(r.doc_id, r.start): zlib.crc32(struct.pack(f"<{r.n_tokens}I", *r.token_ids)) for r in found}
    t.write_tokens(no_docs, str(tmp_path / "none"), PATH, 2)
    assert t.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_layout_and_selective_reads(spark, tmp_path):
    path = str(tmp_path / "tokens")
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('word ', id, ' more words') as text")
    t.write_tokens(docs, path, PATH, 2)
    files = sorted(Path(path).glob("*.parquet"))
    column = {c: i for i, c in enumerate(pq.ParquetFile(files[0]).metadata.row_group(0).to_dict()["columns"][i]["path_in_schema"] for i in range(5))}
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    assert "DELTA_BINARY_PACKED" in meta.column(column["doc_id"]).encodings
    assert "RLE_DICTIONARY" in meta.column(column["token_ids.list.element"]).encodings
    assert meta.column(column["doc_id"]).has_column_index
    plan = t.read_tokens(spark, path, tokens=False)._jdf.queryExecution().executedPlan().toString()
    assert "token_ids" not in plan


def test_words_that_end_in_any_letter_before_a_mark():
    """Every letter of the lower planes before a full stop or comma, and those whose lower case ends in a mark."""
    tokenizer = Tokenizer.from_file(PATH)
    letters = [chr(c) for c in range(0x30, 0x3000) if chr(c).isalpha()]
    words = [f"a{c}{mark}" for c in letters for mark in ".,"] + [f"{c}." for c in letters]
    words += ["İ.", "Aİ,", "xİ́.", "i̇.", "ŉ.", "a b.", "a b.", "a\x1cb.", "a\x85b,"]
    use = t.WordEncoder(PATH, 2)
    ids, sizes = use.encode(words)
    want = [e.ids + [2] for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    edges = [0, *sizes.cumsum().tolist()]
    found = [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
    assert [w for w, x, y in zip(words, found, want) if x != y] == []


def test_words_that_come_once_are_forgotten(tokenizer, monkeypatch):
    """What a worker remembers does not grow with the words that it has seen; ids are as before."""
    monkeypatch.setattr(t, "NEW_WORDS", 100)
    use = t.WordEncoder(PATH, 2)
    for i in range(30):
        texts = [" ".join(f"rare{i}x{k}" for k in range(60)) + " the cat. THE CAT, sat", "the cat sat on it."]
        ids, sizes = use.encode(texts)
        want = [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == sum(want, [])
        assert len(use.codes) <= 250 and {b"the", b"cat."} <= use.codes.keys()


def test_the_encoder_goes_when_another_operator_works():
    from closebook.llm import common, near_join

    class Batches:
        def mapInArrow(self, work, schema):
            return list(work(iter(())))

    first = t.encoder(PATH, 2)
    assert t.encoder(PATH, 2) is first
    near_join.set_heads(Batches(), 5, 80, 100)
    assert not common._remembered
    assert t.encoder(PATH, 2) is not first
    common.forget()
