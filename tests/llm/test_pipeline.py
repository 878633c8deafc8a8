import corpus_pipeline as p
from closebook.llm import near_join
from closebook.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    kept = p.identified(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    single = p.unrepeated(spark, kept, SF_DIR)
    groups = near_join.near_duplicates(kept, 5, 80, 100)
    assert single.columns == docs.columns
    assert single.count() == groups.select("component_id").distinct().count()
    assert near_join.near_duplicates(single, 5, 80, 100).where("component_id != doc_id").count() == 0
    clean = p.decontaminated(spark, single, SF_DIR)
    items = [" ".join(r.text.lower().split()) for r in table(spark, SF_DIR, "benchmark").collect()]
    left = [" ".join(r.text.lower().split()) for r in clean.collect()]
    assert not [t for t in left if any(i in t for i in items)]
    mixed = p.mixed(spark, clean, SF_DIR)
    assert mixed.columns == docs.columns
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    tokens = p.tokenized(spark, mixed, SF_DIR)
    assert tokens.count() == mixed.count()


def test_odd_and_no_rows(spark, odd_docs, no_docs):
    for docs, some in ((odd_docs, True), (no_docs, False)):
        docs = docs.drop("size", "start", "host")
        for _, stage in p.STAGES:
            docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert docs.isEmpty() != some
