"""The registered queries of this subpackage: one thin query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.llm import (
    decontaminate, language, lexical, mixing, near_join, sharding, substring_dedup, subvector_means, token_output, top_k, toxicity,
    url_filter, warc,
)
from closebook.llm.common import held_out, table
from closebook.workspace import new_path

END_ID = 2
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_duplicates(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, END_ID)
    return token_output.checksums(token_output.read_tokens(spark, path))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.size("draws")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"))
    network = toxicity.train(docs.where(~out), labels.where(~out))
    scored = toxicity.score(docs, network)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"))
    model = language.train(docs.where(~out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.read_warc(spark, path, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    found = lexical.search(index, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.select("item_id", "rank", "doc_id", "score")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subvector_means.cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_join": op1_near_join,
    "op2_top_k": op2_top_k,
    "op3_url_filter": op3_url_filter,
    "op4_sharding": op4_sharding,
    "op5_decontaminate": op5_decontaminate,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_output": op7_token_output,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_warc": op11_warc,
    "op12_lexical": op12_lexical,
    "op13_centroids": op13_centroids,
}
