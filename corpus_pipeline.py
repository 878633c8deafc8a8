"""The corpus pipeline: language, near duplicates, benchmark leaks, mixture, token files.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``; the last returns what the token files hold of each document. ``run`` writes each stage's
rows to the shared folder and reads them again, so a lost executor costs one stage's tasks at most.

Defined cases: texts that are null or have no letter are rejected by the language stage, as are texts whose language is
in doubt; rows with a null id cannot be told apart, so they pass the near-duplicate and benchmark stages; of rows that
share an id one stays; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closebook.llm import decontaminate, language, mixing, near_join, token_output
from closebook.llm.common import store, table
from closebook.workspace import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    found = language.identify(docs, language.train(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates: five-word shingles, similarity 0.8."""
    groups = near_join.near_duplicates(docs, width=5, num=80, den=100)
    kept = groups.where(F.col("component_id") == F.col("doc_id")).groupBy("doc_id").agg(F.count("*").alias("c"))
    kept = store(kept, "unrepeated")
    one = docs.join(kept.where("c = 1"), "doc_id", "left_semi")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "lang", "source", "n_chars"))
    first = docs.join(kept.where("c > 1"), "doc_id", "left_semi").withColumn("r", place).where("r = 1")
    return one.select(*COLUMNS).unionAll(first.select(*COLUMNS)).unionAll(docs.where("doc_id is null").select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    leaks = store(leaks.select("doc_id").distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for every time that it takes a document."""
    return mixing.shard_rows(mixing.mix(docs)).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and from them each row's place, length and checksum."""
    path = new_path(spark, "corpus-tokens")
    token_output.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_output.checksums(token_output.read_tokens(spark, path))


STAGES = [
    ("language", identified),
    ("near duplicates", unrepeated),
    ("benchmark leaks", decontaminated),
    ("mixture", mixed),
    ("tokens", tokenized),
]

# Trained classifiers, latent search and a tokenizer are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
