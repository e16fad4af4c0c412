"""A training corpus from the table documents: five stages, each an operator of ledgerflow.llm.

Toxic documents go, one document of each near-duplicate group stays, repeated passages go, sources are mixed to their
targets, texts become token ids. Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; what it returns is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm import bpe, mixing, near_text, substrings, toxicity
from ledgerflow.llm.common import fresh_path, quoted, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores 0.3 or more go; the model learns from labelled rows of docs that aren't held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, evidence=0).filter("tox_predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class the document with the smallest doc_id stays, once; rows without a doc_id stay. Where rows share a
    doc_id but not their text, each text is a document of its own."""
    named = docs.filter("doc_id IS NOT NULL")
    n, distinct = named.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n > distinct:
        # a row's columns travel in one, so that their names can't clash
        keyed = named.select(F.xxhash64("doc_id", "text", F.col("text").isNull()).alias("key"), F.struct(*map(quoted, docs.columns)).alias("row"))
        keyed = stored(keyed.dropDuplicates(["key"]), "keyed")
        found = near_text.classes(keyed.select("key", "row.text"), key="key")
        least = found.join(keyed.select(F.col("key").alias("id"), "row.doc_id"), "id").groupBy("class_id").agg(F.min(F.struct("doc_id", "id")).alias("least"))
        kept = keyed.join(least.select(F.col("least.id").alias("key")), "key", "left_semi").select(*(F.col("row")[c].alias(c) for c in docs.columns))
    else:
        kept = named.join(near_text.classes(docs).filter("id = class_id").select(F.col("id").alias("doc_id")), "doc_id", "left_semi").select(*docs.columns)
    return kept.union(docs.filter("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the later ones; n_chars follows the text."""
    out = substrings.deduplicated(docs)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: doc_id, n_tokens, ids, and hashes of the ids and of the decoded text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_column(docs, path, bpe.fit_lexicon(docs, path, fresh_path(spark, "lexicon")), keep=("ids",))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats), ("mixing", mix_sources), ("bpe", encode)]
#: Learned scores, similarity classes and chunk hashes aren't expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
