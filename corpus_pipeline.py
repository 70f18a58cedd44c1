"""From raw documents to packed sequences: each stage's result is stored and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from climgrid.llm import mixing, near_dedup, packing, quality_rules, store, substrings
from climgrid.llm.queries import tokenizer
from climgrid.storage import work_folder


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules reject go."""
    return quality_rules.reject_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of smallest doc_id."""
    return near_dedup.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that begin in a document of smaller doc_id are cut out of the texts."""
    return substrings.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), added=True)


STAGES = [
    ("quality_rules", reject_by_rules),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("source_mixing", mix_sources),
    ("hilbert_packing", pack_sequences),
]

#: Learned rules, hashing, sampling and tokenizing are beyond SQL; the tests hold the
#: stages against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, path = store.mark(), work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        store.release(spark, before)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
