"""A training corpus out of raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet
and read again as the next stage's documents.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import bpe, decontaminate, langid, simhash, toxicity
from medallion.llm.common import crc_mod, table
from medallion.llm.queries import tokenizer_path
from medallion.session import scratch_path, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; with no score limit or list of languages the network's answer removes no other."""
    ship_package(spark)
    return langid.keep_identified(docs, langid.fit(docs, crc_mod(docs["doc_id"], 5) != 0))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field scores at 0.7 or more go."""
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(docs["doc_id"], 3) != 1)
    return toxicity.keep_clean(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    ship_package(spark)
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; documents that they cover go."""
    ship_package(spark)
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    ship_package(spark)
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Trained models and fingerprints are not SQL; tests/llm compares the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    ship_package(spark)
    folder = scratch_path(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
