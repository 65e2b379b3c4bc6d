"""The corpus pipeline: from raw documents to token ids of clean, different, uncontaminated ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages are written as
Parquet and read again one after the other. All but the last keep the columns of
`documents`. Rows with null ids and repeated rows pass through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid.llm import bpe, decontaminate, perplexity, rules, simhash
from stormgrid.llm.common import load
from stormgrid.llm.queries import word_vocabulary
from stormgrid.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier keeps."""
    judged = perplexity.classify(docs, load(spark, sf_dir, "labels"), keep_text=True)
    return judged.where("kept").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every threshold."""
    return rules.judge(docs).where("kept").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark")).select(*COLUMNS)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the decoded text."""
    coded = bpe.encode(docs, word_vocabulary(), decoded=True, drop=("text",))
    return coded.select(
        "doc_id", "lang", "source", "ids", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding and decoding", bpe_codec),
]

#: Perplexity and fingerprints are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
