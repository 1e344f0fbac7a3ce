"""A corpus from raw documents to packed sequences: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of documents.  ``run`` writes each stage's rows as Parquet below the shared
folder and reads them back as the next one's docs, so a lost executor never repeats a whole stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontam, linededup, packing, quality, queries, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, "text", queries.quality_model(spark, sf_dir, docs), threshold=0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 and more words that an earlier document has are cut out; n_chars follows."""
    return linededup.dedup(docs, "doc_id", "text", min_words=50).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs, "doc_id", "text", shingle=3, max_bits=3)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, common.read(spark, sf_dir, "benchmark"), "doc_id", "text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    folder = common.new_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The stages hash, tokenise and score in ways that SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None
