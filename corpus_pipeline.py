"""The corpus pipeline: raw documents to packed training sequences.

Each stage calls one operator of ``coursewise.llm`` on all that the stage
before it kept; its result is written to the shared folder and read back, so a
lost executor costs the running stage only. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.llm.common import written
from coursewise.llm.divergence import quality_rules
from coursewise.llm.fm_dedup import without_repeats
from coursewise.llm.latent_leaks import without_leaks
from coursewise.llm.packing import pack
from coursewise.llm.simhash_pivot import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, verdict = quality_rules(docs, docs.columns)
    return rows.where(F.col(verdict)["kept"]).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return one_of_each(docs, shingle=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that start in one with a smaller id too."""
    return without_repeats(docs, window=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: SQL has no tokenizer, fingerprint or matrix decomposition; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k + 1}")
    return docs
