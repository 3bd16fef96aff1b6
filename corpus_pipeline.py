"""The corpus pipeline: documents of poor quality go, copies go, one near-duplicate of each group stays, sources are
mixed to their weights and the mix is packed into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filigrain.llm import exact, minhash, mixing, packing, quality
from filigrain.llm.common import written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1, the classifier: documents whose score is under 0.7 go. See quality.keep_good for odd rows."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: of texts that are equal but for white space the longest stays. See exact.keep_first for odd rows."""
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: one document of each near-duplicate group (five words, 0.8) stays. See minhash.keep_one for odd rows."""
    return minhash.keep_one(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents as often as their source's target asks for. See mixing.mixed_documents for odd rows."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: the pieces of all documents in sequences of 1,024 tokens. See packing.pack for odd rows."""
    return packing.op2(docs)


STAGES = [
    ("quality", classify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: Tokens, forests of hashes and trained scores are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
