"""The opN queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from filigrain.llm import chat, exact, merkle, minhash, mixing, packing, quality, sharding, suffixes, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op1(table(spark, sf_dir, "conversations"))


def op1_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.trailing_turns(table(spark, sf_dir, "conversations"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op2(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op7(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_preference_pairs": op1,
        "op2_min_slack_packing": op2,
        "op3_heavy_hitter_dedup": op3,
        "op4_merkle_fingerprints": op4,
        "op5_sparse_suffix_array": op5,
        "op6_coordinate_join": op6,
        "op7_hilbert_shards": op7,
        "op8_url_trees": op8,
        "op9_weighted_mix": op9,
        "op10_fourier_quality": op10,
        "op1_trailing_turns": op1_trailing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_preference_pairs": chat.SQL,
        "op3_heavy_hitter_dedup": exact.SQL,
        "op6_coordinate_join": minhash.SQL,
        "op9_weighted_mix": mixing.SQL,
    }
