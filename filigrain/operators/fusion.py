"""Fusion of ranked lists (qid, pos, rank) and what is read off them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, Window as W

RRF_K = 60


def rrf(ranked: dict[str, DataFrame], k: int = RRF_K, weights: dict[str, float] | None = None) -> DataFrame:
    """(qid, pos, score, rank, {name}_rank ...): reciprocal rank fusion, score rounded to 6 digits, ties by pos."""
    lists = [df.select("qid", "pos", F.lit(n).alias("name"), F.col("rank").alias("r")) for n, df in ranked.items()]
    rows = reduce(DataFrame.unionByName, lists)
    weight = F.lit(1.0)
    for n, w in (weights or {}).items():
        weight = F.when(F.col("name") == n, F.lit(float(w))).otherwise(weight)
    own = [F.max(F.when(F.col("name") == n, F.col("r"))).alias(f"{n}_rank") for n in ranked]
    fused = rows.groupBy("qid", "pos").agg(F.round(F.sum(weight / (F.lit(float(k)) + F.col("r"))), 6).alias("score"), *own)
    return fused.withColumn("rank", F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), "pos")))


def overlap(a: DataFrame, b: DataFrame, k: int = 10) -> DataFrame:
    """(qid, common, jaccard) of the first k of two ranked lists."""
    x, y = (d.filter(F.col("rank") <= k).groupBy("qid").agg(F.collect_set("pos").alias(n)) for d, n in ((a, "x"), (b, "y")))
    j = x.join(y, "qid", "full").select("qid", F.coalesce("x", F.array().cast("array<long>")).alias("x"), F.coalesce("y", F.array().cast("array<long>")).alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return j.select("qid", common.cast("long").alias("common"), (common / F.greatest(F.size(F.array_union("x", "y")), F.lit(1))).alias("jaccard"))


def interleave(lists: list[DataFrame], top_k: int) -> DataFrame:
    """(qid, pos, rank): first of each list, then the seconds, ...; a repeated pos keeps its first place."""
    rows = reduce(DataFrame.unionByName, [d.select("qid", "pos", F.col("rank").alias("depth"), F.lit(i).alias("src")) for i, d in enumerate(lists)])
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("qid", "pos").orderBy("depth", "src"))).filter("_n = 1")
    return first.withColumn("rank", F.row_number().over(W.partitionBy("qid").orderBy("depth", "src"))).filter(F.col("rank") <= top_k).select("qid", "pos", "rank")


def round_robin(targets: DataFrame, top_k: int) -> DataFrame:
    """(qid, pos, rank, label) from per-target lists (qid, label, pos, rank), labels in their order; dedupe keeps the
    first in depth-major order."""
    first = targets.withColumn("_n", F.row_number().over(W.partitionBy("qid", "pos").orderBy("rank", "label"))).filter("_n = 1")
    place = F.row_number().over(W.partitionBy("qid").orderBy("depth", "label"))
    return first.withColumnRenamed("rank", "depth").withColumn("rank", place).filter(F.col("rank") <= top_k).select("qid", "pos", "rank", "label")


def union_search(lexical: DataFrame, dense: DataFrame, fused: DataFrame, top_k: int, each: int | None = None) -> DataFrame:
    """(qid, pos, rank): the first `each` of both lists interleaved, half of top_k by default, then the fused order."""
    each = each or top_k // 2
    heads = interleave([d.filter(F.col("rank") <= each) for d in (lexical, dense)], 2 * each)
    rows = heads.select("qid", "pos", F.lit(0).alias("part"), F.col("rank").alias("at")).unionByName(fused.select("qid", "pos", F.lit(1).alias("part"), F.col("rank").alias("at")))
    first = rows.groupBy("qid", "pos").agg(F.min(F.struct("part", "at")).alias("o"))
    place = F.row_number().over(W.partitionBy("qid").orderBy("o.part", "o.at"))
    return first.withColumn("rank", place).filter(F.col("rank") <= top_k).select("qid", "pos", "rank")
