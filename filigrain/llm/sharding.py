"""Hilbert-curve sharding: metadata quantised per dimension, rows ordered along the curve, runs cut at equal counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.llm.common import below, column_or_null, global_rank, ranked_parts

BITS = 6


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of `axes` (n rows, d columns of integers below 2**bits), after Skilling (2004)."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def string_bounds(values: DataFrame, bits: int) -> tuple[list[str], bool]:
    """Quantile bounds of the strings of values(v), at most 2**bits - 1, from the counts of whole distinct strings in
    byte order after the nulls; and whether the nulls reach the first quantile."""
    cells = 1 << bits
    n, nulls = values.agg(F.count(F.lit(1)), F.count_if(F.col("v").isNull())).first()
    distinct = values.filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
    rows = ranked_parts(distinct, F.col("v"), name="strings")
    sums = rows.groupBy("_part").agg(F.sum("_n").alias("_s"))
    base = sums.select("_part", F.coalesce(F.sum("_s").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))  # one row a partition
    upto = rows.join(F.broadcast(base), "_part").withColumn("_end", F.col("_base") + F.sum("_n").over(W.partitionBy("_part").orderBy("_idx")) + nulls)
    marks = upto.select("v", F.floor((F.col("_end") - F.col("_n")) * cells / max(n, 1)).alias("a"), F.floor(F.col("_end") * cells / max(n, 1)).alias("b"))
    found = marks.filter((F.col("b") > F.col("a")) & (F.col("a") < cells - 1)).select("v").collect()  # below 2**bits rows
    return sorted((r["v"] for r in found), key=lambda v: v.encode()), n > 0 and nulls * cells >= n


def quantised(df: DataFrame, dims: dict[str, Column], bits: int = BITS) -> DataFrame:
    """df with _q: per dimension the number of quantile bounds (at most 2**bits - 1) below or at the value. Numbers
    take them from one bounded summary, strings from the counts of their whole values, nulls first. A value that
    holds many rows takes one cell."""
    marks = [i / (1 << bits) for i in range(1, 1 << bits)]
    strings = {n for n, kind in df.select(*[c.alias(n) for n, c in dims.items()]).dtypes if kind == "string"}
    numbers = [F.percentile_approx(c, marks, 10_000).alias(n) for n, c in dims.items() if n not in strings]
    found = df.agg(*numbers).first() if numbers else {}
    cells = []
    for name, c in dims.items():
        if name in strings:
            bounds, apart = string_bounds(df.select(c.alias("v")), bits)
            cells.append(F.when(c.isNull(), 0).otherwise(below(c, bounds) + int(apart)))
        else:
            cells.append(below(c, sorted({int(v) for v in (found[name] or [])})))
    return df.withColumn("_q", F.array(*cells))


def hilbert_order(df: DataFrame, dims: dict[str, Column], bits: int = BITS) -> DataFrame:
    """df with _curve, its place on the Hilbert curve through the quantised dims."""
    @F.pandas_udf("long")
    def curve(q: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(q.to_numpy()), bits) if len(q) else np.zeros(0, np.int64))

    return quantised(df, dims, bits).withColumn("_curve", curve("_q")).drop("_q")


def hilbert_shards(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, lang, source, curve, shard, slot for every row.

    Dimensions: lang, source and size (UTF-8 bytes + 1; a null text has none). Runs of the curve order, ties by
    doc_id and checksum, are cut so that row counts differ by at most one; the first n mod shards have one more.
    Nulls in lang or source sort first on their axis, null doc_ids first in ties. Extra columns are ignored; an
    empty table gives no rows."""
    text = column_or_null(docs, "text", "string")
    rows = docs.select(
        column_or_null(docs, "doc_id", "long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        column_or_null(docs, "lang", "string").alias("lang"),
        column_or_null(docs, "source", "string").alias("source"),
    )
    dims = {"a": F.col("lang"), "b": F.col("source"), "c": F.col("size")}
    ranked = global_rank(hilbert_order(rows, dims, bits), F.col("_curve"), F.col("doc_id"), F.col("text_crc32"), F.col("size"), name="hilbert")
    n = ranked.count()
    base, more = divmod(n, shards)
    # the first `more` shards hold base + 1 rows
    cut = more * (base + 1)
    shard = F.when(F.col("_rank") < cut, F.floor(F.col("_rank") / (base + 1))).otherwise(more + F.floor((F.col("_rank") - cut) / max(base, 1)))
    out = ranked.withColumn("shard", shard.cast("int"))
    start = F.when(F.col("shard") <= more, F.col("shard") * F.lit(base + 1)).otherwise(cut + (F.col("shard") - more) * F.lit(base))
    return out.withColumn("slot", (F.col("_rank") - start).cast("long")).withColumnRenamed("_curve", "curve").drop("_rank")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard of sharded (shard, slot, ...). Its files are ranges of slots, so that their statistics prune
    on every dimension, and a shard is written by as many tasks as its share of the rows asks for."""
    n = int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sharded.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7(docs: DataFrame) -> DataFrame:
    return hilbert_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
