"""Neighbours and parents of retrieved chunks, by windows over the ordered chunks of a section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.functions.text import token_count


def neighbours(seeds: DataFrame, chunks: DataFrame, group: str, seq: str, window: int = 1) -> DataFrame:
    """(group, seed_seq, seq): chunks within `window` places of a seed in its group, by an equi join on the places."""
    at = seeds.select(group, F.col(seq).alias("seed_seq"), F.explode(F.sequence(F.col(seq) - window, F.col(seq) + window)).alias(seq))
    return at.join(chunks.select(group, seq), [group, seq]).select(group, "seed_seq", seq)


def with_neighbours(ranked: DataFrame, chunks: DataFrame, group: list[str], seq: str, top_k: int, n_seed: int = 3, window: int = 1, allowed: Column | None = None) -> DataFrame:
    """(qid, pos, rank): the first n_seed results each followed by the chunks within `window` places of the same group,
    nearer ones and those before first, then the other results; a chunk stays where it comes first, top_k in all.
    chunks(pos, group ..., seq); `allowed` is a condition on them."""
    at = ranked.join(chunks.select("pos", *group, seq), "pos")
    near = at.filter(F.col("rank") <= n_seed).select("qid", "rank", *group, F.col(seq).alias("_s"), F.explode(F.array(*[F.lit(d) for w in range(1, window + 1) for d in (-w, w)])).alias("_d"))
    near = near.withColumn(seq, F.col("_s") + F.col("_d"))
    held = chunks if allowed is None else chunks.filter(allowed)
    found = near.join(held.select("pos", *group, seq), [*group, seq]).select("qid", "pos", F.struct(F.col("rank").alias("a"), F.lit(1).alias("b"), F.abs("_d").alias("c"), F.col("_d").alias("d")).alias("o"))
    own = ranked.select("qid", "pos", F.struct(F.col("rank").alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"), F.lit(0).alias("d")).alias("o"))
    first = own.unionByName(found).groupBy("qid", "pos").agg(F.min("o").alias("o"))
    place = F.row_number().over(W.partitionBy("qid").orderBy("o", "pos"))
    return first.withColumn("rank", place).filter(F.col("rank") <= top_k).select("qid", "pos", "rank")


def parent_scores(ranked: DataFrame, parents: DataFrame, hits: DataFrame, top_k: int) -> DataFrame:
    """(qid, parent_recall, parent_tokens) of the first top_k distinct parents: parents(pos, parent_id, n_tokens), hits(qid,
    item, parent_id): which parents satisfy which item, null where none does."""
    kept = distinct_parents(ranked.join(parents.select("pos", "parent_id"), "pos"), "parent_id", top_k)
    sizes = parents.groupBy("parent_id").agg(F.first("n_tokens").alias("n_tokens"))
    cost = kept.join(sizes, "parent_id").groupBy("qid").agg(F.sum("n_tokens").alias("parent_tokens"))
    items = hits.groupBy("qid").agg(F.count_distinct("item").alias("_n"))
    got = hits.join(kept, ["qid", "parent_id"], "left_semi").groupBy("qid").agg(F.count_distinct("item").alias("_g"))
    j = items.join(got, "qid", "left").join(cost, "qid", "left")
    return j.select("qid", F.round(F.coalesce("_g", F.lit(0)) / F.col("_n"), 4).alias("parent_recall"), F.coalesce("parent_tokens", F.lit(0)).alias("parent_tokens"))


def parent_windows(chunks: DataFrame, group: str, seq: str, text: str, key: str, tables: DataFrame | None = None, cap: int = 1500) -> DataFrame:
    """chunks plus parent_id and parent_text: of previous + self + next, self + next and self the first whose text, joined
    by blank lines, fits the cap; self fits always. The id is win: and the keys, joined by bars.

    Chunks with a table_id of tables(table_id, table_text) have that whole table as parent if it fits, else themselves;
    they are no neighbours of text chunks."""
    df = chunks.withColumn("_table", F.lit(None).cast("string")) if tables is None else chunks.join(tables.withColumnRenamed("table_text", "_table"), "table_id", "left")
    w = W.partitionBy(group, F.col("_table").isNotNull()).orderBy(seq)
    df = df.withColumns({f"_{n}_{c}": f(c).over(w) for c in (text, key) for n, f in (("before", F.lag), ("after", F.lead))})
    id_, parent = F.concat(F.lit("win:"), F.col(key).cast("string")), F.col(text)
    for names in ((key, "_after"), ("_before", key, "_after")):  # the widest that fits is asked last, so it wins
        at = [key if n == key else f"{n}_{key}" for n in names]
        wide = F.concat_ws("\n\n", *(text if n == key else f"{n}_{text}" for n in names))
        fits = token_count(wide) <= cap
        id_ = F.when(fits, F.concat(F.lit("win:"), F.concat_ws("|", *(F.col(c).cast("string") for c in at)))).otherwise(id_)
        parent = F.when(fits, wide).otherwise(parent)
    if tables is not None:
        fits, whole = token_count(F.col("_table")) <= cap, F.col("_table").isNotNull()
        id_ = F.when(whole, F.when(fits, F.col("table_id")).otherwise(F.col(key).cast("string"))).otherwise(id_)
        parent = F.when(whole, F.when(fits, F.col("_table")).otherwise(F.col(text))).otherwise(parent)
    return df.select(*chunks.columns, id_.alias("parent_id"), parent.alias("parent_text"))


def distinct_parents(ranked: DataFrame, parent: str, top_k: int) -> DataFrame:
    """(qid, parent, rank): parents by the best rank of their chunks, the first top_k."""
    best = ranked.groupBy("qid", parent).agg(F.min("rank").alias("best"))
    return best.withColumn("rank", F.row_number().over(W.partitionBy("qid").orderBy("best", parent))).filter(F.col("rank") <= top_k).select("qid", parent, "rank")


def as_of(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """left plus `value` of the last row of right at or before, per `by`: one shuffle, no join."""
    rows = left.select(by, at, F.lit(None).cast(dict(right.dtypes)[value]).alias(value), F.lit(1).alias("_left"), *[c for c in left.columns if c not in (by, at)])
    marks = right.select(by, at, value, F.lit(0).alias("_left"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    last = F.last(value, ignorenulls=True).over(W.partitionBy(by).orderBy(at, "_left"))
    return both.withColumn(value, last).filter("_left = 1").drop("_left")
