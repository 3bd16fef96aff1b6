"""Retrieval scores and the reports made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W


def score(results: DataFrame, hits: DataFrame, ks: tuple[int, ...] = (5, 10), expected: DataFrame | None = None) -> DataFrame:
    """Per qid: mrr, and for each k evidence_recall, hit. results(qid, rank, pos); hits(qid, item, pos): which chunk
    satisfies which evidence item; items without any chunk have a null pos.

    With expected(qid, pos), the chunks whose metadata are as expected (a null pos where a query expects what no chunk
    has), also provenance per k: their share of the first k results, null without an expectation or results."""
    items = hits.groupBy("qid").agg(F.count_distinct("item").alias("_items"))
    found = hits.join(results, ["qid", "pos"]).groupBy("qid", "item").agg(F.min("rank").alias("r"))
    per = found.groupBy("qid").agg(F.min("r").alias("first"), *[F.count_if(F.col("r") <= k).alias(f"_n{k}") for k in ks])
    j = items.join(per, "qid", "left")
    out = [F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 4).alias("mrr")]
    for k in ks:
        n = F.coalesce(F.col(f"_n{k}"), F.lit(0))
        out += [F.round(n / F.col("_items"), 4).alias(f"evidence_recall_{k}"), (n > 0).cast("long").alias(f"hit_{k}")]
    if expected is not None:
        want = expected.select("qid", "pos").distinct()
        mine = results.join(want.select("qid").distinct(), "qid").join(want.withColumn("_m", F.lit(1)), ["qid", "pos"], "left")
        share = [F.round(F.try_divide(F.count_if((F.col("rank") <= k) & F.col("_m").isNotNull()), F.count_if(F.col("rank") <= k)), 4).alias(f"provenance_{k}") for k in ks]
        j = j.join(mine.groupBy("qid").agg(*share), "qid", "left")
        out += [F.col(f"provenance_{k}") for k in ks]
    return j.select("qid", *out)


def summary(scores: DataFrame, keys: list[str], tier: str, metrics: list[str]) -> DataFrame:
    """Means per (keys, tier) and per keys with tier ALL: two grouping sets, nulls left out of means."""
    cells = [F.round(F.avg(m), 4).alias(m) for m in metrics]
    sets = scores.groupingSets([[F.col(k) for k in [*keys, tier]], [F.col(k) for k in keys]], *[F.col(k) for k in [*keys, tier]])
    out = sets.agg(F.grouping(F.col(tier)).alias("_all"), F.count(F.lit(1)).alias("n"), *cells)
    return out.withColumn(tier, F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(tier))).drop("_all")


def paired(a: DataFrame, b: DataFrame, key: str, metric: str) -> DataFrame:
    """wins, losses, ties of b against a."""
    j = a.select(key, F.col(metric).alias("x")).join(b.select(key, F.col(metric).alias("y")), key)
    return j.agg(F.count_if(F.col("y") > F.col("x")).alias("wins"), F.count_if(F.col("y") < F.col("x")).alias("losses"), F.count_if(F.col("y") == F.col("x")).alias("ties"))


def nearest_index_percentile(df: DataFrame, keys: list[str], value: str, qs: dict[str, float], accuracy: int = 10_000, floor: bool = False) -> DataFrame:
    """Per keys and name of qs the value at index round-half-even(q (n - 1)) of the ascending non-null values, or with
    `floor` at index int(q n), the last at most.

    A first pass brackets every index by approximate percentiles two error bounds to each side; a second one counts
    what lies below the brackets and ranks what lies inside, so a key's rows never meet in one task."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    sides = [min(1.0, max(0.0, q + side * 2 / accuracy)) for q in qs.values() for side in (-1, 1)]
    bounds = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, sides, accuracy).alias("_b"))

    def at(q: float) -> Column:
        place = F.least(F.floor(F.lit(q) * F.col("_n")), F.col("_n") - 1) if floor else F.bround(F.lit(q) * (F.col("_n") - 1))
        return place.cast("long")

    large = F.col("_n") >= 2 * accuracy  # then a bracket holds some places to each side; smaller keys are ranked whole
    edges = [F.struct(F.lit(name).alias("name"), at(q).alias("i"), F.when(large, F.get("_b", 2 * k)).alias("lo"), F.when(large, F.get("_b", 2 * k + 1)).alias("hi")) for k, (name, q) in enumerate(qs.items())]
    wanted = bounds.select(*keys, F.explode(F.array(*edges)).alias("w")).select(*keys, "w.*")
    met = rows.join(wanted, keys).filter(F.col("hi").isNull() | (F.col(value) <= F.col("hi")))
    inside = met.filter(F.col("lo").isNull() | (F.col(value) >= F.col("lo"))).groupBy(*keys, "name", "i", value).agg(F.count(F.lit(1)).alias("_m"))
    below = met.filter(F.col(value) < F.col("lo")).groupBy(*keys, "name").agg(F.count(F.lit(1)).alias("_below"))
    upto = F.sum("_m").over(W.partitionBy(*keys, "name").orderBy(value)) + F.coalesce("_below", F.lit(0))
    found = inside.join(below, [*keys, "name"], "left").withColumn("_upto", upto).filter((F.col("_upto") > F.col("i")) & (F.col("_upto") - F.col("_m") <= F.col("i")))
    return found.groupBy(*keys).pivot("name", list(qs)).agg(F.first(value))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa (n, agreement, kappa) of two label columns, from the confusion counts."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("ra"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("cb"))
    chance = rows.join(cols, F.col("a") == F.col("b")).agg(F.coalesce(F.sum(F.col("ra") * F.col("cb")), F.lit(0)).alias("e"))
    po, pe = F.col("same") / F.col("t"), F.col("e") / (F.col("t") * F.col("t"))
    return total.join(F.broadcast(chance)).select(F.col("t").alias("n"), F.round(po, 6).alias("agreement"), F.round(F.when(pe == 1, 1.0).otherwise((po - pe) / (1 - pe)), 6).alias("kappa"))
