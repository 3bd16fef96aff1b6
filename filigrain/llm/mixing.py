"""Mixing sources to target weights by Efraimidis-Spirakis sampling, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.llm.common import WORD, column_or_null, fits_broadcast, fresh, ranked_parts, written

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight of a document: letters among its characters other than white space, 0.05 at least."""
    ink = F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, "\\P{L}+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(letters / F.nullif(ink, F.lit(0)), F.lit(0.05))).cast("double")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """source, source_size, target per source (one row each).

    Sources in code point order, null last, take the weights in turn and share `share` times all words; no target
    exceeds `most` times its source. Resharing the excess by weight until none is above ends where every open
    source gets weight times one level, so the level follows from one running sum in the order of cap / weight."""
    by = W.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by) - 1, F.lit(len(weights))).cast("int") + 1)
    s = sizes.withColumn("_w", turn).withColumn("_cap", F.lit(most) * F.col("source_size"))
    rank = W.orderBy((F.col("_cap") / F.col("_w")), F.col("source").isNull(), "source")
    whole = W.partitionBy()
    s = s.withColumn("_budget", F.lit(share) * F.sum("source_size").over(whole)).withColumn("_all", F.sum("_w").over(whole))
    earlier = rank.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))) / (F.col("_all") - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))))
    level = F.min(F.when(F.col("_cap") > F.col("_w") * F.col("_level"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("v")))).over(whole)["v"]
    return s.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_w") * level, F.col("_cap"))).alias("target"))


def uniform(doc_id: Column, seed: int) -> Column:
    """A reproducible number in (0, 1) from the id alone."""
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(h, 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, quality=letter_share, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs, part, text_hash for every row.

    Whole epochs of a source come first; what is left of its target is filled in the order of the exponential keys
    -ln(u) / quality, and the document at the border gives its first words, so that a source's taken words equal
    the floor of its target. Null text has no words and is taken as nothing; a null source is a source of its own,
    the last. Rows that repeat a doc_id are drawn next to each other. Nulls in doc_id share one key. Extra columns
    are ignored; an empty table gives no rows."""
    text = column_or_null(docs, "text", "string")
    keyed = docs.select(
        column_or_null(docs, "doc_id", "long").alias("doc_id"),
        column_or_null(docs, "source", "string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("text_hash"),
        quality(text).alias("_q"),
    )
    rows = written(keyed.withColumn("_key", -F.ln(uniform(F.col("doc_id"), seed)) / F.col("_q")).drop("_q"), "mixkeys")
    totals = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, most, weights)
    totals = written(totals, "targets")
    parts = ranked_parts(rows, F.col("source").isNull(), F.col("source"), F.col("_key"), F.col("doc_id"), F.col("size"), F.col("text_hash"), name="mixorder")
    # words of the source before each range: one row per (range, source); a source spans many ranges, so none is hot
    sums = parts.groupBy("_part", "source").agg(F.sum("size").alias("_n"))
    base = sums.select("_part", "source", F.coalesce(F.sum("_n").over(W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    base = base.join(totals, base["source"].eqNullSafe(totals["source"])).select(base["_part"], base["source"].alias("_s"), "_base", "source_size", "target")
    inside = W.partitionBy("_part", "source").orderBy("_idx").rowsBetween(W.unboundedPreceding, -1)
    run = parts.withColumn("_run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    j = run.join(base, (run["_part"] == base["_part"]) & run["source"].eqNullSafe(base["_s"]))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size") - F.col("_base") - F.col("_run")
    j = j.withColumn("epochs", epochs).withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))
    return j.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part", "text_hash")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, with their columns: a row per whole epoch, and of the cut epoch a row with the first
    `part` words (joined by single spaces if the document is cut). Documents without words, null texts among them, are
    in no mix.

    A row is known by doc_id, source and text, nulls being equal, so rows that repeat a doc_id with another text or
    source have plans of their own. Rows equal in all three are written together as often as their plans say in sum,
    with the least of their other columns. An empty table gives no rows."""
    one, two, three, copies, cut = fresh(docs, "_id", "_source", "_hash", "_copies", "_cut")
    whole = F.col("part") >= F.col("size")
    plan = mix(docs, **settings).filter("size > 0").groupBy("doc_id", "source", "text_hash").agg(
        (F.sum("epochs") + F.sum(F.when((F.col("part") > 0) & whole, 1).otherwise(0))).alias(copies),
        F.sum(F.when(whole, 0).otherwise(F.col("part"))).alias(cut),
        F.count(F.lit(1)).alias("_rows"),
    )
    plan = written(plan.filter((F.col(copies) > 0) | (F.col(cut) > 0)).withColumnsRenamed({"doc_id": one, "source": two, "text_hash": three}), "mixplan")
    source, words = column_or_null(docs, "source", "string"), F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))

    def drawn(rows: DataFrame, plan: DataFrame) -> DataFrame:
        same = rows["doc_id"].cast("long").eqNullSafe(plan[one]) & source.eqNullSafe(plan[two]) & (F.xxhash64(rows["text"]) == plan[three])
        return rows.join(fits_broadcast(plan.drop("_rows")), same)

    single = drawn(docs, plan.filter("_rows = 1"))
    again = plan.filter("_rows > 1")
    if again.limit(1).count():
        rows = drawn(docs, again)
        others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
        least = [F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_others")] if others else [F.count(F.lit(1)).alias("_others")]
        met = rows.groupBy(*[c for c in docs.columns if c not in others], copies, cut).agg(*least)
        restored = [F.col("_others")[c].alias(c) if c in others else F.col(f"`{c}`") for c in docs.columns]
        single = single.select(*docs.columns, copies, cut).unionByName(met.select(*restored, copies, cut))
    full = F.array_repeat(F.col("text"), F.col(copies).cast("int"))
    first = F.array_join(F.slice(words, F.lit(1), F.col(cut).cast("int")), " ")
    texts = F.when(F.col(cut) > 0, F.concat(full, F.array(first))).otherwise(full)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return single.select(*kept, F.explode(texts).alias("text")).select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
    greatest(0.05, coalesce(length(regexp_replace(t, '\P{L}+', '', 'g'))::DOUBLE
      / nullif(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')), 0), 0.05)) AS q,
    (('0x' || md5('11|' || coalesce(doc_id::VARCHAR, ''))[1:12])::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM d
), s AS (
  SELECT source, sum(size)::DOUBLE AS n,
    [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w
  FROM w GROUP BY source
), r AS (
  SELECT *, 2 * n AS cap, (1.5 * sum(n) OVER () - coalesce(sum(2 * n) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lvl
  FROM s WINDOW o AS (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT min_by(lvl, cap / w) AS lvl FROM r WHERE cap > w * lvl
), t AS (
  SELECT source, n::BIGINT AS source_size, least(cap, coalesce(w * l.lvl, cap)) AS target FROM r, l
), k AS (
  SELECT w.doc_id, w.source, w.size::BIGINT AS size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(w.size) OVER (PARTITION BY w.source ORDER BY -ln(u) / q, w.doc_id, w.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS run
  FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 3) AS target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - run)))::BIGINT AS taken
FROM k
"""
