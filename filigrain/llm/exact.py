"""Exact deduplication with a heavy-hitter split, DataFrame functions only.

A bounded Misra-Gries summary (Spark's approx_top_k, the merging frequent-items sketch of that family) names
digests that may be frequent. Their exact winners and counts come from one map-side-combined aggregation and are
broadcast, so rows of frequent digests are decided where they lie. Only the remaining digests are shuffled. All
counters of the summary are candidates, so a digest outside it holds at most about 1/TRACKED of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.llm.common import SPACES, column_or_null, fits_broadcast, fresh, written


def squeezed(text: Column) -> Column:
    """Text without any character of [\\x20\\x09-\\x0D]; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id, text_sha256, _len (code points of the original text)."""
    text = column_or_null(docs, "text", "string")
    return docs.select(
        column_or_null(docs, "doc_id", "long").alias("doc_id"),
        F.sha2(squeezed(text).cast("binary"), 256).alias("text_sha256"),
        F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("_len"),
    )


#: Counters of the summary, and candidates at most.
TRACKED = 4096


def heavy_hitters(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The digests that a Misra-Gries summary of `tracked` counters finds more than once, `tracked` at most."""
    top = rows.agg(F.expr(f"approx_top_k(text_sha256, {tracked}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("text_sha256"), F.col("t.count").alias("_seen")).filter("_seen > 1").drop("_seen")


def _winners(rows: DataFrame) -> DataFrame:
    """Per digest the row with the most code points, then the smallest doc_id (a null id last), and the count."""
    best = F.min(F.struct((-F.col("_len")).alias("l"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d")))
    return rows.groupBy("text_sha256").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size")).select("text_sha256", F.col("b.d").alias("keep_id"), "group_size")


def exact_groups(docs: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs, dropped ones too.

    Null text counts as empty, and all empty texts are one group. Rows that repeat a doc_id are separate rows of
    the group and carry one decision (keep_first settles them). A null doc_id loses every tie. Extra columns are
    ignored; an empty table gives no rows."""
    rows = written(digests(docs), "digests")
    candidates = heavy_hitters(rows, tracked)
    # verified: exact counts and winners of the candidates; map-side combining leaves at most `tracked` rows a task
    winners = written(_winners(rows.join(F.broadcast(candidates), "text_sha256", "left_semi")).filter("group_size > 1"), "heavy")
    small = F.broadcast(winners)  # at most `tracked` rows of 100 bytes
    hot = rows.join(small, "text_sha256")
    rest = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    light = rest.join(_winners(rest), "text_sha256")
    return hot.unionByName(light).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, **limits) -> DataFrame:
    """The documents that stay, with their columns: of equal texts the one with the most code points, then the smallest
    doc_id.

    Rows with one doc_id and equal texts stay once, the longest, then the least text. Null text is empty, so of all
    empty and null texts one stays. A null doc_id loses every tie but is kept where its text is its own. Other columns
    pass through under any names; an empty table gives no rows."""
    marks = written(exact_groups(docs, **limits), "marks")
    one, two, doc, digest, place = fresh(docs, "_id", "_sha", "_doc", "_digest", "_place")
    gone = marks.filter("NOT kept").select("doc_id", "text_sha256").distinct().toDF(one, two)
    again = marks.filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n").toDF(one, two)
    out = docs.withColumns({doc: F.col("doc_id").cast("long"), digest: F.sha2(squeezed(F.col("text")).cast("binary"), 256)})

    def same(other: DataFrame) -> Column:
        return out[doc].eqNullSafe(other[one]) & (out[digest] == other[two])

    gone = fits_broadcast(written(gone, "gone"))
    out = out.join(gone, same(gone), "left_anti")
    again = written(again, "again")
    if again.limit(1).count():
        again = fits_broadcast(again)
        first = W.partitionBy(doc, digest).orderBy(F.desc(F.char_length("text")), "text")
        kept = out.join(again, same(again), "left_semi").withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place)
        out = out.join(again, same(again), "left_anti").unionByName(kept)
    return out.select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), h AS (
  SELECT doc_id, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM d
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
  text_sha256
FROM h
"""
