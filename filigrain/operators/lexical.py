"""BM25 over a whole corpus for many queries in one plan. Statistics are global: filters mask candidates only."""

from __future__ import annotations

from collections import namedtuple
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.functions.text import tokens
from filigrain.session import written

K1, B = 1.5, 0.75
#: Bytes of query terms that are broadcast at most.
BROADCAST_BYTES = 24 << 20
#: Pairs of a query and a chunk that one task counts and sorts at most.
TASK_PAIRS = 1 << 20
#: Terms of the most chunks that `rarest` broadcasts at most.
COMMON_TERMS = 1 << 16
LexicalIndex = namedtuple("LexicalIndex", "postings terms corpus")


def _tokenised(chunks: DataFrame, pos: str, text: str) -> DataFrame:
    """(pos, dl, toks) of all chunks."""
    return chunks.select(F.col(pos).alias("pos"), tokens(F.col(text)).alias("toks")).withColumn("dl", F.size("toks").cast("long"))


def _each(rows: DataFrame, terms: Column | str, *keep: str) -> DataFrame:
    """(pos, dl, *keep, term) of arrays. From `explode` Spark derives a filter on the array, for which each text is tokenised once more."""
    return rows.select("pos", "dl", *keep, F.explode_outer(terms).alias("term")).filter("term IS NOT NULL")


def _repeats(chunks: DataFrame, pos: str) -> bool:
    """Whether chunks share a position; then equal terms of such of one length are one posting."""
    return not chunks.groupBy(pos).count().filter("count > 1").isEmpty()


def _frequencies(toks: DataFrame, repeats: bool) -> DataFrame:
    """terms(term, df) of tokenised chunks, counted before anything is shuffled: no task gets all chunks of a term."""
    each = _each(toks, F.array_distinct("toks"))
    return (each.distinct() if repeats else each).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def build(chunks: DataFrame, pos: str = "pos", text: str = "text") -> LexicalIndex:
    """postings(term, pos, tf, dl), terms(term, df), corpus(n, avgdl: one row)."""
    toks = _tokenised(chunks, pos, text)
    corpus = toks.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    postings = _each(toks, "toks").groupBy("term", "pos", "dl").agg(F.count(F.lit(1)).alias("tf"))
    return LexicalIndex(postings, _frequencies(toks, _repeats(chunks, pos)), corpus)


def statistics(chunks: DataFrame, pos: str = "pos", text: str = "text") -> DataFrame:
    """One row (n, avgdl, terms, tokens) of one pass: a chunk's first term, or the empty row of one without terms, carries
    its length, and terms are counted before anything is shuffled."""
    toks = _tokenised(chunks, pos, text)
    each = toks.select("dl", F.posexplode_outer(F.array_distinct("toks")).alias("at", "term"))
    each = each.select("term", F.coalesce(F.col("at") == 0, F.lit(True)).alias("first"), "dl")
    terms = each.groupBy("term").agg(F.count_if("first").alias("n"), F.count(F.when(F.col("first"), F.col("dl"))).alias("known"), F.sum(F.when(F.col("first"), F.col("dl"))).alias("dls"))
    total = terms.agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("dls").alias("dls"), F.count("term").alias("terms"))
    return total.select(F.coalesce("n", F.lit(0).cast("long")).alias("n"), (F.col("dls") / F.nullif("known", F.lit(0))).alias("avgdl"), "terms", F.nullif("dls", F.lit(0)).alias("tokens"))


def _common_from(terms: DataFrame, most: int) -> int:
    """The smallest df that `most` terms have or exceed at most."""
    least, n = None, 0
    for row in terms.groupBy("df").count().orderBy(F.desc("df")).collect():  # few: as many terms of n, n - 1, ... chunks are met
        n += row["count"]
        if n > most:
            break
        least = row["df"]
    return 2**63 - 1 if least is None else least


def _has_rare(array: str, common: DataFrame, k: int, slots: int) -> Column:
    """Whether k terms are surely not common: a byte by the terms' hash tells where a common one is. The first terms mostly do."""
    slot = lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int")
    table = bytearray(slots)
    for row in common.select(slot(F.col("term")).alias("at")).distinct().collect():
        table[row["at"]] = 1
    has = lambda terms: F.size(F.filter(terms, lambda t: F.substring(F.lit(bytes(table)), slot(t) + 1, F.lit(1)) == F.lit(b"\0"))) >= k
    return has(F.slice(array, 1, 32)) | has(F.col(array))


def rarest(chunks: DataFrame, k: int = 3, pos: str = "pos", text: str = "text", most: int = COMMON_TERMS) -> DataFrame:
    """(pos, term, df, rank): the k terms of each chunk that the fewest chunks have, ties by term.

    Terms of so many chunks that `most` terms have as many are common. They are broadcast, and a chunk with k others goes
    on without them, as those come first. What is left is written, as it is joined in two ways: common terms are known,
    others, which few chunks have, are dealt by term."""
    toks, repeats = _tokenised(chunks, pos, text), _repeats(chunks, pos)
    terms = written(_frequencies(toks, repeats), "terms")
    least = _common_from(terms, most)
    common = terms.filter(F.col("df") >= least)
    sets = toks.select("pos", "dl", F.array_distinct("toks").alias("all")).withColumn("enough", _has_rare("all", common, k, 8 * most))
    each = _each(sets, "all", "enough").join(F.broadcast(common), "term", "left")
    held = written(each.filter("df IS NULL OR NOT enough").drop("enough"), "held")
    rare = held.filter("df IS NULL").drop("df").join(terms.filter(F.col("df") < least).hint("shuffle_hash"), "term")
    rows = held.filter("df IS NOT NULL").unionByName(rare)
    rows = rows.dropDuplicates(["term", "pos", "dl"]) if repeats else rows
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("pos").orderBy("df", "term")))
    return rows.filter(F.col("rank") <= k).select("pos", "term", "df", "rank")


def query_terms(queries: DataFrame) -> DataFrame:
    """(qid, term) of queries(qid, query); query terms count once each."""
    return queries.select("qid", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))


def _blocks(asked: DataFrame, most: int, chunks: DataFrame, pairs: int) -> list[tuple[DataFrame, int]]:
    """Rows (qid, term, ...) whole if they are measured to take `most` bytes at most, else cut by a hash of qid; each with
    the number of partitions over which chunks are dealt, so that `pairs` of a query and a chunk meet in a task at most."""
    n, wide, qids = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("term")), F.count_distinct("qid")).first()
    blocks = max(1, -(-(n * 48 + (wide or 0)) // most))
    parts = max(-(-chunks.count() * -(-qids // blocks) // pairs), chunks.sparkSession.sparkContext.defaultParallelism)
    return [(asked.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i) if blocks > 1 else asked, parts) for i in range(blocks)]


def scores(chunks: DataFrame, queries: DataFrame, pos: str = "pos", text: str = "text", most: int = BROADCAST_BYTES, keep: tuple[str, ...] = (), allowed: Column | None = None, pairs: int = TASK_PAIRS) -> DataFrame:
    """(qid, pos, *keep, score) of queries(qid, query) over all chunks; `keep` are columns of chunks that go along,
    `allowed` a condition on chunks that may be candidates (statistics are of all).

    Texts are tokenised once. Only tokens that some query has go on, with an empty one per chunk that counts chunks
    and lengths; they are dealt by chunk, so term counts and scores need no shuffle by term, where a common term would
    gather all chunks in one task. The queries' terms are broadcast, in blocks of `most` bytes if there are more. A task
    gets so few chunks that it holds `pairs` scores at most, however many chunks there are."""
    may = F.lit(True) if allowed is None else F.coalesce(allowed, F.lit(False))
    toks = chunks.select(F.col(pos).alias("pos"), *keep, may.alias("_may"), tokens(F.col(text)).alias("toks"))
    toks = toks.select("pos", *keep, "_may", F.size("toks").cast("long").alias("dl"), F.explode(F.concat(F.array(F.lit("")), "toks")).alias("term"))
    toks = toks.withColumn("term", F.coalesce("term", F.lit("")))
    blocks = _blocks(query_terms(queries), most, chunks, pairs)
    return reduce(DataFrame.unionByName, [_block_scores(toks, asked, parts, keep) for asked, parts in blocks])


def _block_scores(toks: DataFrame, asked: DataFrame, parts: int, keep: tuple[str, ...]) -> DataFrame:
    count_all = asked.sparkSession.createDataFrame([("",)], "term string")
    met = toks.join(F.broadcast(asked.select("term").union(count_all).distinct()), "term", "left_semi").repartition(parts, "pos")
    postings = met.groupBy("pos", *keep, "_may", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("dl").alias("_dls"))
    corpus = terms.filter("term = ''").select(F.col("df").alias("n"), (F.col("_dls") / F.col("df")).alias("avgdl"))
    idf = F.ln((F.col("n") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)) + F.lit(1.0))
    weights = terms.join(F.broadcast(corpus)).select("term", idf.alias("idf"), "avgdl")  # corpus is one row
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.col("avgdl"))
    hit = postings.join(F.broadcast(asked.join(weights, "term")), "term")
    hit = hit.filter(F.when(F.col("_may"), F.col("idf")).isNotNull())  # of both sides, so it stays above the dealing, which serves counts and scores
    return hit.groupBy("pos", "qid", *keep).agg(F.sum(F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("score")).select("qid", "pos", *keep, "score")


def indexed_scores(index: LexicalIndex, queries: DataFrame) -> DataFrame:
    """scores over a stored index: only the postings of the queries' terms are read."""
    hit = index.postings.join(query_terms(queries), "term").join(index.terms, "term").join(F.broadcast(index.corpus))  # corpus is one row
    idf = F.ln((F.col("n") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)) + F.lit(1.0))
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.col("avgdl"))
    return hit.groupBy("qid", "pos").agg(F.sum(idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("score"))


def keyword_overlap(chunks: DataFrame, queries: DataFrame, top_k: int = 10, pos: str = "pos", text: str = "text", pairs: int = TASK_PAIRS) -> DataFrame:
    """(qid, pos, score, rank): common distinct words over the root of the product of both counts, best first, ties by
    position; chunks without a common word are left out. Words are runs of a-z and 0-9, lower-cased. A task holds `pairs`
    of a query and a chunk at most."""

    def words(c: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(F.col(c)), F.lit("[a-z0-9]+"), F.lit(0)))

    asked = queries.select("qid", words("query").alias("q")).select("qid", F.size("q").alias("m"), F.explode("q").alias("term"))
    rows = chunks.select(F.col(pos).alias("pos"), words(text).alias("p")).select("pos", F.size("p").alias("n"), F.explode("p").alias("term"))

    def common(block: DataFrame, parts: int) -> DataFrame:
        return rows.repartition(parts, "pos").join(F.broadcast(block), "term").groupBy("pos", "qid", "m", "n").agg(F.count(F.lit(1)).alias("c"))

    hit = reduce(DataFrame.unionByName, [common(*block) for block in _blocks(asked, BROADCAST_BYTES, chunks, pairs)])
    return top(hit.select("qid", "pos", (F.col("c") / F.sqrt(F.col("m") * F.col("n"))).alias("score")), top_k)


def top(scored: DataFrame, candidates: int = 100, positive: bool = True) -> DataFrame:
    """Best `candidates` per query, ties by position; scores of 0 or less go after the cut. Rounded to 6 digits for a
    sum that does not depend on the order of addition."""
    ranked = scored.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), "pos"))).filter(F.col("rank") <= candidates)
    return ranked.filter("score > 0") if positive else ranked


def bm25(chunks: DataFrame, queries: DataFrame, allowed: DataFrame | Column | None = None, candidates: int = 100, pos: str = "pos", text: str = "text") -> DataFrame:
    """(qid, pos, score, rank). allowed: a condition on chunks, or rows (qid, pos) or (pos), that may be candidates."""
    mask = allowed if isinstance(allowed, Column) else None
    scored = scores(chunks, queries, pos, text, allowed=mask)
    if allowed is not None and mask is None:
        scored = scored.join(allowed, [c for c in ("qid", "pos") if c in allowed.columns], "left_semi")
    return top(scored, candidates)
