"""What a reader of retrieved chunks needs around it: contexts, cache keys, costs, and the citing of its figures. The
language model itself is a callable of the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filigrain.operators.cells import cite

#: The line between excerpts, digits of a cache key, how a period is introduced.
BREAK, KEY_DIGITS, PERIOD = "\n\n---\n\n", 24, "period ended "


def contexts(rows: DataFrame, by: str = "qid") -> DataFrame:
    """(by, context): contract rows of each request in rank order as numbered excerpts, each under a line that says where
    it is from. Blank parts of that line are left out."""
    title = F.try_element_at("metadata", F.lit("section_title"))
    named = F.concat_ws(" ", "company_name", F.concat(F.lit("("), "ticker", F.lit(")")), "form", F.concat(F.lit(PERIOD), "reporting_period_end"))
    head = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), named, F.coalesce(F.concat(F.lit(", "), F.nullif(F.concat_ws(" ", "section", title), F.lit(""))), F.lit("")))
    excerpt = F.struct("rank", F.concat(head, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("t"))
    return rows.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(excerpt)), lambda x: x["t"]), BREAK).alias("context"))


def answer_key(*parts: Column) -> Column:
    """The key under which an answer is cached: of the model, the prompt, the question and the context."""
    return F.left(F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256), F.lit(KEY_DIGITS))


def usd(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Dollars of a call at prices per million tokens."""
    return (tokens_in * F.lit(float(price_in)) + tokens_out * F.lit(float(price_out))) / F.lit(1e6)


def filters_of_mode(mode: Column, gold: Column, found: Column) -> Column:
    """The filters of a question under a mode: gold ones, those a pre-check found, or none."""
    return F.when(mode == "gold", gold).when(mode == "precheck", found)


def cited_figures(targets: DataFrame, cited: DataFrame, filings: DataFrame, by: list[str]) -> DataFrame:
    """targets with cell_key, period_match and source: the best cell among the cells of the cited chunks, else among those
    of the same filing; source is cited, filing or null."""
    first = cite(targets, cited, by).withColumn("source", F.when(F.col("cell_key").isNotNull(), "cited"))
    rest = cite(first.filter("cell_key IS NULL").select(*targets.columns), filings, by).withColumn("source", F.when(F.col("cell_key").isNotNull(), "filing"))
    return first.filter("cell_key IS NOT NULL").unionByName(rest)


def citation_summary(found: DataFrame) -> DataFrame:
    """One row: n figures, how many are cited or found in the filing, and the share of those whose period is known."""
    known = F.col("period_match").isNotNull()
    out = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "cited").alias("cited"), F.count_if(F.col("source") == "filing").alias("filing"), F.count_if(known).alias("_dated"))
    return out.select("n", "cited", "filing", F.round(F.try_divide("_dated", F.col("cited") + F.col("filing")), 4).alias("period_known"))


def prior_year(day: Column) -> Column:
    """The same day a year before, the last of February for a 29th."""
    return F.add_months(day, -12)
