"""Requests read from the words of questions: companies, period ends, fiscal years, quarters and forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filigrain.functions.text import normal_name

#: Dates, fiscal years, quarters and forms in questions.
DATE = r"(?i)\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\s+\d{1,2},?\s+(?:19|20)\d\d\b"
ISO = r"\b(?:19|20)\d\d-\d{2}-\d{2}\b"
FISCAL_YEAR = r"(?i)\b(?:FY|fiscal(?:\s+year)?)\s*'?(\d{4}|\d{2})\b"
QUARTER = r"(?i)\bQ([1-4])\b"
FORM = r"(?i)\b10-?([KQ])\b"


def period_ends(question: Column) -> Column:
    """Dates in the question, once each, without those that say when something was filed or seen."""
    dated = F.regexp_replace(question, r"(?i)\b(?:as of|snapshot|filed)(?:\s+on)?\s+(?=(?:january|february|march|april|may|june|july|august|september|october|november|december)\s+\d)", "~")
    long = F.filter(F.regexp_extract_all(dated, F.lit("~?" + DATE.replace(r"\b(?:jan", "(?:jan")), F.lit(0)), lambda d: ~F.startswith(d, F.lit("~")))
    read = F.transform(long, lambda d: F.try_to_timestamp(F.initcap(F.regexp_replace(d, r"[,\s]+", " ")), F.lit("MMMM d yyyy")).cast("date"))
    iso = F.transform(F.regexp_extract_all(question, F.lit(ISO), F.lit(0)), lambda d: d.try_cast("date"))
    return F.array_distinct(F.filter(F.concat(read, iso), lambda d: d.isNotNull()))


def periods(question: Column) -> list[Column]:
    years = F.transform(F.regexp_extract_all(question, F.lit(FISCAL_YEAR), F.lit(1)), lambda y: F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y).cast("int"))
    quarters = F.transform(F.regexp_extract_all(question, F.lit(QUARTER), F.lit(1)), lambda q: F.concat(F.lit("Q"), q))
    forms = F.transform(F.regexp_extract_all(question, F.lit(FORM), F.lit(1)), lambda f: F.concat(F.lit("10-"), F.upper(f)))
    return [F.array_distinct(years).alias("fiscal_years"), F.array_distinct(quarters).alias("fiscal_periods"), F.array_distinct(forms).alias("forms")]


def companies(questions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(qid, tickers) of questions(qid, question) by aliases(alias, ticker): runs of words that are an alias in normal
    form, longest first; words of a longer alias serve no shorter one. A ticker itself counts in capitals. Runs are as
    long as some alias is, with room for a legal ending of one or two words.

    Runs of words are joined with aliases, so neither side has to fit on one machine."""
    sizes = aliases.select(F.size(F.split(normal_name(F.col("alias")), " ")).alias("n")).distinct()
    lengths = sorted({1, *(r["n"] + extra for r in sizes.collect() for extra in (0, 1, 2))})  # one number for each length
    words = questions.select("qid", F.split(F.trim(F.regexp_replace("question", r"[^A-Za-z0-9&']+", " ")), " ").alias("w"))
    words = words.withColumn("w", F.transform("w", lambda x: F.regexp_replace(x, "'s$|'", "")))
    at = words.select("qid", "w", F.posexplode("w").alias("i", "_")).select("qid", "w", "i", F.explode(F.array(*map(F.lit, lengths))).alias("n")).filter(F.col("i") + F.col("n") <= F.size("w"))
    runs = at.select("qid", "i", "n", F.array_join(F.slice("w", F.col("i") + 1, F.col("n")), " ").alias("run"))
    known = aliases.select(normal_name(F.col("alias")).alias("key"), "ticker").filter("key <> ''").groupBy("key").agg(F.min("ticker").alias("ticker"))
    tickers = aliases.select(F.col("ticker").alias("run"), "ticker").distinct()
    named = runs.withColumn("key", F.trim(F.regexp_replace(F.lower("run"), " +", " "))).join(known, "key").select("qid", "i", "n", "ticker")
    found = named.union(runs.filter("n = 1").join(tickers, "run").select("qid", "i", "n", "ticker"))
    hits = found.groupBy("qid").agg(F.array_sort(F.collect_set(F.struct((-F.col("n")).alias("n"), "i", "ticker"))).alias("h"))
    # longest first; a run that overlaps one taken before is passed over
    taken = F.aggregate("h", F.array().cast("array<struct<n:int,i:int,ticker:string>>"), lambda out, x: F.when(F.exists(out, lambda y: (x["i"] < y["i"] - y["n"]) & (y["i"] < x["i"] - x["n"])), out).otherwise(F.concat(out, F.array(x))))
    order = F.array_sort(F.transform(taken, lambda x: F.struct(x["i"].alias("i"), x["ticker"].alias("t"))))
    return hits.select("qid", F.array_distinct(F.transform(order, lambda x: x["t"])).alias("tickers"))


def extract(questions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(qid, tickers, period_ends, fiscal_years, fiscal_periods, forms) of questions(qid, question), empty arrays where
    a question says nothing."""
    q = F.col("question")
    rows = questions.select("qid", period_ends(q).alias("period_ends"), *periods(q))
    none = F.array().cast("array<string>")
    return rows.join(companies(questions, aliases), "qid", "left").select("qid", F.coalesce("tickers", none).alias("tickers"), "period_ends", "fiscal_years", "fiscal_periods", "forms")
