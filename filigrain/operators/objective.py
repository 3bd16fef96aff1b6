"""Question sets drawn from reported metrics: what may be asked, which of it is drawn, and the wording.

rows hold one reported value each: ticker, company_name, cik, accession_number, form, filing_date, reporting_period_end,
metric_key, statement_type, period_kind, period_start, period_end, duration_days, value, concept_names, status, cell_key,
display_text and whatever else. Everything is column expressions and windows; draws follow a hash of the row and a seed,
so that they can be repeated on any number of machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

#: The metrics' names in questions, rows a company gives by statement, the share about its own period.
LABELS = {
    "revenue": "total revenue",
    "cost_of_revenue": "total cost of revenue",
    "operating_income": "operating income",
    "net_income": "net income",
    "eps_diluted": "diluted earnings per share",
    "cash_and_equivalents": "cash and cash equivalents",
    "long_term_debt_current": "current portion of long-term debt",
    "long_term_debt_noncurrent": "long-term debt, excluding the current portion",
    "shareholders_equity": "total shareholders' equity",
    "short_term_borrowings": "short-term borrowings",
    "total_assets": "total assets",
    "total_liabilities": "total liabilities",
    "capital_expenditures": "capital expenditures (cash paid for property, plant and equipment)",
    "dividends_paid": "cash dividends paid",
    "operating_cash_flow": "net cash provided by (used in) operating activities",
}
QUOTAS = {"income_statement": 6, "balance_sheet": 5, "cash_flow_statement": 4}
CURRENT_SHARE, COMPANIES = 2 / 3, 100
#: A printed number, scales, days of a month, endings of company names.
PRINTED = r"\d[\d,]*(?:\.\d+)?"
SCALES = (1.0, 1e3, 1e6, 1e9)
MONTH_DAYS = 30.44
ENDING = r"(?i)[,.]?\s+(inc|incorporated|corp|corporation|co|company|plc|ltd|limited|n\.?v|s\.?a)\.?$"


def printed_number(display: Column) -> Column:
    """The first number of a printed cell as a double; null without one."""
    return F.replace(F.nullif(F.regexp_extract(display, PRINTED, 0), F.lit("")), F.lit(","), F.lit("")).cast("double")


def printed_scale(value: Column, display: Column) -> Column:
    """1, 1e3, 1e6 or 1e9: the first that value over printed number meets within one percent; else null."""
    ratio = F.abs(value.cast("double")) / F.nullif(printed_number(display), F.lit(0.0))
    return F.coalesce(*[F.when(F.abs(ratio / s - 1) < 0.01, F.lit(s)) for s in SCALES])


def printed_digits(display: Column) -> Column:
    """Significant figures of the first number: no leading zeros, no trailing zeros of a whole number, 1 at least."""
    shown = F.replace(F.regexp_extract(display, PRINTED, 0), F.lit(","), F.lit(""))
    bare = F.ltrim(F.replace(shown, F.lit("."), F.lit("")), F.lit("0"))
    bare = F.when(F.contains(shown, F.lit(".")), bare).otherwise(F.rtrim(bare, F.lit("0")))
    return F.when(shown != "", F.greatest(F.char_length(bare), F.lit(1)).cast("long"))


def months(duration_days: Column) -> Column:
    """3, 6, 9 or 12 months of a duration in days; else null."""
    m = F.bround(duration_days / F.lit(MONTH_DAYS)).cast("int")
    return F.when(m.isin(3, 6, 9, 12), m)


def long_date(day: Column) -> Column:
    return F.date_format(day.cast("date"), "MMMM d, y")


def period_phrase(kind: Column, period_end: Column, duration_days: Column) -> Column:
    """as of a day, for a fiscal year, or for three, six or nine months; null for other durations."""
    m, day = months(duration_days), long_date(period_end)
    word = F.when(m == 3, "three").when(m == 6, "six").when(m == 9, "nine")
    span = F.when(m == 12, F.concat(F.lit("for the fiscal year ended "), day)).otherwise(F.concat(F.lit("for the "), word, F.lit(" months ended "), day))
    return F.when(kind == "instant", F.concat(F.lit("as of "), day)).otherwise(span)


def answer_unit(metric: Column, value: Column, display: Column) -> Column:
    """struct(phrase, divisor): per share, or thousands where the table prints thousands, else millions."""
    def unit(phrase: str, divisor: float) -> Column:
        return F.struct(F.lit(phrase).alias("phrase"), F.lit(divisor).alias("divisor"))

    thousands = F.coalesce(printed_scale(value, display) == 1e3, F.lit(False))
    return F.when(metric == "eps_diluted", unit("USD per share", 1.0)).when(thousands, unit("USD thousands", 1e3)).otherwise(unit("USD millions", 1e6))


def company_name(ticker: Column, raw: Column, known: dict[str, str] | None = None) -> Column:
    """The name for a question: a known one, else without two legal endings, capitals only kept in acronyms."""
    name = F.trim(F.coalesce(F.nullif(raw, F.lit("")), ticker))
    for _ in range(2):
        name = F.btrim(F.regexp_replace(name, ENDING, ""), F.lit(" ,."))
    acronym = lambda w: w.rlike("^[A-Za-z]+$") & ((F.char_length(w) <= 2) | ~w.rlike("[AEIOUY]"))
    words = F.transform(F.filter(F.split(name, r"\s+"), lambda w: w != ""), lambda w: F.when(acronym(w), w).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1 << 20)))))
    out = F.when((name == F.upper(name)) & name.rlike("[A-Z]"), F.array_join(words, " ")).otherwise(name)
    given = F.lit(None).cast("string")
    for key, value in (known or {}).items():
        given = F.when(ticker == key, F.lit(value)).otherwise(given)
    return F.coalesce(given, out)


def label(metric: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, value in LABELS.items():
        out = F.when(metric == key, F.lit(value)).otherwise(out)
    return out


def with_question(rows: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """rows plus question and answer_unit."""
    who = company_name(F.col("ticker"), F.col("company_name"), known)
    whose = F.when(F.endswith(who, F.lit("'s")), who).when(F.endswith(who, F.lit("s")), F.concat(who, F.lit("'"))).otherwise(F.concat(who, F.lit("'s")))
    phrase = period_phrase(F.col("period_kind"), F.col("period_end"), F.col("duration_days"))
    unit = answer_unit(F.col("metric_key"), F.col("value"), F.col("display_text"))["phrase"]
    text = F.concat(F.lit("What was "), whose, F.lit(" "), label(F.col("metric_key")), F.lit(" "), phrase, F.lit("? Answer in "), unit, F.lit("."))
    return rows.withColumns({"answer_unit": unit, "question": text})


def bare_concept(concept: Column) -> Column:
    return F.element_at(F.split(concept, ":"), -1)


def used_keys(gold: DataFrame, facts: str = "facts") -> DataFrame:
    """Distinct (ticker, concept, period_end) of the facts (arrays of such structs) that questions already use."""
    f = gold.select(F.explode(facts).alias("f")).select(F.upper("f.ticker").alias("ticker"), bare_concept(F.col("f.concept")).alias("concept"), F.left(F.col("f.period_end").cast("string"), F.lit(10)).alias("period_end"))
    return f.dropna().filter("ticker <> '' AND concept <> '' AND period_end <> ''").distinct()


def marked_used(rows: DataFrame, used: DataFrame, id_: str) -> DataFrame:
    """rows plus used: whether any concept of the row at its period end is among the used keys."""
    asked = rows.select(id_, F.upper("ticker").alias("ticker"), F.explode(F.transform("concept_names", bare_concept)).alias("concept"), F.left(F.col("period_end").cast("string"), F.lit(10)).alias("period_end"))
    hit = asked.join(used, ["ticker", "concept", "period_end"], "left_semi").select(id_).distinct().withColumn("used", F.lit(True))
    return rows.join(hit, id_, "left").withColumn("used", F.coalesce("used", F.lit(False)))


def judged(rows: DataFrame, id_: str) -> DataFrame:
    """rows (with used) plus reason: the first exclusion that holds, null for rows of the population.

    Of rows about one (ticker, metric_key, period_start, period_end) the one stays whose filing is about that period,
    then the latest filing, then the smallest id."""
    unsupported = label(F.col("metric_key")).isNull() | period_phrase(F.col("period_kind"), F.col("period_end"), F.col("duration_days")).isNull()
    rules = [
        ("no_ticker", F.coalesce(F.col("ticker"), F.lit("")) == ""),
        ("4_conflict_or_review", F.col("status").isin("conflict", "review_required")),
        ("1_zero_or_nil", F.coalesce(F.col("value"), F.lit(0.0)) == 0),
        ("2_no_linked_cell", F.coalesce(F.col("cell_key"), F.lit("")) == ""),
        ("unsupported_metric_or_period", unsupported),
        ("5_used_by_dev_or_holdout", F.col("used")),
    ]
    reason = F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in rules])
    own = (F.col("period_end") == F.col("reporting_period_end")).cast("int")
    # rows already excluded stand in partitions of their own, so they neither win nor lose
    key = ["ticker", "metric_key", "period_start", "period_end", F.when(F.col("reason").isNotNull(), F.col(id_))]
    place = F.row_number().over(W.partitionBy(*key).orderBy(F.desc(own), F.desc(F.coalesce("filing_date", F.lit(""))), id_))
    return rows.withColumn("reason", reason).withColumn("_place", place).withColumn("reason", F.coalesce("reason", F.when(F.col("_place") > 1, "3_duplicate_period"))).drop("_place")


def exclusions(marked: DataFrame) -> DataFrame:
    """(reason, n) of judged rows; kept rows count as kept."""
    return marked.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _draw(id_: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_).cast("string")))


def hash_sample(rows: DataFrame, by: str, id_: str, n: int, seed: int = 0) -> DataFrame:
    """The first n rows of each value of `by` in the order of a seeded hash of their ids."""
    place = F.row_number().over(W.partitionBy(by).orderBy(_draw(id_, seed), id_))
    return rows.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")


def drawn_by_company(pool: DataFrame, id_: str, quotas: dict[str, int] | None = None, seed: int = 0) -> DataFrame:
    """pool rows drawn per ticker, with relation (current or prior): each statement's quota, two thirds of it about the
    filing's own period; a short stratum is filled from the rest of its statement, a short company from all of its rows."""
    quotas = quotas or QUOTAS
    quota = F.lit(0)
    for name, n in quotas.items():
        quota = F.when(F.col("statement_type") == name, F.lit(n)).otherwise(quota)
    share = F.bround(quota * F.lit(CURRENT_SHARE)).cast("int")
    now = F.col("period_end") == F.col("reporting_period_end")
    rows = pool.withColumns({"relation": F.when(now, "current").otherwise("prior"), "_draw": _draw(id_, seed), "_quota": quota})
    stratum = W.partitionBy("ticker", "statement_type", "relation").orderBy("_draw")
    rows = rows.withColumn("_in", F.row_number().over(stratum))
    first = F.col("_in") <= F.when(F.col("relation") == "current", share).otherwise(F.col("_quota") - share)
    statement = W.partitionBy("ticker", "statement_type").orderBy(F.desc("_first"), "relation", "_draw")
    rows = rows.withColumn("_first", first).withColumn("_picked", F.row_number().over(statement) <= F.col("_quota"))
    total = sum(quotas.values())
    company = W.partitionBy("ticker").orderBy(F.desc("_picked"), "_draw")
    return rows.filter(F.col("ticker").isNotNull()).withColumn("_n", F.row_number().over(company)).filter(F.col("_picked") | (F.col("_n") <= total)).drop("_draw", "_quota", "_in", "_first", "_picked", "_n")


def one_per_company(pool: DataFrame, id_: str, companies: int = COMPANIES, seed: int = 0) -> DataFrame:
    """One drawn row of each of at most `companies` drawn tickers, about the filing's own period where there is one."""
    now = F.col("period_end") == F.col("reporting_period_end")
    rows = pool.withColumn("relation", F.when(now, "current").otherwise("prior"))
    best = rows.withColumn("_n", F.row_number().over(W.partitionBy("ticker").orderBy(F.desc(F.coalesce(now, F.lit(False))), _draw(id_, seed)))).filter("_n = 1").drop("_n")
    chosen = best.select("ticker", _draw("ticker", seed).alias("_d")).orderBy("_d", "ticker").limit(companies)
    return best.join(F.broadcast(chosen.select("ticker")), "ticker", "left_semi")  # at most `companies` rows


def items(drawn: DataFrame, id_: str, set_name: str, known: dict[str, str] | None = None) -> DataFrame:
    """Gold items of drawn rows: qid (by ticker and id), question, answer_unit, value, display, least digits, fact and strata."""
    unit = answer_unit(F.col("metric_key"), F.col("value"), F.col("display_text"))
    scaled = F.col("value").cast("double") / unit["divisor"]
    shown = F.when(F.abs(scaled) >= 1000, F.format_number(scaled, 0)).otherwise(F.format_number(scaled, 1))
    eps = F.col("metric_key") == "eps_diluted"
    word = F.when(unit["divisor"] == 1e3, " thousand").otherwise(" million")
    display = F.when(eps, F.concat(F.lit("USD "), F.format_number(F.col("value").cast("double"), 2), F.lit(" per share"))).otherwise(F.concat(F.lit("USD "), shown, word))
    digits = printed_digits(F.col("display_text"))
    whole = F.char_length(F.bround(F.abs(scaled)).cast("long").cast("string")).cast("long")
    differs = ~eps & ~F.coalesce(printed_scale(F.col("value"), F.col("display_text")) == unit["divisor"], F.lit(False))
    least = F.greatest(F.lit(1), F.when(differs, F.least(F.coalesce(digits, F.lit(3)), whole)).otherwise(F.coalesce(digits, F.lit(3)))).cast("long")
    number = F.row_number().over(W.orderBy("ticker", id_))  # a drawn set has at most some thousand rows
    fact = F.struct("cik", F.col("accession_number").alias("accession"), F.concat(F.lit("us-gaap:"), F.coalesce(F.get("concept_names", 0), F.lit("?"))).alias("concept"), "period_start", "period_end", F.when(eps, "USD/shares").otherwise("USD").alias("unit"), "ticker")
    out = with_question(drawn, known).withColumn("qid", F.concat(F.lit(f"OBJ-{set_name}-"), F.lpad(number.cast("string"), 3, "0")))
    return out.select("qid", id_, "ticker", "question", "answer_unit", "value", display.alias("display"), least.alias("min_sig_figs"), fact.alias("fact"), "metric_key", F.struct(F.lit(set_name).alias("set"), F.col("statement_type").alias("statement"), "relation").alias("strata"))


def manifest(found: DataFrame) -> DataFrame:
    """(by, value, n): the items counted by answer unit, company, statement, relation and metric, in one pass."""
    groups = {"answer_unit": F.col("answer_unit"), "company": F.col("ticker"), "statement": F.col("strata.statement"), "relation": F.col("strata.relation"), "metric": F.col("metric_key")}
    pairs = F.array(*[F.struct(F.lit(k).alias("by"), v.alias("value")) for k, v in groups.items()])
    return found.select(F.explode(pairs).alias("p")).groupBy("p.by", "p.value").agg(F.count(F.lit(1)).alias("n"))
