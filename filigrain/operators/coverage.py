"""Coverage pre-check: names to companies, dates and periods to filings, requests to targets."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from filigrain.functions.text import normal_name

DAYS, RATIO, LEAST = 7, 0.84, 5
#: Requests and filings that meet in one task.
TASK_ROWS = 1 << 17


def _parts(requests: DataFrame, filings: DataFrame) -> int:
    """Over how many partitions both are dealt, so that a task's share does not grow with them."""
    return max(-(-(requests.count() + filings.count()) // TASK_ROWS), requests.sparkSession.sparkContext.defaultParallelism)


def last_year_end(year_end: Column, period_end: Column) -> Column:
    """year_end, stepped back year by year until it is not after period_end; a 29 February steps to the 28th and
    stays there."""
    day = F.when((F.month(year_end) == 2) & (F.day(year_end) == 29), F.date_sub(year_end, 1)).otherwise(year_end)
    years = F.greatest(F.year(year_end) - F.year(period_end), F.lit(0))
    first = F.when(years == 0, year_end).otherwise(F.add_months(day, years * -12))
    return F.when(first <= period_end, first).otherwise(F.add_months(day, (years + 1) * -12))


def covered_dates(filings: DataFrame, key: str, period_end: str, form: str) -> DataFrame:
    """filings with _dates: the period end, the same day a year earlier and, for a 10-Q of a key with a 10-K, the
    last fiscal year end not after it."""
    own = filings.filter(F.col(form) == "10-K").groupBy(key).agg(F.max(period_end).alias("_fy"))
    end = F.col(period_end)
    third = F.when(F.col(form) == "10-Q", last_year_end(F.col("_fy"), end))
    dates = F.array_compact(F.array(end, F.add_months(end, -12), third))
    return filings.join(own, key, "left").withColumn("_dates", dates).drop("_fy")


def date_hits(requests: DataFrame, filings: DataFrame, key: str, date: str, period_end: str, days: int = DAYS, form: str | None = None) -> DataFrame:
    """Requests joined to the filings of their key whose period end, or the same day a year earlier, lies within
    `days`: dates are bucketed by days + 1 and each side meets its own and the next buckets by an equi join.

    With `form`, the column of filings' forms, a 10-Q also covers the last fiscal year end before it; a filing that
    covers a date in two ways gives a row for each."""
    width = 2 * days + 1
    if form:
        ends = covered_dates(filings, key, period_end, form).withColumn("_d", F.explode("_dates")).drop("_dates")
    else:
        ends = filings.withColumn("_d", F.explode(F.array(F.col(period_end), F.add_months(period_end, -12))))
    ends = ends.withColumn("_prior", F.col("_d") != F.col(period_end))
    ends = ends.withColumn("_b", F.floor(F.unix_date("_d") / width))
    asked = requests.withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.unix_date(date) / width) + i)))
    return asked.join(ends, [key, "_b"]).filter(F.abs(F.datediff(date, "_d")) <= days).drop("_b", "_d")


def osa(a: str, b: str) -> int:
    """Edit distance with adjacent swaps (each stretch edited once); 99 when lengths differ by more than two."""
    if abs(len(a) - len(b)) > 2:
        return 99
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
    return one[-1]


def similarity(a: str, b: str) -> float:
    """difflib's ratio of the matching stretches; 0 where the letters in common cannot reach RATIO."""
    m = SequenceMatcher(None, a, b)
    return m.ratio() if m.quick_ratio() >= RATIO else 0.0


def resolve(names: DataFrame, aliases: DataFrame, most_aliases: int = 200_000) -> DataFrame:
    """(name, ticker, match) for names(name) against aliases(alias, ticker): the ticker itself, then the normal form,
    then the alias with the highest SequenceMatcher ratio of RATIO or more, then the closest alias within the edit
    limits (1 up to 7 letters, else 2); first alias on ties. Names and aliases of LEAST letters meet in the last two.

    A ratio is twice the letters matched by the letters of both, so an alias that reaches it has a length of
    RATIO / (2 - RATIO) to (2 - RATIO) / RATIO times the name's, and enough letters in common (quick_ratio). Two
    edits fall outside that for short names only, so lengths within two letters are met as well."""
    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([osa(x, y) for x, y in zip(a, b)], dtype="int32")

    n = names.select("name").distinct().withColumn("_n", normal_name(F.col("name")))
    a = aliases.select("alias", "ticker").withColumn("_n", normal_name(F.col("alias")))
    t = aliases.select(F.upper("ticker").alias("_t"), "ticker").distinct()
    exact = n.join(t, F.upper("name") == F.col("_t")).select("name", "ticker", F.lit(0).alias("tier"), F.lit(0.0).alias("d"), F.lit("").alias("alias"))
    same = n.join(a, "_n").select("name", "ticker", F.lit(1).alias("tier"), F.lit(0.0).alias("d"), "alias")
    size = F.length("_n")
    low, high = F.least(size - 2, F.floor(size * (RATIO / (2 - RATIO)))), F.greatest(size + 2, F.ceil(size * ((2 - RATIO) / RATIO)))
    long = n.filter(size >= LEAST).withColumn("_l", F.explode(F.sequence(low.cast("int"), high.cast("int"))))
    met = long.join(a.withColumnRenamed("_n", "_m").withColumn("_l", F.length("_m")).filter(F.col("_l") >= LEAST), "_l")
    met = met.withColumn("_r", ratio("_n", "_m")).withColumn("_e", distance("_n", "_m"))
    alike = F.col("_r") >= RATIO
    met = met.filter(alike | (F.col("_e") <= F.when(size <= 7, 1).otherwise(2)))
    near = met.select("name", "ticker", F.when(alike, 2).otherwise(3).alias("tier"), F.when(alike, -F.col("_r")).otherwise(F.col("_e").cast("double")).alias("d"), "alias")
    best = W.partitionBy("name").orderBy("tier", "d", "alias", "ticker")
    found = exact.union(same).union(near).withColumn("_i", F.row_number().over(best)).filter("_i = 1")
    kind = F.element_at(F.array(F.lit("ticker"), F.lit("alias"), F.lit("fuzzy"), F.lit("fuzzy")), F.col("tier") + 1)
    return names.join(found.select("name", "ticker", kind.alias("match")), "name", "left")


def plan(requests: DataFrame, filings: DataFrame) -> DataFrame:
    """The product of tickers and years, by equality only; check has the whole rules. Targets of requests(qid, tickers, years) with hit or miss and the status of each request: every ticker with
    every year. Status: no_target, all_hit, none, partial."""
    targets = requests.select("qid", F.explode_outer("tickers").alias("ticker"), "years").select("qid", "ticker", F.explode_outer("years").alias("year"))
    have = filings.select("ticker", "year").distinct().withColumn("_hit", F.lit(1))
    hit = F.coalesce("_hit", F.lit(0))
    per = targets.join(have, ["ticker", "year"], "left").groupBy("qid").agg(F.count("ticker").alias("targets"), F.sum(hit).alias("hits"))
    status = F.when(F.col("targets") == 0, "no_target").when(F.col("hits") == F.col("targets"), "all_hit").when(F.col("hits") == 0, "none").otherwise("partial")
    return per.select("qid", "targets", "hits", status.alias("status"))


def targets(requests: DataFrame, filings: DataFrame, combine: str = "product", parts: int | None = None) -> DataFrame:
    """qid, ticker, form, fiscal_year, fiscal_period, period_end, status (hit or miss) and the accessions that hit,
    for requests(qid, tickers, forms, fiscal_years, fiscal_periods, period_ends: arrays, null or empty for any)
    against filings(ticker, form, accession, period_end, fiscal_year, fiscal_period).

    product: every ticker with every form, year, period and date. independent: every ticker with each date, each
    pair of year and period, and each form on its own; with the ticker alone where nothing else is asked.
    A filing of the next fiscal year covers a year, if it has the period asked for (or none is); an FY filing covers
    Q4 of its year; dates as in covered_dates, within DAYS.

    Tickers and targets are dealt over `parts` partitions, as many as the rows of both ask for: bytes do not tell how
    many targets a request gives."""
    if combine not in ("product", "independent"):
        raise ValueError("combine must be 'product' or 'independent'")
    parts = parts or _parts(requests, filings)
    kinds = {"form": "string", "fiscal_year": "int", "fiscal_period": "string", "period_end": "date"}
    r = requests.select("qid", F.array_distinct("tickers").alias("tickers"), *[F.col(f"{c}s").cast(f"array<{k}>").alias(c) for c, k in kinds.items()])
    r = r.withColumns({"form": F.transform("form", lambda v: F.regexp_replace(F.upper(v), "10([KQ])", "10-$1")), "fiscal_period": F.transform("fiscal_period", lambda v: F.upper(v))})

    def some(c: str, want: bool):
        """The values asked for; a single null where there are none or the part is left out."""
        none = F.array(F.lit(None).cast(kinds[c]))
        return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.col(c)).otherwise(none) if want else none

    def expand(parts: set[str]) -> DataFrame:
        out = r.select("qid", F.explode("tickers").alias("ticker"), *[some(c, c in parts).alias(c) for c in kinds])
        for c in kinds:
            out = out.withColumn(c, F.explode(c))
        return out

    if combine == "product":
        plan_ = expand(set(kinds))
    else:
        apart = [expand({"period_end"}), expand({"fiscal_year", "fiscal_period"}), expand({"form"})]
        asked = [p.filter(F.coalesce(*[F.col(c).cast("string") for c in kinds]).isNotNull()) for p in apart]
        empty = r.filter(F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in kinds]) <= 0)
        alone = empty.select("qid", F.explode("tickers").alias("ticker"), *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
        plan_ = asked[0].union(asked[1]).union(asked[2]).union(alone)
    f = covered_dates(filings.repartition(parts, "ticker"), "ticker", "period_end", "form").select("ticker", "accession", *[F.col(c).alias(f"_{c}") for c in kinds], "_dates")
    year, period, day = F.col("fiscal_year"), F.col("fiscal_period"), F.col("period_end")
    own = F.col("_fiscal_period")
    fits_form = F.col("form").isNull() | (F.upper("_form") == F.col("form"))
    next_year = (F.col("_fiscal_year") == year + 1) & (period.isNull() | (own == period))
    fits_year = year.isNull() | (F.col("_fiscal_year") == year) | next_year
    fits_period = period.isNull() | (own == period) | ((period == "Q4") & (own == "FY"))
    fits_date = day.isNull() | (F.col("_period_end").isNotNull() & F.exists("_dates", lambda d: F.abs(F.datediff(d, day)) <= DAYS))
    distinct = plan_.drop("qid").repartition(parts, "ticker").distinct()
    hit = distinct.join(f, "ticker").filter(fits_form & fits_year & fits_period & fits_date)
    hit = hit.groupBy("ticker", *kinds).agg(F.array_sort(F.collect_set("accession")).alias("accessions"))
    target = F.struct("ticker", *kinds)  # nulls in a struct are equal
    p, h = (df.withColumn("_target", target).repartition(parts, "_target") for df in (plan_, hit))
    status = F.when(F.col("accessions").isNull(), "miss").otherwise("hit")
    j = p.join(h.select("_target", "accessions"), "_target", "left")
    return j.select(*plan_.columns, status.alias("status"), F.coalesce("accessions", F.array().cast("array<string>")).alias("accessions"))


def check(requests: DataFrame, filings: DataFrame, combine: str = "product") -> DataFrame:
    """qid, targets, hits, status and the accessions that hit, per request. requests as in targets, with unresolved,
    an array of names that are no company, where there may be such. Status: no_target, unresolved, all_hit, none,
    partial."""
    unresolved = F.coalesce(F.size("unresolved"), F.lit(0)) if "unresolved" in requests.columns else F.lit(0)
    parts = _parts(requests, filings)
    per = targets(requests, filings, combine, parts).repartition(parts, "qid").groupBy("qid").agg(F.count(F.lit(1)).alias("targets"), F.count_if(F.col("status") == "hit").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("accessions")))).alias("accessions"))
    j = requests.select("qid", F.greatest(unresolved, F.lit(0)).alias("_u")).join(per, "qid", "left")
    n, hits = F.coalesce("targets", F.lit(0)), F.coalesce("hits", F.lit(0))
    status = F.when((n == 0) & (F.col("_u") == 0), "no_target").when(n == 0, "unresolved").when((hits == n) & (F.col("_u") == 0), "all_hit").when(hits == 0, "none").otherwise("partial")
    return j.select("qid", n.alias("targets"), hits.alias("hits"), status.alias("status"), F.coalesce("accessions", F.array().cast("array<string>")).alias("accessions"))


def alias_table(filings: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(alias, ticker) of filings(ticker, company): tickers, normal company names and those without apostrophes, and
    extra(alias, ticker). An alias of several tickers goes to extra names first, then to the last ticker."""
    named = F.transform(F.array(normal_name(F.col("company")), F.replace(normal_name(F.col("company")), F.lit("'"), F.lit(""))), lambda n: F.struct(n.alias("alias"), F.lit(1).alias("tier")))
    own = filings.select("ticker", F.explode(F.concat(named, F.array(F.struct(F.lower("ticker").alias("alias"), F.lit(0).alias("tier"))))).alias("a")).select("a.alias", "ticker", "a.tier")
    if extra is not None:
        own = own.unionByName(extra.select(normal_name(F.col("alias")).alias("alias"), "ticker", F.lit(2).alias("tier")))
    kept = own.filter(F.coalesce("alias", F.lit("")) != "").groupBy("alias").agg(F.max_by("ticker", F.struct("ticker", "tier")).alias("ticker"))
    return kept


def filing_label(form: Column, year: Column, period: Column, period_end: Column) -> Column:
    """How a filing is named in messages: form, fiscal year and period, period end; what is null is left out."""
    fiscal = F.when(year.isNotNull(), F.concat_ws(" ", F.concat(F.lit("FY"), year.cast("string")), period))
    return F.concat(F.concat_ws(" ", form, fiscal), F.coalesce(F.concat(F.lit(", period ended "), period_end.cast("string")), F.lit("")))


def available(filings: DataFrame) -> DataFrame:
    """(ticker, available): the labels of each company's filings, by period end and form."""
    label = filing_label(F.col("form"), F.col("fiscal_year"), F.col("fiscal_period"), F.col("period_end"))
    rows = filings.groupBy("ticker").agg(F.array_sort(F.collect_set(F.struct(F.coalesce("period_end", F.lit("0001-01-01").cast("date")).alias("e"), "form", label.alias("l")))).alias("a"))
    return rows.select("ticker", F.transform("a", lambda x: x["l"]).alias("available"))


def messages(requests: DataFrame, filings: DataFrame, combine: str = "product") -> DataFrame:
    """(qid, status, message): what a pre-check says of each request. Unresolved names first, then what no filing covers,
    then what there is of the companies concerned."""
    found = targets(requests, filings, combine)
    asked = F.concat_ws(" ", "ticker", "form", F.concat(F.lit("FY"), F.col("fiscal_year").cast("string")), "fiscal_period", F.concat(F.lit("period ended "), F.col("period_end").cast("string")))
    missing = found.filter("status = 'miss'").join(available(filings), "ticker", "left")
    have = F.concat(F.lit("For "), F.col("ticker"), F.lit(" we have: "), F.array_join(F.coalesce("available", F.array().cast("array<string>")), "; "), F.lit("."))
    per = missing.groupBy("qid").agg(F.array_sort(F.collect_set(asked)).alias("_m"), F.array_sort(F.collect_set(have)).alias("_h"))
    names = F.coalesce(F.col("unresolved"), F.array().cast("array<string>")) if "unresolved" in requests.columns else F.array().cast("array<string>")
    j = check(requests, filings, combine).join(requests.select("qid", names.alias("_u")), "qid").join(per, "qid", "left")
    unknown = F.when(F.size("_u") > 0, F.concat(F.lit("Not in our database: "), F.array_join("_u", ", "), F.lit(".")))
    lost = F.when(F.size("_m") > 0, F.concat(F.lit("No filing in our database covers: "), F.array_join("_m", "; "), F.lit(".")))
    told = F.concat_ws(" ", unknown, lost, F.array_join("_h", " "))
    text = F.when(F.col("status") == "no_target", "The question names no company, so there is nothing to pre-check.").when(F.col("status") == "all_hit", "All requested filings are in the database.").otherwise(F.trim(told))
    return j.select("qid", "status", text.alias("message"))


def typo(name: Column, seed: int) -> Column:
    """The name with one edit drawn by a hash of name and seed: a letter dropped, doubled or swapped with the next."""
    n = F.char_length(name)
    h = F.pmod(F.xxhash64(name, F.lit(seed)), F.lit(1 << 31)).cast("int")
    at = (F.pmod(h, F.greatest(n - 1, F.lit(1))) + 1).cast("int")
    head, one, two, rest = F.substring(name, F.lit(1), at - 1), F.substring(name, at, F.lit(1)), F.substring(name, at + 1, F.lit(1)), F.substring(name, at + 2, F.lit(1 << 20))
    kinds = F.array(F.concat(head, two, rest), F.concat(head, one, one, two, rest), F.concat(head, two, one, rest))
    return F.when(n < 2, name).otherwise(F.get(kinds, F.pmod(F.shiftright(h, 8), F.lit(3)).cast("int")))


def replay(requests: DataFrame, filings: DataFrame, combine: str = "product") -> DataFrame:
    """(status, n) of a batch of requests."""
    return check(requests, filings, combine).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
