"""Queries of tables in text, question sets and reports over the driver's tables, with their DuckDB SQL. Registered in
catalogue.QUERIES and catalogue.SQL on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filigrain.operators import coverage, evaluate, expand, fusion, objective, pipes, reports, variants
from filigrain.plans.catalogue import query
from filigrain.sources import tables

# ---- tables in plain text ----

#: Order lines as text: closed rows, open rows, short and long lines.
_LINES = """
ln AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE l_linenumber % 4 WHEN 0 THEN 'Part ' || l_partkey || ' | | $ | ' || l_quantity::INT || ' | | (3 | ) | 5 | % |'
  WHEN 1 THEN 'Open ' || l_partkey || ' | x | y' WHEN 2 THEN 'tail ' || l_suppkey ELSE repeat('word ', 20) || l_partkey END AS t FROM lineitem)"""


def _lines(t) -> DataFrame:
    n, part = F.col("l_linenumber") % 4, F.col("l_partkey").cast("string")
    row = F.concat(F.lit("Part "), part, F.lit(" | | $ | "), F.col("l_quantity").cast("int").cast("string"), F.lit(" | | (3 | ) | 5 | % |"))
    text = F.when(n == 0, row).when(n == 1, F.concat(F.lit("Open "), part, F.lit(" | x | y"))).when(n == 2, F.concat(F.lit("tail "), F.col("l_suppkey").cast("string"))).otherwise(F.concat(F.repeat(F.lit("word "), F.lit(20)), part))
    return t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), text.alias("t"))


#: Lines whose orders one task joins and cuts again.
_TASK_LINES = 1 << 18


def _sections(t) -> DataFrame:
    lines = _lines(t)
    parts = max(-(-lines.count() // _TASK_LINES), lines.sparkSession.sparkContext.defaultParallelism)
    return lines.repartition(parts, "k").groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]), "\n").alias("text"))


@query("logical_rows", f"""WITH {_LINES}, a AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY n, t) - 1 AS pos, trim(t) AS t FROM ln),
b AS (SELECT *, length(t) - length(replace(t, '|', '')) AS bars, NOT contains(t, '|') AND length(t) > 80 AS prose FROM a),
c AS (SELECT *, coalesce(sum((ends_with(t, '|') OR prose)::INT) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM b),
d AS (SELECT *, min(CASE WHEN bars >= 2 THEN pos END) OVER (PARTITION BY k, seg) AS first FROM c),
e AS (SELECT *, pos >= coalesce(first, 1000000) AND NOT prose AS r FROM d)
SELECT k, (CASE WHEN r THEN first ELSE pos END)::BIGINT AS item, CASE WHEN r THEN 'row' ELSE 'text' END AS kind, string_agg(t, ' ' ORDER BY pos) AS text FROM e GROUP BY ALL""")
def logical_rows(t):
    return pipes.items(_sections(t), "k").select("k", F.col("item").cast("long").alias("item"), "kind", "text")


@query("merged_cells", f"WITH {_LINES} SELECT k, n, CASE n % 4 WHEN 0 THEN regexp_extract(t, '^Part [0-9]+') || ';$' || regexp_extract(t, '\\$ \\| ([0-9]+)', 1) || ';(3);5%' WHEN 1 THEN regexp_extract(t, '^Open [0-9]+') || ';x;y' ELSE trim(t) END AS cells FROM ln")
def merged_cells(t):
    return _lines(t).select("k", "n", F.array_join(pipes.cells(F.col("t")), ";").alias("cells"))


@query("split_rows", f"""WITH {_LINES} SELECT k, n, CASE n % 4 WHEN 0 THEN regexp_extract(t, '^Part [0-9]+') WHEN 1 THEN regexp_extract(t, '^Open [0-9]+') ELSE trim(t) END AS label,
CASE n % 4 WHEN 0 THEN '$' || regexp_extract(t, '\\$ \\| ([0-9]+)', 1) || ';(3);5%' WHEN 1 THEN 'x;y' ELSE '' END AS vals, '' AS unit FROM ln""")
def split_rows(t):
    return _lines(t).select("k", "n", pipes.split_row(pipes.cells(F.col("t"))).alias("s")).select("k", "n", "s.label", F.array_join("s.values", ";").alias("vals"), "s.unit")


@query("table_blocks", f"""WITH {_LINES} SELECT k, count(*)::BIGINT AS n_rows, count(*) FILTER (n % 4 = 0)::BIGINT AS n_numbered FROM ln WHERE n % 4 = 0 GROUP BY k""")
def table_blocks(t):
    """Only the closed rows of each order: one table an order, whose rows keep their values."""
    text = _lines(t).filter("n % 4 = 0").groupBy("k").agg(F.array_join(F.collect_list("t"), "\n").alias("text"))
    found = pipes.tables(pipes.items(text, "k"), "k")
    return found.select("k", F.size("rows").cast("long").alias("n_rows"), F.size(F.filter("rows", lambda r: (F.size(r["values"]) == 3) & F.startswith(F.get(r["values"], 0), F.lit("$")))).cast("long").alias("n_numbered"))


# ---- question sets ----

_METRIC = "CASE o_orderpriority WHEN '1-URGENT' THEN 'revenue' WHEN '2-HIGH' THEN 'eps_diluted' WHEN '3-MEDIUM' THEN 'total_assets' ELSE 'unknown' END"
_STATEMENT = "CASE o_orderpriority WHEN '3-MEDIUM' THEN 'balance_sheet' ELSE 'income_statement' END"
_ROWS = f"""
m AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 50 = 0 THEN '' ELSE 'C' || (o_custkey % 300) END AS ticker, {_METRIC} AS metric_key, {_STATEMENT} AS statement_type,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'instant' ELSE 'duration' END AS period_kind, date_trunc('year', o_orderdate)::DATE::VARCHAR AS period_start,
  (date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE::VARCHAR AS period_end, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE::VARCHAR ELSE (date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE::VARCHAR END AS reporting_period_end,
  o_orderdate::DATE::VARCHAR AS filing_date, CASE WHEN o_orderkey % 11 = 0 THEN 500 ELSE 365 END AS duration_days, CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE round(o_totalprice) * 1000 END AS value,
  CASE o_orderstatus WHEN 'P' THEN 'conflict' ELSE 'reported' END AS status, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'cell' END AS cell_key FROM orders),
j AS (SELECT *, CASE WHEN ticker = '' THEN 'no_ticker' WHEN status = 'conflict' THEN '4_conflict_or_review' WHEN value = 0 THEN '1_zero_or_nil' WHEN cell_key IS NULL THEN '2_no_linked_cell'
  WHEN metric_key = 'unknown' OR (period_kind = 'duration' AND duration_days = 500) THEN 'unsupported_metric_or_period' WHEN metric_key = 'revenue' AND id % 5 = 0 THEN '5_used_by_dev_or_holdout' END AS why FROM m),
p AS (SELECT *, row_number() OVER (PARTITION BY ticker, metric_key, period_start, period_end, CASE WHEN why IS NOT NULL THEN id END ORDER BY (period_end = reporting_period_end)::INT DESC, filing_date DESC, id) AS place FROM j),
x AS (SELECT *, coalesce(why, CASE WHEN place > 1 THEN '3_duplicate_period' END) AS reason FROM p)"""


def _metric_rows(t) -> DataFrame:
    day, key, priority = F.to_date("o_orderdate"), F.col("o_orderkey"), F.col("o_orderpriority")
    first = F.trunc("o_orderdate", "year")
    last = F.date_sub(F.add_months(first, 12), 1)
    rows = t("orders").select(
        key.alias("id"), F.when(F.col("o_custkey") % 50 == 0, "").otherwise(F.concat(F.lit("C"), (F.col("o_custkey") % 300).cast("string"))).alias("ticker"),
        F.when(priority == "1-URGENT", "revenue").when(priority == "2-HIGH", "eps_diluted").when(priority == "3-MEDIUM", "total_assets").otherwise("unknown").alias("metric_key"),
        F.when(priority == "3-MEDIUM", "balance_sheet").otherwise("income_statement").alias("statement_type"), F.when(priority == "3-MEDIUM", "instant").otherwise("duration").alias("period_kind"),
        first.cast("string").alias("period_start"), last.cast("string").alias("period_end"), F.when(key % 3 == 0, day).otherwise(last).cast("string").alias("reporting_period_end"), day.cast("string").alias("filing_date"),
        F.when(key % 11 == 0, 500).otherwise(365).alias("duration_days"), F.when(key % 13 == 0, 0.0).otherwise(F.round("o_totalprice") * 1000).alias("value"),
        F.when(F.col("o_orderstatus") == "P", "conflict").otherwise("reported").alias("status"), F.when(key % 17 == 0, None).otherwise("cell").alias("cell_key"),
        F.lit(None).cast("string").alias("company_name"), F.format_number(F.round("o_totalprice"), 0).alias("display_text"), F.concat(F.lit("us-gaap:"), key.cast("string")).alias("concept"),
    )
    rows = rows.withColumn("concept_names", F.array(F.element_at(F.split("concept", ":"), -1)))
    gold = rows.filter("metric_key = 'revenue' AND id % 5 = 0").select(F.array(F.struct("ticker", "concept", "period_end")).alias("facts"))
    return objective.judged(objective.marked_used(rows, objective.used_keys(gold), "id"), "id")


@query("population_exclusions", f"WITH {_ROWS} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM x GROUP BY 1")
def population_exclusions(t):
    return objective.exclusions(_metric_rows(t))


@query("population_rows", f"WITH {_ROWS} SELECT id, ticker, metric_key FROM x WHERE reason IS NULL")
def population_rows(t):
    return _metric_rows(t).filter("reason IS NULL").select("id", "ticker", "metric_key")


@query("question_texts", f"""WITH {_ROWS} SELECT id, 'What was ' || ticker || '''s ' || CASE metric_key WHEN 'revenue' THEN 'total revenue' WHEN 'eps_diluted' THEN 'diluted earnings per share' ELSE 'total assets' END || ' ' ||
CASE WHEN period_kind = 'instant' THEN 'as of ' ELSE 'for the fiscal year ended ' END || strftime(period_end::DATE, '%B %-d, %Y') || '? Answer in ' || CASE WHEN metric_key = 'eps_diluted' THEN 'USD per share' ELSE 'USD thousands' END || '.' AS question FROM x WHERE reason IS NULL""")
def question_texts(t):
    return objective.with_question(_metric_rows(t).filter("reason IS NULL")).select("id", "question")


@query("drawn_by_company", f"""WITH {_ROWS}, a AS (SELECT id, ticker, statement_type AS s, CASE WHEN period_end = reporting_period_end THEN 'current' ELSE 'prior' END AS relation, md5('7|' || id) AS d, CASE statement_type WHEN 'income_statement' THEN 6 ELSE 5 END AS quota FROM x WHERE reason IS NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY ticker, s, relation ORDER BY d) AS i FROM a),
c AS (SELECT *, i <= CASE relation WHEN 'current' THEN round_even(quota * 2 / 3.0, 0) ELSE quota - round_even(quota * 2 / 3.0, 0) END AS f FROM b),
e AS (SELECT *, row_number() OVER (PARTITION BY ticker, s ORDER BY f DESC, relation, d) <= quota AS picked FROM c),
g AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY picked DESC, d) AS n FROM e) SELECT id, relation FROM g WHERE picked OR n <= 15""")
def drawn_by_company(t):
    return objective.drawn_by_company(_metric_rows(t).filter("reason IS NULL"), "id", seed=7).select("id", "relation")


@query("one_per_company", f"""WITH {_ROWS}, a AS (SELECT id, ticker, row_number() OVER (PARTITION BY ticker ORDER BY (period_end = reporting_period_end) DESC, md5('7|' || id)) AS n FROM x WHERE reason IS NULL)
SELECT id, ticker FROM a WHERE n = 1 ORDER BY md5('7|' || ticker), ticker LIMIT 100""")
def one_per_company(t):
    return objective.one_per_company(_metric_rows(t).filter("reason IS NULL"), "id", seed=7).select("id", "ticker")


@query("question_manifest", f"""WITH {_ROWS}, a AS (SELECT id, ticker, metric_key, statement_type, (period_end = reporting_period_end) AS own, row_number() OVER (PARTITION BY ticker ORDER BY (period_end = reporting_period_end) DESC, md5('7|' || id)) AS n FROM x WHERE reason IS NULL),
b AS (SELECT * FROM a WHERE n = 1 ORDER BY md5('7|' || ticker), ticker LIMIT 100),
c AS (SELECT unnest([{{'by': 'answer_unit', 'value': CASE WHEN metric_key = 'eps_diluted' THEN 'USD per share' ELSE 'USD thousands' END}}, {{'by': 'company', 'value': ticker}}, {{'by': 'statement', 'value': statement_type}}, {{'by': 'relation', 'value': CASE WHEN own THEN 'current' ELSE 'prior' END}}, {{'by': 'metric', 'value': metric_key}}]) AS p FROM b)
SELECT p.by AS by, p.value AS value, count(*) AS n FROM c GROUP BY ALL""")
def question_manifest(t):
    drawn = objective.one_per_company(_metric_rows(t).filter("reason IS NULL"), "id", seed=7)
    return objective.manifest(objective.items(drawn.withColumns({"cik": F.lit(1), "accession_number": F.lit("a")}), "id", "C"))


@query("printed_scales", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1e3 WHEN 2 THEN 1e6 END::DOUBLE AS scale, length(rtrim(ltrim(trunc(o_totalprice)::BIGINT::VARCHAR, '0'), '0')) AS digits FROM orders""")
def printed_scales(t):
    whole = F.floor("o_totalprice")
    shown = F.concat(F.lit("($"), F.format_number(whole, 0), F.lit(")"))
    times = F.element_at(F.array(*[F.lit(x) for x in (1.0, 1e3, 1e6, 77.0)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t("orders").select("o_orderkey", objective.printed_scale(whole * times, shown).alias("scale"), objective.printed_digits(shown).alias("digits"))


@query("stratified_hash_sample", "SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey) AS rn FROM orders) WHERE rn <= 15")
def stratified_hash_sample(t):
    return objective.hash_sample(t("orders"), "o_orderpriority", "o_orderkey", 15, 42).select("o_orderkey", "o_orderpriority")


# ---- reports ----

_TOP = "tp AS (SELECT o_custkey % 200 AS qid, o_orderkey, o_orderpriority AS text, (o_custkey % 5)::VARCHAR AS accession, row_number() OVER (PARTITION BY o_custkey % 200 ORDER BY o_orderkey) AS rank FROM orders)"


def _results(t) -> DataFrame:
    rows = t("orders").select((F.col("o_custkey") % 200).alias("qid"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("text"), (F.col("o_custkey") % 5).cast("string").alias("accession"), F.lit(None).cast("string").alias("ticker"), F.lit(None).cast("string").alias("form"))
    return reports.latest(rows, "qid", [F.col("id")], 1 << 30).withColumnRenamed("rn", "rank")


@query("figures_found", f"""WITH {_TOP}, q AS (SELECT DISTINCT qid FROM tp), b AS (SELECT qid, coalesce(string_agg(lower(text), ' ' ORDER BY rank) FILTER (rank <= 3), '') AS l3, coalesce(string_agg(lower(text), ' ' ORDER BY rank) FILTER (rank <= 3 AND accession = (qid % 5)::VARCHAR), '') AS s3 FROM tp GROUP BY qid)
SELECT qid, (contains(l3, '1-urgent') OR contains(l3, '2-high')) AND contains(l3, '5-low') AS loose_3, (contains(s3, '1-urgent') OR contains(s3, '2-high')) AND contains(s3, '5-low') AS strict_3 FROM b""")
def figures_found(t):
    results = _results(t)
    q = results.select("qid").distinct()
    figures = q.select("qid", F.posexplode(F.array(F.array(F.lit("1-URGENT"), F.lit("2-High")), F.array(F.lit("5-LOW")))).alias("figure", "spellings"))
    return reports.figures_found(figures, results, q.select("qid", (F.col("qid") % 5).cast("string").alias("accession")), (3,))


@query("anchors_found", f"""WITH {_TOP}, b AS (SELECT qid, coalesce(bool_or(contains(lower(text), '-high')) FILTER (rank <= 5), false) AS a, coalesce(string_agg(lower(text), ' ') FILTER (rank <= 5), '') AS s FROM tp WHERE accession = (qid % 5)::VARCHAR GROUP BY qid), q AS (SELECT DISTINCT qid FROM tp)
SELECT q.qid, i.item, CASE i.item WHEN 0 THEN coalesce(a, false) ELSE coalesce(contains(s, 'urgent') AND contains(s, 'medium'), false) END AS found_5 FROM q CROSS JOIN (SELECT unnest([0, 1]) AS item) i LEFT JOIN b USING (qid)""")
def anchors_found(t):
    results = _results(t)
    q = results.select("qid").distinct().withColumn("accession", (F.col("qid") % 5).cast("string"))
    none = F.lit(None).cast("string")
    one = q.select("qid", F.lit(0).alias("item"), "accession", F.array(F.lit("-High")).alias("contains"), none.alias("anchor_source"))
    two = q.select("qid", F.lit(1).alias("item"), "accession", F.array(F.lit("urgent"), F.lit("medium")).alias("contains"), F.lit(reports.SPREAD_SOURCES[0]).alias("anchor_source"))
    anchors = one.union(two).withColumns({"ticker": none, "form": none})
    return reports.anchors_found(anchors, results, (5,))


@query("null_aware_rates", "SELECT lang, round(avg(quality::DOUBLE), 3) AS quality, count(quality) AS n_quality, round(avg(toxic::DOUBLE), 3) AS toxic, count(toxic) AS n_toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def null_aware_rates(t):
    return reports.rates(t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left"), ["lang"], ["quality", "toxic"])


_RUNS = "rn AS (SELECT o_custkey AS qid, o_orderpriority AS run, avg(o_totalprice) AS m FROM orders GROUP BY ALL)"


def _runs(t) -> DataFrame:
    return t("orders").groupBy(F.col("o_custkey").alias("qid"), F.col("o_orderpriority").alias("run")).agg(F.avg("o_totalprice").alias("m"))


@query("run_gains_losses", f"""WITH {_RUNS} SELECT a.run, string_agg(a.qid::VARCHAR, ',' ORDER BY a.qid) FILTER (a.m > b.m) AS gained, string_agg(a.qid::VARCHAR, ',' ORDER BY a.qid) FILTER (a.m < b.m) AS lost, count(*) FILTER (a.m > b.m) AS n_gained, count(*) FILTER (a.m < b.m) AS n_lost
FROM rn a JOIN rn b ON a.qid = b.qid AND b.run = '1-URGENT' WHERE a.run <> '1-URGENT' GROUP BY a.run""")
def run_gains_losses(t):
    out = reports.gains_losses(_runs(t), "run", "1-URGENT", "m")
    return out.withColumns({c: F.array_join(c, ",") for c in ("gained", "lost")})


_LISTS = "SELECT o_custkey %% 100 AS qid, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey %% 100 ORDER BY %s, o_orderkey) AS rank FROM orders"


@query("backend_parity", f"""WITH a AS ({_LISTS % '-o_totalprice'}), b AS ({_LISTS % '-round(o_totalprice / 20000)'}), n AS (SELECT qid, least(8, count(*)) AS m FROM a GROUP BY qid)
SELECT n.qid, count(b.id) AS common, count(b.id) / greatest(1, m) AS overlap FROM n LEFT JOIN (SELECT * FROM a WHERE rank <= 8) x ON x.qid = n.qid LEFT JOIN (SELECT * FROM b WHERE rank <= 8) b ON b.qid = x.qid AND b.id = x.id GROUP BY n.qid, m""")
def backend_parity(t):
    rows = t("orders").select((F.col("o_custkey") % 100).alias("qid"), F.col("o_orderkey").alias("id"), "o_totalprice")
    lists = [reports.latest(rows, "qid", [order, F.col("id")], 8).select("qid", F.col("rn").alias("rank"), "id") for order in (-F.col("o_totalprice"), -F.round(F.col("o_totalprice") / 20000))]
    return reports.parity(*lists, 8)


@query("region_recall", """WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9][a-z0-9,.%-]{3,}')) AS l FROM documents), n AS (SELECT *, lead(l) OVER (ORDER BY doc_id) AS r FROM w)
SELECT doc_id, len(l) > 5 AND len(list_intersect(l, r)) >= len(l) * 0.6::DOUBLE - 1e-9 AS inside FROM n WHERE r IS NOT NULL""")
def region_recall(t):
    """Whether each document lies in the region that the next one is."""
    d = t("documents").select("doc_id", "text")
    ids = reports.latest(d.select(F.lit(0).alias("all"), "doc_id"), "all", [F.col("doc_id")], 1 << 30)
    after = ids.select((F.col("rn") - 1).alias("rn"), F.col("doc_id").alias("next_id"))
    pairs = ids.join(after, "rn").join(d, "doc_id").join(d.select(F.col("doc_id").alias("next_id"), F.col("text").alias("region")), "next_id")
    return pairs.select("doc_id", reports.in_region(F.col("text"), F.col("region")).alias("inside"))


@query("category_breakdown", """WITH s AS (SELECT lang, source, n_chars FROM documents), g AS (SELECT coalesce(lang, '?') AS "group", n_chars FROM s UNION ALL SELECT 'source=' || coalesce(source, '?'), n_chars FROM s UNION ALL SELECT 'ALL', n_chars FROM s)
SELECT "group", count(*) AS n, round(avg(n_chars), 3) AS n_chars FROM g GROUP BY 1""")
def category_breakdown(t):
    return reports.by_groups(t("documents"), [], {"": F.col("lang"), "source": F.col("source")}, ["n_chars"])


_COSTS = "r AS (SELECT o_orderpriority AS run, avg(o_totalprice) AS in_tokens, count(*)::DOUBLE / 10 AS out_tokens, avg((o_orderstatus = 'F')::INT::DOUBLE) AS naa FROM orders GROUP BY 1), u AS (SELECT *, (in_tokens * 3.0 + out_tokens * 15.0) / 1000 AS usd FROM r), b AS (SELECT arg_min(naa, usd) AS naa, min(usd) AS usd FROM u)"


def _costs(t) -> DataFrame:
    runs = t("orders").groupBy(F.col("o_orderpriority").alias("run")).agg(F.avg("o_totalprice").alias("in_tokens"), (F.count(F.lit(1)).cast("double") / 10).alias("out_tokens"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("naa"))
    return reports.costs(runs, 3.0, 15.0, "naa")


@query("run_costs", f"WITH {_COSTS} SELECT run, round(u.usd, 4) AS usd_per_1k, round(CASE WHEN u.usd - b.usd > 1e-9 THEN (u.naa - b.naa) / (u.usd - b.usd) END, 8) AS slope FROM u, b")
def run_costs(t):
    return _costs(t).select("run", F.round("usd_per_1k", 4).alias("usd_per_1k"), F.round("slope", 8).alias("slope"))


@query("cheapest_run", f"WITH {_COSTS} SELECT arg_min(run, usd) FILTER (naa >= 0.48) AS naa_run, round(min(usd) FILTER (naa >= 0.48), 4) AS naa_cost FROM u")
def cheapest_run(t):
    return reports.cheapest_meeting(_costs(t), 0.48, "naa").withColumn("naa_cost", F.round("naa_cost", 4))


@query("miss_causes", """WITH m AS (SELECT o_custkey AS qid, count(DISTINCT o_orderpriority) > 3 AS cross_, bool_or(o_orderkey % 31 = 0) AS hit, count(*) AS n, count(*) FILTER (o_orderstatus <> 'F') AS located, count(DISTINCT o_shippriority + o_orderkey % 2) FILTER (o_orderstatus <> 'F') AS firsts, count(DISTINCT o_orderkey % 2) FILTER (o_orderstatus <> 'F') AS parities FROM orders GROUP BY 1),
c AS (SELECT qid, list_filter([CASE WHEN cross_ THEN 'cross_company' END, CASE WHEN NOT (located > 0 AND parities = 1) AND firsts >= 2 THEN 'scattered' END, CASE WHEN hit THEN 'fusion' END, CASE WHEN located < n THEN 'anchor_problem' END, CASE WHEN located > 0 THEN 'no_section' END], lambda x: x IS NOT NULL) AS l FROM m)
SELECT qid, coalesce(l[1], 'wording') AS "primary", CASE WHEN len(l) = 0 THEN 'wording' ELSE array_to_string(l, ',') END AS causes FROM c""".replace("o_shippriority + ", ""))
def miss_causes(t):
    """Customers as misses, orders as anchors: open orders are located, in the chunk of their key's parity."""
    o = t("orders")
    misses = o.groupBy(F.col("o_custkey").alias("qid")).agg(F.when(F.count_distinct("o_orderpriority") > 3, 2).otherwise(1).alias("n_tickers"), F.bool_or(F.col("o_orderkey") % 31 == 0).alias("bm25_hit")).withColumn("dense_hit", F.lit(False))
    chunk = F.array((F.col("o_orderkey") % 2).cast("string"))
    anchors = o.select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("item"), F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")).otherwise(chunk).alias("chunks"), F.array(F.lit("")).alias("sections"))
    return reports.causes(misses, anchors).withColumn("causes", F.array_join("causes", ","))


@query("question_kinds", """SELECT doc_id, CASE WHEN lang = 'de' THEN 'excluded_filing' WHEN source = 'src1' THEN 'graph_route' WHEN NOT coalesce(quality = 1, true) THEN 'unanswerable' WHEN n_chars % 2 = 0 THEN 'number' WHEN n_chars % 3 = 0 THEN 'anchored_prose' ELSE 'prose_no_anchor' END AS kind FROM documents LEFT JOIN labels USING (doc_id)""")
def question_kinds(t):
    d = t("documents").select("doc_id", "lang", "source", "n_chars").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    even = F.col("n_chars") % 2 == 0
    d = d.withColumns({
        "snapshot_status": F.when(F.col("lang") == "de", "review_required").otherwise("ok"), "route_expected": F.when(F.col("source") == "src1", "graph").otherwise("rag"),
        "answerable": F.coalesce(F.col("quality") == 1, F.lit(True)), "answer_type": F.when(even, "exact_numeric").otherwise("text"), "n_facts": F.lit(1), "n_values": F.lit(1), "n_anchors": (F.col("n_chars") % 3 == 0).cast("int"),
    })
    return d.select("doc_id", reports.question_kind().alias("kind"))


@query("freeze_full_outer", "SELECT coalesce(c_custkey, k) AS key, CASE WHEN c_custkey IS NULL THEN 'extra' WHEN k IS NULL THEN 'missing' WHEN n_sets > 2 THEN 'set_mismatch' ELSE 'present' END AS state, coalesce(n, 0) AS n FROM customer FULL JOIN (SELECT o_custkey AS k, count(*) AS n, count(DISTINCT o_orderstatus) AS n_sets FROM orders GROUP BY 1) ON c_custkey = k")
def freeze_full_outer(t):
    """Customers as the freeze list, orders as chunks, whose status is the set: a filing may have two."""
    return tables.freeze_check(t("customer").select(F.col("c_custkey").alias("key")), t("orders").select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("set_id")), 2)


# ---- searches, coverage, chunk variants ----

_THREE = "o AS (SELECT o_custkey % 50 AS qid, o_orderkey AS pos, o_totalprice AS p, o_orderdate AS d FROM orders), l AS (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY -p, pos) AS r FROM o), e AS (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY d, pos) AS r FROM o), f AS (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY pos) AS r FROM o)"


@query("narrative_union", f"""WITH {_THREE}, h AS (SELECT qid, pos, r, 0 AS src FROM l WHERE r <= 5 UNION ALL SELECT qid, pos, r, 1 FROM e WHERE r <= 5),
g AS (SELECT qid, pos, min(r * 2 + src) AS o FROM h GROUP BY ALL), i AS (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY o) AS a FROM g),
u AS (SELECT qid, pos, a FROM i UNION ALL SELECT qid, pos, 1000 + r FROM f), m AS (SELECT qid, pos, min(a) AS a FROM u GROUP BY ALL)
SELECT qid, pos, rank FROM (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY a) AS rank FROM m) WHERE rank <= 10""")
def narrative_union(t):
    o = t("orders").select((F.col("o_custkey") % 50).alias("qid"), F.col("o_orderkey").alias("pos"), "o_totalprice", "o_orderdate")
    lists = [reports.latest(o, "qid", [order, F.col("pos")], 1 << 30).select("qid", "pos", F.col("rn").alias("rank")) for order in (-F.col("o_totalprice"), F.col("o_orderdate"), F.col("pos"))]
    return fusion.union_search(*lists, 10)


@query("neighbour_search", """WITH c AS (SELECT conv_id * 1000 + turn AS pos, conv_id, turn, role FROM conversations), k AS (SELECT conv_id % 20 AS qid, pos, conv_id, turn, row_number() OVER (PARTITION BY conv_id % 20 ORDER BY pos) AS r FROM c WHERE role = 'assistant'),
n AS (SELECT k.qid, c.pos, k.r * 100 + 10 * abs(c.turn - k.turn) + (c.turn > k.turn)::INT AS o FROM k JOIN c ON c.conv_id = k.conv_id AND abs(c.turn - k.turn) BETWEEN 1 AND 2 WHERE k.r <= 3),
u AS (SELECT qid, pos, r * 100 AS o FROM k UNION ALL SELECT * FROM n), m AS (SELECT qid, pos, min(o) AS o FROM u GROUP BY ALL)
SELECT qid, pos, rank FROM (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY o, pos) AS rank FROM m) WHERE rank <= 12""")
def neighbour_search(t):
    c = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("pos"), "conv_id", "turn", "role", (F.col("conv_id") % 20).alias("qid"))
    ranked = reports.latest(c.filter("role = 'assistant'"), "qid", [F.col("pos")], 1 << 30).select("qid", "pos", F.col("rn").alias("rank"))
    return expand.with_neighbours(ranked, c.drop("qid"), ["conv_id"], "turn", 12, window=2)


@query("evidence_by_meta", "SELECT doc_id, upper(lang) IN ('EN', 'DE') AND upper(source) IN ('SRC1', 'SRC2') AS fits FROM documents")
def evidence_by_meta(t):
    spec = F.create_map(F.lit("ticker"), F.array(F.lit("en"), F.lit("De")), F.lit("form"), F.array(F.lit("SRC1"), F.lit("src2")))
    return t("documents").select("doc_id", reports.meta_match(spec, {"ticker": F.col("lang"), "form": F.col("source")}).alias("fits"))


@query("section_keys", """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE (CASE WHEN p_partkey % 2 = 1 THEN 'Part ' || ['I', 'II', 'III', 'IV'][p_partkey % 4 + 1] || ' ' ELSE '' END) || 'Item ' || p_size || 'A' END AS section FROM part""")
def section_keys(t):
    key = F.col("p_partkey")
    part = F.element_at(F.array(*map(F.lit, ("i", "ii", "iii", "iv"))), (key % 4 + 1).cast("int"))
    title = F.when(key % 5 == 0, F.col("p_brand")).otherwise(F.concat(F.lit("Part "), part, F.lit(", item "), F.col("p_size").cast("string"), F.lit("a. Parts")))
    form = F.when(key % 2 == 1, "10-Q").otherwise("10-K")
    return t("part").select("p_partkey", variants.section_key(title, form, F.col("p_brand")).alias("section"))


@query("table_hints", r"SELECT doc_id, regexp_matches(text, '(\n[^\n]*\d[\d,]{2,}[^\n]*){3,}') AS hint FROM documents")
def table_hints(t):
    return t("documents").select("doc_id", variants.table_hint(F.col("text")).alias("hint"))


@query("filing_labels", "SELECT o_orderkey, o_orderstatus || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' FY' || year(o_orderdate) || ' Q1' END || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ', period ended ' || o_orderdate::DATE END AS label FROM orders")
def filing_labels(t):
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", coverage.filing_label(F.col("o_orderstatus"), F.when(key % 3 != 0, F.year(day)), F.lit("Q1"), F.when(key % 4 != 0, day)).alias("label"))


@query("company_aliases", "SELECT replace(lower(s_name), '#', ' ') AS alias, 'S' || s_suppkey AS ticker FROM supplier UNION SELECT lower('S' || s_suppkey), 'S' || s_suppkey FROM supplier")
def company_aliases(t):
    return coverage.alias_table(t("supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"), F.col("s_name").alias("company")))


@query("length_quantiles", "WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT lang, max(n_chars) FILTER (i = least(floor(0.5::DOUBLE * n), n - 1)) AS p50, max(n_chars) FILTER (i = least(floor(0.9::DOUBLE * n), n - 1)) AS p90 FROM r GROUP BY lang")
def length_quantiles(t):
    return evaluate.nearest_index_percentile(t("documents"), ["lang"], "n_chars", {"p50": 0.5, "p90": 0.9}, floor=True)


@query("catalogue_survey", """SELECT n_regionkey, count(*) AS nations, string_agg(n_name, ', ' ORDER BY n_name) AS names, (SELECT count(DISTINCT s_suppkey) FROM supplier JOIN nation m ON s_nationkey = m.n_nationkey WHERE m.n_regionkey = n.n_regionkey) AS suppliers,
(SELECT count(*) FROM customer JOIN nation m ON c_nationkey = m.n_nationkey WHERE m.n_regionkey = n.n_regionkey AND c_acctbal < 0) AS debtors FROM nation n GROUP BY n_regionkey""")
def catalogue_survey(t):
    return tables.survey(t("nation"), t("supplier"), t("customer"))


@query("pinned_rows", """WITH pins AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT')
SELECT o.o_orderkey, c_name, n_name, l_linenumber FROM pins JOIN orders o USING (o_orderkey) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem WHERE l_quantity > 40 GROUP BY 1) ON l_orderkey = o.o_orderkey""")
def pinned_rows(t):
    for name in ("orders", "customer", "nation", "lineitem"):
        t(name).createOrReplaceTempView(f"pinned_{name}")
    return tables.pinned(t("orders").sparkSession, orders="pinned_orders", customer="pinned_customer", nation="pinned_nation", lineitem="pinned_lineitem")
