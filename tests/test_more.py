"""Chunk variants, coverage messages, narrative searches, listings, sinks, question sets, reports."""

import io
import json
import re
import urllib.error
from collections import Counter
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from filigrain.functions.text import STOP_WORDS, TOKEN, normal_name, prose_numbers
from filigrain.operators import answers, coverage, expand, fusion, lexical, objective, reports, sections, variants
from filigrain.plans import derived
from filigrain.plans.catalogue import QUERIES, SQL
from filigrain.sources import filings, tables


def test_paragraphs_are_packed_by_characters():
    text = "one two three\n\nfour five\nsix seven eight nine"
    assert variants.paragraphs(text) == [("one two three", 0, 13), ("four five", 15, 24), ("six seven eight nine", 25, 45)]
    assert variants.packed_paragraphs(variants.paragraphs(text), 24, 6) == [
        ("one two three\n\nfour five", 0, 24), ("five\n\nsix seven eight nine", 20, 45),
    ]
    assert variants.packed_paragraphs([], 10, 5) == [] and variants.packed_paragraphs([("x" * 30, 0, 30)], 10, 5) == [("x" * 30, 0, 30)]


def test_recursive_chunks_carry_sentences():
    text = "A b c. D e.\nF g h i j k l."
    spans = variants.paragraphs(text)
    # three words are 4 tokens, two are 3; the first paragraph has 7, the second 10
    assert variants.units(spans, 7) == [("A b c. D e.", 0, 11), ("F g h i", 12, 26), ("j k l.", 12, 26)]
    got = variants.recursive_chunks(spans, 10, 0.5)
    assert got == [("A b c. D e.", 0, 11), ("D e.\n\nF g h i j k l.", 7, 26)]


def test_variants_of_a_table(spark):
    rows = spark.createDataFrame([(1, "a b\nc d"), (2, None), (3, " ")], "id int, text string")
    got = [tuple(r) for r in variants.variant(rows, "id", "paragraphs").collect()]
    assert got == [(1, 0, "a b\n\nc d", 0, 7)]
    assert variants.variant(rows, "id", "recursive").count() == 1


def test_section_keys_and_hints(spark):
    rows = [("Part ii, Item 7a. Risk", "10-Q", None), ("PART I ITEM 2", "10-K", None), ("Notes", "10-K", "note"), (None, "10-K", "")]
    df = spark.createDataFrame(rows, "t string, f string, o string")
    assert [r[0] for r in df.select(variants.section_key(F.col("t"), F.col("f"), F.col("o"))).collect()] == ["Part II Item 7A", "Item 2", "note", "Unlabeled"]
    texts = spark.createDataFrame([("a\nx 100\ny 2,000\nz 300\n",), ("a\nx 100\nno\nz 300\n",), (None,)], "t string")
    assert [r[0] for r in texts.select(variants.table_hint(F.col("t"))).collect()] == [True, False, False]


FILINGS = [
    ("ACME", "Acme Corp.", "10-K", "a1", date(2030, 12, 31), 2030, "FY"), ("ACME", "Acme Corp.", "10-Q", "a2", date(2031, 3, 31), 2031, "Q1"),
    ("O'R", "O’Réal, Inc.", "10-K", "o1", None, None, None),
]
FILING = "ticker string, company string, form string, accession string, period_end date, fiscal_year int, fiscal_period string"


def test_aliases_and_messages(spark):
    held = spark.createDataFrame(FILINGS, FILING)
    extra = spark.createDataFrame([("Roadrunner Co", "ACME")], "alias string, ticker string")
    assert {r["alias"]: r["ticker"] for r in coverage.alias_table(held, extra).collect()} == {"acme": "ACME", "o'r": "O'R", "o'real": "O'R", "oreal": "O'R", "roadrunner": "ACME"}
    kind = "array<string>"
    asked = [(1, ["ACME"], ["10-K"], [2030], None), (2, ["ACME"], None, [2027], ["Tesla"]), (3, [], None, None, None), (4, ["O'R"], ["10-Q"], None, None)]
    requests = spark.createDataFrame([(q, t, f, y, None, None, u) for q, t, f, y, u in asked], f"qid int, tickers {kind}, forms {kind}, fiscal_years array<int>, fiscal_periods {kind}, period_ends array<date>, unresolved {kind}")
    got = {r["qid"]: r["message"] for r in coverage.messages(requests, held).collect()}
    assert got == {
        1: "All requested filings are in the database.", 3: "The question names no company, so there is nothing to pre-check.",
        2: "Not in our database: Tesla. No filing in our database covers: ACME FY2027. For ACME we have: 10-K FY2030 FY, period ended 2030-12-31; 10-Q FY2031 Q1, period ended 2031-03-31.",
        4: "No filing in our database covers: O'R 10-Q. For O'R we have: 10-K.",
    }
    assert {r["status"]: r["n"] for r in coverage.replay(requests, held).collect()} == {"all_hit": 1, "none": 2, "no_target": 1}


def test_typos_are_one_edit(spark):
    names = spark.createDataFrame([(n,) for n in ("Microchip", "ab", "x", "International")], "n string")
    for seed in range(4):
        for n, t in names.select("n", coverage.typo(F.col("n"), seed)).collect():
            assert coverage.osa(n, t) <= 1 and (n == "x") == (n == t) or n[0] == n[1:2]


def test_normal_names(spark):
    df = spark.createDataFrame([("Crédit Agricole S.A.",), ("Moody’s Corporation",), ("A & B, Inc",)], "n string")
    assert [r[0] for r in df.select(normal_name(F.col("n"))).collect()] == ["credit agricole s a", "moody's", "a & b"]


def test_narrative_searches(spark):
    lists = {"l": [1, 2, 3], "d": [4, 2, 5], "f": [2, 1, 4, 9]}
    made = {n: spark.createDataFrame([(0, p, i + 1) for i, p in enumerate(ps)], "qid int, pos int, rank int") for n, ps in lists.items()}
    got = fusion.union_search(made["l"], made["d"], made["f"], 5, each=2).orderBy("rank")
    assert [r["pos"] for r in got.collect()] == [1, 4, 2, 9]
    chunks = spark.createDataFrame([(p, "g" if p < 8 else "h", p % 8, p % 2 == 0) for p in range(12)], "pos int, g string, seq int, even boolean")
    ranked = spark.createDataFrame([(0, 3, 1), (0, 9, 2), (0, 4, 3)], "qid int, pos int, rank int")
    found = expand.with_neighbours(ranked, chunks, ["g"], "seq", 6, n_seed=2).orderBy("rank")
    assert [r["pos"] for r in found.collect()] == [3, 2, 4, 9, 8, 10]
    even = expand.with_neighbours(ranked, chunks, ["g"], "seq", 9, n_seed=1, window=2, allowed=F.col("even")).orderBy("rank")
    assert [r["pos"] for r in even.collect()] == [3, 2, 4, 9]
    parents = spark.createDataFrame([(3, "p", 10), (4, "p", 10), (9, "q", 7)], "pos int, parent_id string, n_tokens int")
    hits = spark.createDataFrame([(0, 1, "q"), (0, 2, None)], "qid int, item int, parent_id string")
    assert [tuple(r) for r in expand.parent_scores(ranked, parents, hits, 2).collect()] == [(0, 0.5, 17)]


class Answer(io.BytesIO):
    pass


def test_client_waits_and_tries_again():
    slept, calls = [], []

    def opener(request):
        calls.append(request.get_header("User-agent"))
        if len(calls) < 3:
            raise urllib.error.HTTPError(request.full_url, 429 if len(calls) == 1 else 503, "busy", None, None)
        return Answer(b"ok")

    client = filings.Client("me@example.org", opener=opener, sleep=slept.append, clock=lambda: 0.0)
    assert client.get("http://x") == b"ok" and calls == ["me@example.org"] * 3
    assert slept[0] == 0.0 and slept[1] < slept[2]
    with pytest.raises(ValueError):
        filings.Client("nobody")

    def gone(request):
        raise urllib.error.HTTPError(request.full_url, 404, "no", None, None)

    with pytest.raises(urllib.error.HTTPError):
        filings.Client("me@example.org", opener=gone, sleep=slept.append).get("http://x")


def test_listings(spark, tmp_path):
    def block(*forms):
        return {"form": list(forms), "accessionNumber": [f"n{f}" for f in forms], "filingDate": ["2031-01-01"] * len(forms), "reportDate": [""] * len(forms), "primaryDocument": ["d.htm"] * len(forms)}

    text = spark.createDataFrame([(json.dumps({"0": {"cik_str": 7, "ticker": "abc", "title": "A"}, "1": {"cik_str": 8, "ticker": "D", "title": "D"}}),)], "value string")
    assert {tuple(r) for r in filings.ticker_map(text).collect()} == {("ABC", 7), ("D", 8)}
    subs = spark.createDataFrame([("ABC", json.dumps({"name": "A", "filings": {"recent": block("10-K", "8-K"), "files": [{"name": "p1"}, {"name": "p2"}]}}))], "ticker string, j string")
    subs = subs.select("ticker", F.from_json("j", filings.SUBMISSIONS).alias("s")).select("ticker", "s.*")
    pages = spark.createDataFrame([("p2", json.dumps(block("10-K/A"))), ("p1", json.dumps(block("10-Q", "10-K")))], "name string, j string")
    pages = pages.select("name", F.from_json("j", filings.PAGE.split("block ")[1]).alias("block"))
    got = filings.listed_filings(subs, pages).orderBy("page", "pos")
    assert [(r["page"], r["pos"], r["form"]) for r in got.collect()] == [(0, 0, "10-K"), (0, 1, "8-K"), (1, 0, "10-Q"), (1, 1, "10-K"), (2, 0, "10-K/A")]
    wanted = spark.createDataFrame([("ABC", "10-K", 3), ("ABC", "10-Q", 1), ("D", "10-K", 1)], "ticker string, form string, n int")
    assert {tuple(r) for r in filings.shortfall(got, wanted).collect()} == {("ABC", "10-K", 3, 2), ("D", "10-K", 1, 0)}
    both = filings.union_of_columns(spark.range(1).selectExpr("id", "array(1, 2) AS a"), spark.range(1).selectExpr("'x' AS b"))
    filings.write_results(both, str(tmp_path / "r"))
    assert both.columns == ["id", "a", "b"] and spark.read.option("header", True).csv(str(tmp_path / "r/csv")).count() == 2
    assert filings.markdown_table(spark.range(2).withColumnRenamed("id", "n"), F.col("n")) == "| n |\n| --- |\n| 0 |\n| 1 |"
    answers = spark.createDataFrame([("q", ["c2", "c1"]), ("r", [])], "qid string, citations array<string>")
    chunks = spark.createDataFrame([("c1", "short"), ("c2", "a longer text")], "chunk_id string, text string")
    assert {r["qid"]: r["texts"] for r in filings.samples(answers, chunks, 5, 8).collect()} == {"q": ["a longer ...", "short"], "r": None}


def test_company_names_and_items(spark):
    rows = [("KITE", "KITE & BOW HOLDING CO INC"), ("CVX", "cvx, Corp."), ("IBX", "IBX TRUST LTD"), ("Z", None), ("MAN", "Man's World")]
    df = spark.createDataFrame(rows, "t string, n string")
    assert [r[0] for r in df.select(objective.company_name(F.col("t"), F.col("n"), {"MAN": "Men's"})).collect()] == ["Kite & Bow Holding", "cvx", "Ibx Trust", "Z", "Men's"]
    row = ("KITES", "Kites Inc", 7, "acc", "10-K", "2031-02-01", "2030-12-31", "revenue", "income_statement", "duration", "2030-01-01", "2030-12-31", 365, 8200000.0, ["us:Sales"], "8,200", "current")
    names = "ticker company_name cik accession_number form filing_date reporting_period_end metric_key statement_type period_kind period_start period_end duration_days value concept_names display_text relation".split()
    kinds = {"cik": "int", "duration_days": "int", "value": "double", "concept_names": "array<string>"}
    (item,) = objective.items(spark.createDataFrame([row], ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)).withColumn("id", F.lit(1)), "id", "A").collect()
    assert item["qid"] == "OBJ-A-001" and item["display"] == "USD 8,200 thousand" and item["min_sig_figs"] == 2 and item["fact"]["concept"] == "us-gaap:us:Sales"
    assert item["question"] == "What was Kites' total revenue for the fiscal year ended December 31, 2030? Answer in USD thousands."


def test_anchor_fixes(spark):
    anchors = spark.createDataFrame([("a", 0, ["x"]), ("a", 1, ["y "]), ("b", 0, ["z"]), ("c", 0, ["w"])], "qid string, item int, contains array<string>")
    fixes = [("a", "remove", "x", None), ("a", "narrow", "y", "y| row"), ("b", "narrow", "z", "only"), ("b", "remove", "gone", None), ("c", "drop", "w", None), ("q", "remove", "x", None)]
    fixed, counts = reports.fixed_anchors(anchors, spark.createDataFrame(fixes, "qid string, action string, rag_anchor string, suggested_anchor string"))
    assert {(r["qid"], r["item"]): (r["contains"], r["anchor_fix"]) for r in fixed.collect()} == {("a", 1): (["y", "row"], "narrowed"), ("b", 0): (["z"], "narrow pending"), ("c", 0): (["w"], None)}
    assert {r["outcome"]: r["n"] for r in counts.collect()} == {"removed": 1, "narrowed": 1, "narrow pending": 1, "remove already applied": 1, "dropped": 1}


def test_parity_gate(spark):
    recalls = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.98)], "qid int, left double, right double")
    assert reports.parity_passes(recalls, True).first()["passed"] and not reports.parity_passes(recalls, False).first()["passed"] and not reports.parity_passes(recalls, True, 0.005).first()["passed"]


def test_small_sources_and_sinks(spark, tmp_path):
    chunks = spark.createDataFrame([("c2", "a1", "10-K", "x"), ("c1", "a1", "10-K", "y"), ("c3", "a2", "10-Q", "z")], "chunk_id string, accession string, form string, text string")
    tables.write_chunks(chunks, str(tmp_path / "chunks"))
    assert {p.name for p in (tmp_path / "chunks").iterdir() if p.is_dir()} == {"form=10-K", "form=10-Q"} and spark.read.parquet(str(tmp_path / "chunks")).count() == 3
    assert {r["chunk_id"] for r in tables.coverage_of(chunks).collect()} == {"c1", "c3"}
    for _ in range(2):
        tables.append_log(spark.range(1), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_reports_and_headers_of_chunks(spark):
    made = spark.createDataFrame([("f", "Item 1", True, 0.4), ("f", "Item 2", False, 0.4), ("g", "Item 1", False, 0.9)], "filing string, section string, is_table boolean, coverage double")
    assert {tuple(r[:3]) + (r["low"],) for r in sections.chunk_report(made, "filing").collect()} == {("f", 2, 1, True), ("g", 1, 0, False)}
    row = spark.range(1).select(sections.index_text(F.lit("body"), F.lit("Kites"), F.lit("KITE"), F.lit("10-K"), F.lit("FY2030"), F.lit("Item 1"), F.lit("Risk"), F.lit("")).alias("t"), answers.prior_year(F.lit("2032-02-29").cast("date")).alias("d"), prose_numbers(F.lit("In 2030 sales were $1,200.5 up 12%")).alias("n")).first()
    assert row["t"] == "Kites (KITE) 10-K FY2030 | Item 1 Risk\nbody" and row["d"] == date(2031, 2, 28) and row["n"] == ["$1,200.5", "12%"]


def test_pairs_of_a_task_are_bounded(spark):
    """A task gets so few chunks that their scores with all queries stay in number, and the results are the same."""
    chunks = spark.createDataFrame([(i, f"alpha beta w{i % 7}", "ab"[i % 2]) for i in range(400)], "pos long, text string, lang string")
    asked = spark.createDataFrame([(q, f"alpha w{q}") for q in range(5)], "qid long, query string")
    for df in (lexical.scores(chunks, asked, pairs=100), lexical.keyword_overlap(chunks, asked, 400, pairs=100)):
        assert sorted((r["qid"], r["pos"]) for r in df.collect()) == [(q, i) for q in range(5) for i in range(400)]
    per_task = lexical.scores(chunks, asked, pairs=100).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 2000 and max(r["count"] for r in per_task) <= 250


def test_candidates_by_a_condition(spark):
    """Masked chunks count in the statistics, a null condition lets nothing through, kept columns go along."""
    chunks = spark.createDataFrame([(i, f"alpha w{i % 7} " * (i % 3 + 1), [None, "a", "b"][i % 3]) for i in range(60)], "pos long, text string, lang string")
    asked = spark.createDataFrame([(q, f"alpha w{q}") for q in range(3)], "qid long, query string")
    rows = lambda df: sorted((r["qid"], r["pos"], r["score"], r["rank"]) for r in df.collect())
    assert rows(lexical.bm25(chunks, asked, F.col("lang") == "a", 7)) == rows(lexical.bm25(chunks, asked, chunks.filter("lang = 'a'").select("pos"), 7))
    kept = lexical.scores(chunks, asked, keep=("lang",), allowed=F.col("lang").isin("a", "b")).select("pos", "lang").distinct().collect()
    assert sorted(map(tuple, kept)) == [(i, [None, "a", "b"][i % 3]) for i in range(60) if i % 3]


@pytest.mark.parametrize("combine", ["product", "independent"])
def test_targets_of_a_task_are_bounded(spark, monkeypatch, combine):
    monkeypatch.setattr(coverage, "TASK_ROWS", 20)
    filings = spark.createDataFrame([(f"t{i}", "10-K", f"a{i}", date(2024, 12, 31), 2024, "FY") for i in range(200)], "ticker string, form string, accession string, period_end date, fiscal_year int, fiscal_period string")
    asked = spark.range(200).selectExpr("id AS qid", "array('t' || id) AS tickers", "array('10-K') AS forms", "array(2023, 2024) AS fiscal_years", "CAST(NULL AS array<string>) AS fiscal_periods", "CAST(NULL AS array<date>) AS period_ends")
    rows = coverage.targets(asked, filings, combine)
    per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == rows.count() and len(per_task) > 10 and max(per_task) <= 80
    assert coverage.check(asked, filings, combine).filter("status <> 'all_hit' AND accessions[0] <> 'a' || qid").count() == 0


def test_lines_of_a_task_are_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(derived, "_TASK_LINES", 500)
    per_task = derived.logical_rows(lambda t: spark.read.parquet(f"{sf}/{t}.parquet")).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 10


def _spread(spark):
    """200 chunks: few, middling and common words, copies, ties, short and empty texts, one without text."""
    words = [f"w{i:03d}" for i in range(300)]
    texts = [" ".join(words[j] for j in range(300) if (i * 7919 + j * 104729) % 997 < 3 * j) for i in range(150)]
    texts += ["w299 w298"] * 20 + ["w299"] * 10 + ["alone w299 w298 w297"] * 3 + ["b a c w299 a"] * 2 + ["", "...", None, "the w001's of", "z.9 z-9 z&9 z"] + [f"own{i} w299 w298" for i in range(10)]
    return list(enumerate(texts)), spark.createDataFrame(list(enumerate(texts)), "pos long, text string")


def _rarest(chunks, k):
    """By brute force: postings are one per term, position and length."""
    postings = set()
    for pos, t in chunks:
        toks = [w for w in re.findall(TOKEN, (t or "").lower().replace("’", "'").replace("'s ", " ")) if w not in STOP_WORDS]
        postings |= {(w, pos, len(toks)) for w in toks}
    df = Counter(w for w, _, _ in postings)
    by = {}
    for w, pos, _ in postings:
        by.setdefault(pos, []).append((df[w], w))
    return sorted((pos, w, n, rank) for pos, found in by.items() for rank, (n, w) in enumerate(sorted(found)[:k], 1))


@pytest.mark.parametrize("most", [1, 3, 40, 10_000])
def test_rarest_terms_whatever_is_common(spark, most):
    chunks, df = _spread(spark)
    assert sorted(map(tuple, lexical.rarest(df, most=most).collect())) == _rarest(chunks, 3)
    again = [*chunks, *((pos, t) for pos, t in chunks if pos % 3), *((pos, f"{t} more") for pos, t in chunks if pos % 5 == 0)]
    twice = spark.createDataFrame(again, "pos long, text string")
    assert sorted(map(tuple, lexical.rarest(twice, 2, most=most).collect())) == _rarest(again, 2)


def test_rarest_terms_deals_only_rare_pairs(spark, sf):
    """All pairs of a term and a chunk, of texts tokenised in the plan, were dealt by both and joined by term."""
    plan = QUERIES["rarest_terms"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "strategy=shuffle_hash" in plan


def test_a_text_is_tokenised_once(spark):
    """Spark derived a filter on the exploded array, with the whole tokenisation in it."""
    index = lexical.build(_spread(spark)[1])
    for df in (index.postings, index.terms, index.corpus):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_corpus_stats_read_texts_once(spark, sf, tmp_path):
    """Three reads and five tokenisations before. Without texts or terms there is no mean and no sum, as in the SQL."""
    plan = QUERIES["corpus_stats"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("Relation [") == 1
    chunks, _ = _spread(spark)
    for i, some in enumerate((chunks, [*chunks, *chunks, (None, "w001 w002")], [(1, None), (2, "")], [(1, None)], [(1, "of the")], [])):
        spark.createDataFrame(some, "doc_id long, text string").withColumn("lang", F.lit("")).withColumn("source", F.lit("")).coalesce(1).write.parquet(f"{tmp_path}/{i}/documents.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{i}/documents.parquet/*.parquet'")
        assert [tuple(r) for r in QUERIES["corpus_stats"](spark, f"{tmp_path}/{i}").select("n", "avgdl", "terms", "tokens").collect()] == con.execute(SQL["corpus_stats"]).fetchall()
