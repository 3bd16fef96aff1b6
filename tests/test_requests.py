"""Filters, search, index folders, sources, latent vectors, streams."""

import json

import pytest
from pyspark.sql import functions as F

from filigrain.operators import dense, latent, reports, requests as R
from filigrain.sources import tables
from filigrain.streaming import logs


def test_filters():
    got = R.normal_filters({"ticker": [" msft", "MSFT"], "cik": 42, "accession_number": "000119312526191507", "fiscal_year": "2025", "section": " item  1a ", "is_table": True, "form": None})
    assert got == {"ticker": ["MSFT"], "cik": ["0000000042"], "accession_number": ["0001193125-26-191507"], "fiscal_year": [2025], "section": ["ITEM 1A"], "is_table": [True]}
    for bad in ({"form_type": "10-K"}, {"ticker": []}, {"fiscal_year": True}, {"fiscal_year": 1900}, {"fiscal_period": "Q5"}, {"is_table": 1}, {"filing_date": "1/2/26"}, "ticker"):
        with pytest.raises(ValueError):
            R.normal_filters(bad)
    for bad in (("", 5), ("q", 0), ("q", True), ("q", 51)):
        with pytest.raises(ValueError):
            R.check_request(*bad)
    assert [label for label, _ in R.split_targets({"ticker": ["b", "a"], "fiscal_year": [2025, 2024], "form": "10-K"})] == ["A 2024", "A 2025", "B 2024", "B 2025"]


def test_predicate_nulls_never_match(spark):
    rows = spark.createDataFrame([("msft", "2025", "Item 1A"), (None, "2025", "Item 1"), ("aapl", "x", "Item 1")], "ticker string, fiscal_year string, section string")
    keep = lambda f: [r["ticker"] for r in rows.filter(R.predicate(R.normal_filters(f), rows.columns)).collect()]
    assert keep({"ticker": ["MSFT", "AAPL"]}) == ["msft", "aapl"] and keep({"fiscal_year": 2025}) == ["msft", None]
    assert keep({"section": "item 1"}) == [None, "aapl"] and keep({"cik": 1}) == []


@pytest.fixture(scope="module")
def engine(spark, sf, tmp_path_factory):
    docs, vectors = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/embeddings.parquet")
    fixed = {"cik": "42", "company": "X", "accession": "0001193125-26-191507", "filing_date": "2026-01-01", "section": "Unlabeled"}
    chunks = docs.select(F.col("doc_id").alias("pos"), F.concat(F.lit("c"), "doc_id").alias("chunk_id"), "text", F.upper("lang").alias("ticker"), F.col("source").alias("form"), *(F.lit(v).alias(k) for k, v in fixed.items()))
    path = str(tmp_path_factory.mktemp("index"))
    tables.save_index(chunks, path, vectors.select(F.col("vec_id").alias("pos"), "embedding"))
    vec = vectors.orderBy("vec_id").first()["embedding"]
    return R.Engine(tables.load_index(spark, path), lambda texts: [vec for _ in texts], log=f"{path}/log")


def test_search(spark, sf, engine):
    query = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    out = engine.search(query, {"ticker": "en"}, 5)
    rows = out["results"]
    assert len(rows) == 5 and {r["ticker"] for r in rows} == {"EN"} and rows[0]["cik"] == "0000000042" and rows[0]["section"] is None
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    flat = [(0, *(r[c] for c in R.FIELDS)) for r in rows]
    assert R.contract_faults(spark.createDataFrame(flat, f"qid int, {R.CONTRACT}")).count() == 0
    assert R.contract_faults(spark.createDataFrame(flat[1:], f"qid int, {R.CONTRACT}")).count() == 4
    many = engine.multi(query, {"ticker": ["en", "fr"]}, 4, method="dense")
    assert many["targets"] == ["EN", "FR"] and [r["metadata"]["target"] for r in many["results"]] == ["EN", "FR", "EN", "FR"]
    none = engine.search("zzzz", {"ticker": "xx"}, 3, method="bm25")
    assert (none["results"], none["evidence_status"], none["weak_reasons"]) == ([], "empty", ["filter_no_match"])
    assert engine.search("zzzz", None, 3, method="bm25")["weak_reasons"] == ["no_results"]
    again = R.Engine(engine.index, scorer=lambda q, t: t.str.len().astype(float)).search(query, None, 3, method="bm25")
    assert again["method"] == "bm25+rerank" and [r["score"] for r in again["results"]] == sorted((r["score"] for r in again["results"]), reverse=True)
    assert spark.read.json(engine.log).count() == 5
    assert R.passages(rows, 10).startswith("[1] X | ")


def test_index_errors(spark, tmp_path, engine):
    with pytest.raises(R.RetrievalUnavailableError):
        tables.load_index(spark, str(tmp_path / "none"))
    moved = tables.same_vectors(engine.index.vectors, engine.index.vectors.filter("pos > 0")).first()
    assert (moved["missing"], moved["moved"]) == (1, 0)


def test_sources(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    chunks = tables.read_chunks(spark, file("c.jsonl", '{"chunk_id": "b", "text": "x"}\n\n{"chunk_id": "a", "text": "y"}\n'))
    assert [(r["chunk_id"], r["pos"]) for r in tables.with_positions(chunks).orderBy("pos").collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(ValueError):
        tables.read_chunks(spark, file("e.jsonl", ""))
    rows = tables.read_catalogue(spark, file("c.csv", '﻿chunk_id,accession_number,text\n1,A,"two\nlines ""q"""\n1,B,again\n2,C,z\n')).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["accession"], r["text"]) for r in rows] == [("1", "A", 'two\nlines "q"'), ("2", "C", "z")]
    spec = {"ticker": "a", "form": ["10-K", "10-Q"], "contains": ["x", "y"], "region": "r"}
    gold = [
        {"qid": "1", "question": "?", "filters": {"ticker": ["A", "B"], "fiscal_year": 2031}, "gold": {"chunk_ids": [], "evidence": [spec, {"chunk_ids": ["c"]}]}},
        {"qid": "2", "gold": {"chunk_ids": [], "evidence": []}}, {"qid": "3", "status": "draft", "gold": {"chunk_ids": ["c"]}}, {"qid": "4"},
    ]
    path = file("g.jsonl", "// note\n\n" + "\n".join(map(json.dumps, gold)))
    (read,) = tables.read_gold(spark, path).collect()
    assert read["qid"] == "1" and read["filters"] == {"ticker": ["A", "B"], "fiscal_year": ["2031"]}
    assert [tuple(e) for e in read["evidence"]] == [(0, None, {"ticker": ["a"], "form": ["10-K", "10-Q"]}, ["x", "y"]), (1, ["c"], None, None)]
    drafts = tables.read_gold(spark, path, drafts=True)
    assert [r["qid"] for r in drafts.orderBy("qid").collect()] == ["1", "3"]
    held = [("c", "nothing", "Z", "8-K"), ("d", "has X then Y", "A", "10-q"), ("e", "has x alone", "A", "10-K"), ("f", "x y", "B", "10-K")]
    hits = reports.evidence_hits(tables.evidence_items(drafts), spark.createDataFrame(held, "chunk_id string, text string, ticker string, form string"))
    assert sorted(map(tuple, hits.collect())) == [("1", 0, "d"), ("1", 1, "c"), ("3", -1, "c")]
    cover = tables.read_coverage(spark, file("m.csv", "ticker,validation_status\nA,passed\nB,failed\nC,\n"))
    assert [r["ticker"] for r in cover.collect()] == ["A", "C"]
    answers = tables.read_answers(spark, file("a.jsonl", '{"k": "1", "t": 1, "v": "old"}\n{"k": "1", "t": 2, "v": "new"}\n{"k": "1", "t'), "k string, t int, v string", "k", "t")
    assert [r["v"] for r in answers.collect()] == ["new"]
    file("raw/f.htm", "<p>hello</p>")
    got = tables.read_filings(spark, file("man.jsonl", '{"ticker": "A", "local_path": "raw/f.htm"}'), str(tmp_path / "raw"))
    assert got.first()["html"] == "<p>hello</p>"


def test_latent_vectors_put_like_texts_together(spark):
    texts = [(i, f"profit revenue margin sales q{i % 3}" if i % 2 else f"lawsuit court judge appeal q{i % 3}") for i in range(20)] + [(20, None)]
    df = spark.createDataFrame(texts, "pos long, text string")
    made = latent.embed(latent.fit(df, dims=4), df)
    assert made.count() == 21
    near = dense.dense(made, made.filter("pos = 1").select(F.col("pos").alias("qid"), F.col("embedding").alias("vec")), 10).collect()
    assert {r["pos"] % 2 for r in near} == {1}


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.json(str(tmp_path / "in"))
    logs.follow(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double", str(tmp_path / "out"), str(tmp_path / "check"), "ts", "event_type", "value").awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = logs.latency_windows(events, "ts", "event_type", "value")
    assert out.count() > 0 and out.exceptAll(batch).count() == 0
    # only windows that the watermark has not closed are still open
    assert batch.exceptAll(out).select(F.min("start")).first()[0] >= out.select(F.max("start")).first()[0]


def test_dense_takes_any_number_of_queries(spark):
    made = spark.range(40).select(F.col("id").alias("pos"), F.array(F.cos("id"), F.sin("id")).alias("embedding"))
    asked = made.select(F.col("pos").alias("qid"), F.col("embedding").alias("vec"))
    whole = sorted(map(tuple, dense.dense(made, asked, 5).collect()))
    assert len(whole) == 200 and sorted(map(tuple, dense.dense(made, asked, 5, most_queries=7).collect())) == whole
