"""The command line end to end on two invented filings, and what surrounds a reader."""

import json

import pytest
from pyspark.sql import functions as F

from filigrain import cli
from filigrain.operators import answers


def test_settings_and_flags(tmp_path):
    (tmp_path / "s.toml").write_text('[filigrain]\nindex = "/a"\nmethod = "dense"\n')
    assert cli.settings(str(tmp_path / "s.toml"), {"FILIGRAIN_INDEX": "/b"}) == {"index": "/b", "method": "dense", "log": None}
    assert cli.settings(None, {})["method"] == "bm25"
    with pytest.raises(ValueError):
        cli.settings(None, {"FILIGRAIN_METHOD": "magic"})
    flags = cli.parser().parse_args(["search", "q", "--ticker", "A,B", "--year", "2030", "--tables-only"])
    assert cli.filters_of(flags) == {"ticker": ["A", "B"], "fiscal_year": ["2030"], "is_table": True}


def test_chunk_index_search_coverage(spark, tmp_path, monkeypatch):
    prose = "Kites are sold in every harbour of the northern coast. " * 12
    for name, word in (("k", "tails"), ("f", "ferries")):
        (tmp_path / f"{name}.htm").write_text(f"<p>Item 1. Business</p><p>{prose}</p><p>We make {word}.</p>")
    rows = [{"ticker": t, "cik": c, "company": n, "form": "10-K", "accession": a, "filing_date": "2031-02-01", "period_of_report": "2030-12-31", "fiscal_year": 2030, "fiscal_period": "FY", "local_path": f"{p}.htm", "source_url": "u"} for t, c, n, a, p in (("KITE", 1, "Kites Inc", "0000000001-31-000001", "k"), ("FER", 2, "Ferry Co", "0000000002-31-000001", "f"))]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    monkeypatch.setenv("FILIGRAIN_INDEX", str(tmp_path / "index"))
    cli.main(["chunk", str(tmp_path / "m.jsonl"), str(tmp_path), str(tmp_path / "chunks")], spark)
    cli.main(["index", str(tmp_path / "chunks")], spark)
    found = cli.main(["search", "ferries", "--top-k", "3"], spark)
    assert [r["ticker"] for r in found["results"]] == ["FER"] and found["results"][0]["cik"] == "0000000002"
    assert cli.main(["search", "ferries", "--ticker", "kite"], spark)["results"] == []
    (tmp_path / "c.csv").write_text("ticker,company_name,form,accession_number,reporting_period_end,fiscal_year,fiscal_period,validation_status\nKITE,Kites Inc,10-K,a,2030-12-31,2030,FY,passed\n")
    assert cli.main(["coverage", str(tmp_path / "c.csv"), "What did Kites earn in FY2030?"], spark)["status"] == "all_hit"
    assert cli.main(["coverage", str(tmp_path / "c.csv"), "What did Kites earn in FY2020?"], spark)["message"].startswith("No filing in our database covers: KITE FY2020.")


def test_reader_surroundings(spark):
    rows = spark.createDataFrame([(1, 2, "B", "T", "10-Q", None, None, "two", {}), (1, 1, "A", "S", "10-K", "2030-12-31", "Item 1", "one", {"section_title": "Risk"})], "qid int, rank int, company_name string, ticker string, form string, reporting_period_end string, section string, text string, metadata map<string,string>")
    assert answers.contexts(rows).first()["context"] == "[1] A (S) 10-K period ended 2030-12-31, Item 1 Risk\none\n\n---\n\n[2] B (T) 10-Q\ntwo"
    one = spark.range(1).select(answers.answer_key(F.lit("m"), F.lit(None), F.lit("q")).alias("k"), answers.usd(F.lit(1000), F.lit(100), 3, 15).alias("u"), answers.filters_of_mode(F.lit("none"), F.lit("g"), F.lit("p")).alias("f")).first()
    assert len(one["k"]) == 24 and abs(one["u"] - 0.0045) < 1e-12 and one["f"] is None
    kind = "cell_key string, row_label string, row_path array<string>, row_index int, column_header string, column_index int, period_end date, period_months int, change_column boolean, value_text string, value double, unit_scale double, unit_known boolean, is_percent boolean, chunk_id string, filing string"
    cell = lambda k, v, c: (k, "r", ["r"], 0, "h", 0, None, None, False, str(v), float(v), 1.0, True, False, c, "F")
    cited, whole = spark.createDataFrame([cell("x", 5, "c")], kind), spark.createDataFrame([cell("x", 5, "c"), cell("y", 7, "d")], kind)
    targets = spark.createDataFrame([(1, 5.0, "F"), (2, 7.0, "F"), (3, 9.0, "F")], "target_id int, value double, filing string")
    found = answers.cited_figures(targets, cited, whole, ["filing"])
    assert {r["target_id"]: (r["cell_key"], r["source"]) for r in found.collect()} == {1: ("x", "cited"), 2: ("y", "filing"), 3: (None, None)}
    assert tuple(answers.citation_summary(found).first()) == (3, 1, 1, 0.0)
