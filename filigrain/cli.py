"""Command line: `python -m filigrain.cli chunk|index|search|coverage ...` on the session of spark-submit or a local one.

Settings come from a TOML file (--config), whose [filigrain] table names the index folder, the method and the log, and
are overridden by FILIGRAIN_INDEX, FILIGRAIN_METHOD and FILIGRAIN_LOG."""

from __future__ import annotations

import argparse
import json
import os
import tomllib

from pyspark.sql import SparkSession, functions as F

from filigrain.functions import html
from filigrain.operators import coverage, questions, requests, sections
from filigrain.session import local_session
from filigrain.sources import tables

SETTINGS = {"index": None, "method": "bm25", "log": None}


def settings(path: str | None, environment: dict[str, str]) -> dict:
    """Defaults, then the file's [filigrain] table, then the environment."""
    held = {}
    if path:
        with open(path, "rb") as file:
            held = tomllib.load(file).get("filigrain", {})
    found = {k: environment.get(f"FILIGRAIN_{k.upper()}", held.get(k, default)) for k, default in SETTINGS.items()}
    if found["method"] not in requests.METHODS:
        raise ValueError(f"method is one of {requests.METHODS}")
    return found


def filters_of(options: argparse.Namespace) -> dict:
    """Request filters of the command's flags; lists are parted by commas."""
    lists = {"ticker": options.ticker, "form": options.form, "fiscal_year": options.year, "fiscal_period": options.period, "section": options.section}
    out: dict = {k: v.split(",") for k, v in lists.items() if v}
    return out | {"is_table": True} if options.tables_only else out


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="filigrain", description=__doc__)
    top.add_argument("--config")
    commands = top.add_subparsers(dest="command", required=True)
    chunk = commands.add_parser("chunk", help="filings of a manifest to chunks")
    chunk.add_argument("manifest")
    chunk.add_argument("root")
    chunk.add_argument("out")
    index = commands.add_parser("index", help="chunks to an index folder")
    index.add_argument("chunks")
    search = commands.add_parser("search", help="one request against the index")
    search.add_argument("query")
    search.add_argument("--top-k", type=int, default=requests.TOP_K)
    for flag in ("ticker", "form", "year", "period", "section"):
        search.add_argument(f"--{flag}")
    search.add_argument("--tables-only", action="store_true")
    check = commands.add_parser("coverage", help="what the filings of a manifest cover of a question")
    check.add_argument("manifest")
    check.add_argument("question")
    return top


def chunked(spark: SparkSession, manifest: str, root: str):
    """Chunks of the manifest's filings, keyed by accession."""
    filed = tables.read_filings(spark, manifest, root)
    blocks = sections.blocks_of(html.parse_html(filed, "accession"), "accession")
    made = sections.chunks(sections.sections(blocks, "accession"), "accession")
    about = [c for c in ("ticker", "cik", "company", "form", "fiscal_year", "fiscal_period", "period_of_report", "filing_date", "source_url") if c in filed.columns]
    return made.join(filed.select("accession", *about), "accession")


def precheck(spark: SparkSession, manifest: str, question: str) -> dict:
    held = tables.read_coverage(spark, manifest)
    held = held.select("ticker", F.col("company_name").alias("company"), "form", F.col("accession_number").alias("accession"), F.col("reporting_period_end").cast("date").alias("period_end"), F.col("fiscal_year").cast("int").alias("fiscal_year"), "fiscal_period")
    asked = questions.extract(spark.createDataFrame([(0, question)], "qid int, question string"), coverage.alias_table(held))
    return coverage.messages(asked, held).first().asDict()


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> dict | None:
    options = parser().parse_args(arguments)
    chosen = settings(options.config, dict(os.environ))
    spark = spark or SparkSession.getActiveSession() or local_session()
    if options.command == "chunk":
        chunked(spark, options.manifest, options.root).write.mode("overwrite").json(options.out)
        return None
    if options.command == "coverage":
        out = precheck(spark, options.manifest, options.question)
        print(json.dumps(out, default=str))
        return out
    if not chosen["index"]:
        raise ValueError("name the index folder in the settings")
    if options.command == "index":
        tables.save_index(tables.with_positions(spark.read.json(options.chunks)), chosen["index"])
        return None
    engine = requests.Engine(tables.load_index(spark, chosen["index"]), log=chosen["log"])
    out = engine.search(options.query, filters_of(options) or None, options.top_k, chosen["method"])
    print(json.dumps(out, default=str, ensure_ascii=False))
    return out


if __name__ == "__main__":
    main()
