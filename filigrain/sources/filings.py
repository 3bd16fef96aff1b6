"""Listings of filings from a web service: polite requests, ticker map, paged listings; and sinks of results."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from filigrain.sources.tables import columnar_rows

#: Seconds between requests, tries, codes that are tried again, columns of a listing.
INTERVAL, TRIES, AGAIN = 0.15, 4, (429, 500, 502, 503, 504)
LISTING = ("form", "accessionNumber", "filingDate", "reportDate", "primaryDocument")
_COLUMNS = ",".join(f"{c}:array<string>" for c in LISTING)
#: A company's submissions and the older pages they name.
SUBMISSIONS = f"cik string, name string, fiscalYearEnd string, filings struct<recent:struct<{_COLUMNS}>,files:array<struct<name:string>>>"
PAGE = f"name string, block struct<{_COLUMNS}>"


class Client:
    """GET with a user agent that names a contact, at most one request an interval, and waits that double on failures
    of the service. `opener` and `sleep` can be replaced."""

    def __init__(self, agent: str, interval: float = INTERVAL, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep, clock: Callable = time.monotonic):
        if "@" not in agent:
            raise ValueError("the user agent names a contact address")
        self.agent, self.interval, self.opener, self.sleep, self.clock = agent, interval, opener, sleep, clock
        self.next = 0.0

    def get(self, url: str) -> bytes:
        for last in (False,) * (TRIES - 1) + (True,):
            self.sleep(max(0.0, self.next - self.clock()))
            self.next = self.clock() + self.interval
            try:
                with self.opener(urllib.request.Request(url, headers={"User-Agent": self.agent})) as answer:
                    return answer.read()
            except urllib.error.HTTPError as error:
                if last or error.code not in AGAIN:
                    raise
            self.interval, self.next = self.interval * 2, self.clock() + self.interval * 2
        raise AssertionError("unreachable")


def ticker_map(text: DataFrame, column: str = "value") -> DataFrame:
    """(ticker, cik) of a JSON object whose values are rows with ticker and cik_str, tickers in capitals."""
    rows = text.select(F.explode(F.map_values(F.from_json(column, "map<string,struct<cik_str:string,ticker:string,title:string>>"))).alias("r"))
    return rows.select(F.upper("r.ticker").alias("ticker"), F.col("r.cik_str").cast("int").alias("cik"))


def listed_filings(submissions: DataFrame, pages: DataFrame) -> DataFrame:
    """(ticker, page, pos and the LISTING columns) of submissions(ticker, SUBMISSIONS): recent filings are page 0, the
    pages(PAGE) that they name follow in their order."""
    recent = columnar_rows(submissions.select("ticker", F.col("filings.recent").alias("block")), "ticker", "block", list(LISTING)).withColumn("page", F.lit(0))
    named = submissions.select("ticker", F.posexplode("filings.files").alias("page", "f")).select("ticker", (F.col("page") + 1).alias("page"), F.col("f.name").alias("name"))
    older = named.join(pages, "name").select(F.struct("ticker", "page").alias("k"), "block")
    rest = columnar_rows(older, "k", "block", list(LISTING)).select("k.ticker", "k.page", "pos", *LISTING)
    return recent.select("ticker", "page", "pos", *LISTING).unionByName(rest)


def shortfall(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ticker, form, n, found): what wanted(ticker, form, n) asks for and found(ticker, form, ...) does not hold."""
    have = found.groupBy("ticker", "form").agg(F.count(F.lit(1)).alias("found"))
    return wanted.join(have, ["ticker", "form"], "left").withColumn("found", F.coalesce("found", F.lit(0))).filter("found < n")


def union_of_columns(*frames: DataFrame) -> DataFrame:
    """All rows with all columns; null where a frame lacks one."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def write_results(rows: DataFrame, path: str) -> None:
    """Rows as CSV with a header and as JSON, in two folders below path; arrays and maps are JSON text in the CSV."""
    plain = [F.to_json(F.col(f"`{c}`")).alias(c) if k.startswith(("array", "map", "struct")) else F.col(f"`{c}`") for c, k in rows.dtypes]
    rows.select(*plain).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    rows.write.mode("overwrite").json(f"{path}/json")


def markdown_table(rows: DataFrame, *order: Column) -> str:
    """A small report as a Markdown table; one line a row."""
    lines = ["| " + " | ".join(map(str, line)) + " |" for line in (rows.columns, ["---"] * len(rows.columns), *rows.orderBy(*order).collect())]
    return "\n".join(lines)


def samples(answers: DataFrame, chunks: DataFrame, n: int, chars: int, seed: int = 0, key: str = "qid") -> DataFrame:
    """n answers(key, citations: array of chunk ids, ...) in the order of a seeded hash, each with the cited texts, cut to
    `chars`, in the order of the citations."""
    drawn = answers.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(n)
    cited = drawn.select(key, F.posexplode("citations").alias("i", "chunk_id")).join(chunks.select("chunk_id", "text"), "chunk_id")
    short = F.when(F.char_length("text") > chars, F.concat(F.left("text", F.lit(chars)), F.lit(" ..."))).otherwise(F.col("text"))
    texts = cited.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", short.alias("t")))), lambda x: x["t"]).alias("texts"))
    return drawn.join(texts, key, "left")
