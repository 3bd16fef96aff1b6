import datetime
import difflib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from filigrain.functions import text as T
from filigrain.operators import coverage, evaluate, expand, fusion


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_numbers(spark):
    for printed, value, percent in (("$15,089", 15089.0, False), ("(623)", -623.0, False), ("—", 0.0, False), ("12.5%", 12.5, True), ("-4", -4.0, False), ("n/a", None, False)):
        got = one(spark, T.parse_number(F.lit(printed)))
        assert (got["value"], got["percent"]) == (value, percent), printed


def test_spellings_by_unit(spark):
    cases = {("USD", 12_345_678.0): ["12", "12,346", "12.3"], ("pure", 0.1234): ["12%", "12.3%"], ("shares", 1234567.0): ["1,234,567"]}
    cases[("USD/shares", -1234.565)] = [f"{1234.565:.2f}"]
    for (unit, value), want in cases.items():
        assert one(spark, T.unit_spellings(F.lit(value), F.lit(unit))) == want
    assert one(spark, T.spellings(F.lit(12_345_678.0)))[3] == "12.3"


def test_provenance(spark):
    results = spark.createDataFrame([(1, 1, 7), (1, 2, 8), (1, 3, 9), (2, 1, 7)], "qid long, rank int, pos long")
    hits = spark.createDataFrame([(1, 1, 8), (2, 1, 7), (3, 1, None), (4, 1, None)], "qid long, item long, pos long")
    expected = spark.createDataFrame([(1, 7), (1, 9), (1, 99), (3, 7), (2, None)], "qid long, pos long")
    got = {r["qid"]: (r["provenance_2"], r["provenance_5"]) for r in evaluate.score(results, hits, (2, 5), expected).collect()}
    assert got == {1: (0.5, 0.6667), 2: (0.0, 0.0), 3: (None, None), 4: (None, None)}


def test_section_prefix(spark):
    for section, hit in (("Part I Item 2", True), ("Part II Item 1", False), ("part  i", True), (None, False)):
        assert one(spark, T.section_matches(F.lit(section).cast("string"), ["Part I"])) is hit


def test_breadcrumb(spark):
    assert one(spark, T.breadcrumb(F.lit("Item 1"), F.lit("ITEM 1"), F.lit("Unlabeled"), F.lit("Debt"))) == "Item 1 > Debt"


def test_blank_text_counts_one_token(spark):
    assert one(spark, T.token_count(F.lit(""))) == 1


def test_osa():
    assert coverage.osa("mcirosoft", "microsoft") == 1
    assert coverage.osa("abc", "abcdef") == 99


def test_resolve(spark):
    aliases = spark.createDataFrame([("Microsoft Corporation", "MSFT"), ("Netflix", "NFLX")], "alias string, ticker string")
    names = spark.createDataFrame([("msft",), ("Mcirosoft Corp.",), ("netflix inc",), ("zzz",)], "name string")
    got = {r["name"]: (r["ticker"], r["match"]) for r in coverage.resolve(names, aliases).collect()}
    assert got == {"msft": ("MSFT", "ticker"), "Mcirosoft Corp.": ("MSFT", "fuzzy"), "netflix inc": ("NFLX", "alias"), "zzz": (None, None)}


def test_resolve_by_ratio(spark):
    """The ratio comes before the edit distance, reaches further than two edits and keeps short aliases out."""
    aliases = [("International Business Machines", "IBM"), ("Internatl Busines Machine", "IBX"), ("Parker Hannifin", "PH"), ("Netapp", "NTAP"), ("Nike", "NKE"), ("Apple", "AAPL")]
    names = ["Internationel Bussiness Mashine", "Parker Hanifin Corporate", "Nikes", "Netpap", "Aplpe", "Appel", "Mapple", "zzzzz"]

    def want(name):
        close = [(-difflib.SequenceMatcher(None, name, a).ratio(), a, t) for a, t in ((a.lower(), t) for a, t in aliases) if len(a) >= 5]
        if min(close)[0] <= -0.84:
            return min(close)[2]
        edits = [(coverage.osa(name, a), a, t) for _, a, t in close]
        return min(edits)[2] if min(edits)[0] <= (1 if len(name) <= 7 else 2) else None

    got = {r["name"]: r["ticker"] for r in coverage.resolve(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(aliases, "alias string, ticker string")).collect()}
    assert got == {n: want(n.lower()) for n in names}
    assert got["Internationel Bussiness Mashine"] == "IBM" and got["Nikes"] is None and got["Netpap"] == "NTAP"


@pytest.mark.parametrize("combine", ["product", "independent"])
def test_coverage_rules(spark, combine):
    """Against the rules written as loops over every target and filing."""
    D = datetime.date
    filings = [("A", "10-K", "a1", D(2024, 2, 29), 2024, "FY"), ("A", "10-Q", "a2", D(2023, 5, 31), 2023, "Q1"), ("A", "10-Q", "a3", D(2024, 8, 31), 2025, "Q2"), ("B", "10-K", "b1", D(2025, 12, 31), 2025, "FY"), ("B", "10-Q", "b2", None, 2025, "Q3"), ("C", "10-Q", "c1", D(2025, 3, 31), 2025, "Q1")]
    asks = {
        1: (["A"], None, [2023], None, None), 2: (["A", "B"], ["10k", "10-Q"], [2024], ["Q4", "Q2"], None), 3: (["A"], ["10-Q"], None, None, [D(2023, 2, 28), D(2022, 2, 28), D(2022, 2, 20)]),
        4: (["C", "B"], None, None, ["Q1", "FY"], [D(2024, 12, 31), D(2025, 3, 26)]), 5: (["B"], None, None, None, None), 6: ([], None, [2024], None, None), 7: (["Z"], None, [2024, 2025], None, None), 8: (["A"], ["10-K"], [2023], ["Q4"], None), 9: (["B"], None, [2024], ["FY"], []),
    }
    unresolved = {6: ["Tesla"], 5: ["Tesla"]}

    def back(d):
        return d.replace(year=d.year - 1, day=28 if (d.month, d.day) == (2, 29) else d.day)

    def match(f, form, fy, fp, pe):
        t, own, _, end, year, period = f
        if form and own != form or fy is not None and year != fy and not (year == fy + 1 and fp in (None, period)) or fp and period != fp and (fp, period) != ("Q4", "FY"):
            return False
        if pe is None:
            return True
        if end is None:
            return False
        dates, last = [end, back(end)], max((g[3] for g in filings if g[0] == t and g[1] == "10-K"), default=None)
        if own == "10-Q" and last:
            while last > end:
                last = back(last)
            dates.append(last)
        return any(abs((d - pe).days) <= 7 for d in dates)

    want = {}
    for q, (tickers, forms, years, periods, days) in asks.items():
        forms = [x.upper().replace("10K", "10-K") for x in forms or []]
        if combine == "product":
            plan = list(itertools.product(forms or [None], years or [None], periods or [None], days or [None]))
        else:
            plan = [(None, None, None, d) for d in days or []] + [(None, y, p, None) for y, p in itertools.product(years or [None], periods or [None]) if y or p] + [(f, None, None, None) for f in forms]
            plan = plan or [(None,) * 4]
        for t in tickers:
            for p in plan:
                want[(q, t, *p)] = sorted(f[2] for f in filings if f[0] == t and match(f, *p))
    kind = "array<string>"
    requests = spark.createDataFrame([(q, *v, unresolved.get(q)) for q, v in asks.items()], f"qid long, tickers {kind}, forms {kind}, fiscal_years array<int>, fiscal_periods {kind}, period_ends array<date>, unresolved {kind}")
    df = spark.createDataFrame(filings, "ticker string, form string, accession string, period_end date, fiscal_year int, fiscal_period string")
    rows = coverage.targets(requests, df, combine).collect()
    assert len(rows) == len(want) and {tuple(r)[:6]: r["accessions"] for r in rows} == want
    assert all((r["status"] == "hit") == bool(r["accessions"]) for r in rows)
    status = {r["qid"]: r["status"] for r in coverage.check(requests, df, combine).collect()}
    assert status[1] == "all_hit" and status[5] == "partial" and status[6] == "unresolved" and status[7] == "none"


def test_last_year_end_of_a_10q(spark):
    D = datetime.date
    f = spark.createDataFrame([("A", "10-K", D(2025, 6, 30)), ("A", "10-Q", D(2024, 9, 30))], "k string, form string, e date")
    asked = spark.createDataFrame([("A", D(2024, 7, 2))], "k string, d date")
    assert [r["form"] for r in coverage.date_hits(asked, f.filter("form = '10-Q'").union(f.filter("form = '10-K'")), "k", "d", "e", form="form").orderBy("form").collect()] == ["10-K", "10-Q"]


def test_rrf_ties_fall_to_position(spark):
    a = spark.createDataFrame([(1, 7, 1), (1, 3, 2)], "qid long, pos long, rank int")
    b = spark.createDataFrame([(1, 3, 1), (1, 7, 2)], "qid long, pos long, rank int")
    assert [r["pos"] for r in fusion.rrf({"a": a, "b": b}).orderBy("rank").collect()] == [3, 7]


def test_as_of(spark):
    left = spark.createDataFrame([(1, 5, "x"), (1, 1, "y")], "g int, at int, id string")
    right = spark.createDataFrame([(1, 5, "h5"), (1, 3, "h3")], "g int, at int, h string")
    assert {r["id"]: r["h"] for r in expand.as_of(left, right, "g", "at", "h").collect()} == {"x": "h5", "y": None}


def test_kappa_of_equal_labels(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 1)], "a int, b int")
    assert evaluate.kappa(df, "a", "b").first()["kappa"] == 1.0


def test_percentiles_by_brackets(spark):
    """Large and small keys, ties and nulls, against the sorted list."""
    rng = random.Random(3)
    rows = [(k, rng.choice([None, round(rng.gauss(0, 9), 1)])) for k, n in (("a", 3000), ("b", 37), ("c", 1), ("d", 2)) for _ in range(n)] + [("c", 5.0), ("d", None)]
    qs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in evaluate.nearest_index_percentile(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", qs, accuracy=100).collect()}
    for k in "abcd":
        own = sorted(v for key, v in rows if key == k and v is not None)
        assert not own or {n: got[k][n] for n in qs} == {n: own[round(q * (len(own) - 1))] for n, q in qs.items()}
