"""Column expressions over text: tokens, counts, matching, numbers. All stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

#: The token pattern and the stop list of lexical ranking.
TOKEN = r"[a-z0-9]+(?:[.,\-&][a-z0-9]+)*"
STOP_WORDS = (
    "a an and are as at be by for from has have in is it its of on or that the this to was were "
    "will with we our us which what who how when where does did do"
).split()
#: A printed number with optional currency sign, parentheses and percent sign; dashes mean zero.
NUMBER = r"^\$?\s*\(?\s*\$?\s*(-?\d[\d,]*(?:\.\d+)?)\s*\)?\s*(%)?$"
DASH = "^[—–-]+$"
LEGAL_SUFFIX = r"\b(?:incorporated|inc|corporation|corp|company|co|limited|ltd|plc|llc|lp|holdings|group)\b\.?"


def _unaccented() -> tuple[str, str]:
    """Lower-case letters of Latin scripts that decompose (NFKD) to one ASCII letter and marks, and that letter."""
    pairs = [(c, unicodedata.normalize("NFKD", c)[0]) for c in map(chr, range(0xC0, 0x250)) if c.islower()]
    pairs = [(c, d) for c, d in pairs if d.isascii() and d != c]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


ACCENTED, UNACCENTED = _unaccented()


def tokens(text: Column) -> Column:
    """Lower-cased tokens without stop words; possessive endings are dropped."""
    low = F.replace(F.replace(F.lower(text), F.lit("’"), F.lit("'")), F.lit("'s "), F.lit(" "))
    return F.filter(F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0)), lambda t: ~t.isin(*STOP_WORDS))


def token_count(text: Column) -> Column:
    """Rough count: words times 1.33, truncated, plus one; 1 for a blank text."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return (F.floor(words * F.lit(1.33)) + 1).cast("long")


def section_matches(section: Column, allowed: list[str]) -> Column:
    """Whole-word prefix match, any of; a null section matches nothing."""
    s = F.upper(F.trim(F.regexp_replace(section, r"\s+", " ")))
    hit = F.lit(False)
    for a in allowed:
        a = " ".join(a.upper().split())
        hit = hit | (s == a) | F.startswith(s, F.lit(a + " "))
    return F.coalesce(hit, F.lit(False))


def parse_number(cell: Column) -> Column:
    """struct(value, percent) of a printed cell: parentheses and a leading minus are negative, dashes are 0."""
    t = F.replace(F.trim(cell), F.lit("\u2009"), F.lit(""))
    digits = F.nullif(F.regexp_extract(t, NUMBER, 1), F.lit(""))
    size = F.abs(F.replace(digits, F.lit(","), F.lit("")).cast("double"))
    negative = (F.contains(t, F.lit("(")) & F.contains(t, F.lit(")"))) | F.startswith(t, F.lit("-"))
    value = F.when(t.rlike(DASH), F.lit(0.0)).otherwise(F.when(negative, -size).otherwise(size))
    return F.struct(value.alias("value"), (F.regexp_extract(t, NUMBER, 2) == "%").alias("percent"))


def significant_digits(printed: Column) -> Column:
    """Digits that carry information: no sign, no leading zeros, no trailing zeros of an integer."""
    plain = F.regexp_replace(printed, "[^0-9.]", "")
    whole = F.when(F.contains(plain, F.lit(".")), F.replace(plain, F.lit("."), F.lit(""))).otherwise(F.rtrim(plain, F.lit("0")))
    return F.length(F.ltrim(whole, F.lit("0"))).cast("long")


def spellings(value: Column) -> Column:
    """Ways a figure may be printed: thousands grouped, in millions, in thousands, one decimal of millions."""
    return F.array(
        F.format_number(value.cast("long"), 0),
        F.format_number(F.floor(value / 1e6 + 0.5).cast("long"), 0),
        F.format_number(F.floor(value / 1e3 + 0.5).cast("long"), 0),
        F.format_number(value.cast("double") / 1e6, 1),
    )


def unit_spellings(value: Column, unit: Column) -> Column:
    """Ways a figure of a unit may be printed, without its sign: USD in millions, thousands and one decimal of millions;
    USD/shares with two decimals; pure as a percent with no and one decimal; others grouped."""
    v = F.abs(value.cast("double"))

    def plain(x: Column, places: int) -> Column:
        return F.replace(F.format_number(x, places), F.lit(","), F.lit(""))

    usd = F.array(F.format_number(v / 1e6, 0), F.format_number(v / 1e3, 0), F.format_number(v / 1e6, 1))
    percent = F.array(*[F.concat(plain(v * 100, p), F.lit("%")) for p in (0, 1)])
    return F.when(unit == "USD", usd).when(unit == "USD/shares", F.array(plain(v, 2))).when(unit == "pure", percent).otherwise(F.array(F.format_number(v, 0)))


def prose_numbers(text: Column) -> Column:
    """Currency and percent figures in prose; bare numbers and years are left out."""
    return F.regexp_extract_all(text, F.lit(r"\$\d[\d,]*(?:\.\d+)?|\d+(?:\.\d+)?%"), F.lit(0))


def normal_name(name: Column) -> Column:
    """Company name for matching: letters without accents, lower case, legal suffixes and punctuation but apostrophes
    dropped, blanks collapsed."""
    low = F.lower(F.replace(name, F.lit("’"), F.lit("'")))
    plain = F.translate(low, ACCENTED, UNACCENTED)
    bare = F.regexp_replace(F.regexp_replace(plain, LEGAL_SUFFIX, " "), "[^a-z0-9&' ]", " ")
    return F.trim(F.regexp_replace(bare, " +", " "))


def breadcrumb(*parts: Column) -> Column:
    """Parts joined by ' > ' without blanks, 'Unlabeled' and repeats that differ in case only."""
    keep = F.filter(F.array(*parts), lambda p: p.isNotNull() & (F.trim(p) != "") & (p != "Unlabeled"))
    low = F.transform(keep, lambda p: F.lower(p))
    return F.array_join(F.filter(keep, lambda p, i: F.array_position(low, F.lower(p)) == i + 1), " > ")


def fiscal_label(period_end: Column, year_end_month: Column, year_end_day: Column, annual: Column, tolerance: int = 10) -> Column:
    """struct(fiscal_year, fiscal_period): the year in which the fiscal year ends, ten days of tolerance, and for
    interim forms the quarter from the months since the last year end, 1 to 3."""
    end = F.make_date(F.year(period_end), year_end_month, year_end_day)
    year = F.when(period_end > F.date_add(end, tolerance), F.year(period_end) + 1).otherwise(F.year(period_end))
    months = F.pmod(F.month(period_end) - year_end_month, F.lit(12))
    quarter = F.greatest(F.lit(1), F.least(F.lit(3), F.bround(months / 3.0).cast("int")))
    return F.struct(year.cast("long").alias("fiscal_year"), F.when(annual, F.lit("FY")).otherwise(F.concat(F.lit("Q"), quarter.cast("string"))).alias("fiscal_period"))
