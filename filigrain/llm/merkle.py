"""Merkle fingerprints: phrases are hashed, paragraphs hash their phrases, sections their paragraphs, the root all
sections. Equal roots mean equal texts; where roots differ, the differing branches locate the edit. DataFrame
functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filigrain.llm.common import column_or_null, with_next

#: A phrase: up to four words, ended early by a word that closes a sentence, with the white space after it.
PHRASE = r"(?:[^\s.!?]++\s++){0,3}\S++\s*+|\s++"
#: A paragraph whose hash is 0 modulo this ends its section, so that sections move with their content.
SECTION = 4


def phrases(text: Column) -> Column:
    """array (paragraphs) of array (phrases) of 64-bit hashes; a paragraph is a line."""
    return F.transform(F.split(text, "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PHRASE), F.lit(0)), lambda x: F.xxhash64(x)))


def paragraph_hashes(leaves: Column) -> Column:
    return F.transform(leaves, lambda p: F.xxhash64(p, F.size(p)))


def section_ends(paragraphs: Column) -> Column:
    """1-based last paragraph of each section."""
    n = F.size(paragraphs)
    return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.pmod(F.element_at(paragraphs, i), F.lit(SECTION)) == 0))


def section_hashes(paragraphs: Column, ends: Column) -> Column:
    def one(end: Column, at: Column) -> Column:
        before = F.when(at == 0, F.lit(0)).otherwise(F.try_element_at(ends, at))
        return F.xxhash64(F.slice(paragraphs, before + 1, end - before))

    return F.transform(ends, one)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """df plus {name}_leaves, {name}_paragraphs, {name}_ends, {name}_sections and {name}_root of a text column."""
    df = df.withColumn(f"{name}_leaves", phrases(F.col(text)))
    df = df.withColumn(f"{name}_paragraphs", paragraph_hashes(F.col(f"{name}_leaves")))
    df = df.withColumn(f"{name}_ends", section_ends(F.col(f"{name}_paragraphs")))
    df = df.withColumn(f"{name}_sections", section_hashes(F.col(f"{name}_paragraphs"), F.col(f"{name}_ends")))
    return df.withColumn(f"{name}_root", F.sha2(F.array_join(F.transform(f"{name}_sections", lambda s: F.hex(s)), ".").cast("binary"), 256))


def codes(leaves: Column) -> Column:
    """array (paragraphs) of strings: six hexadecimal digits of each phrase hash, end to end."""
    return F.transform(leaves, lambda p: F.array_join(F.transform(p, lambda h: F.lower(F.lpad(F.hex(F.pmod(h, F.lit(1 << 24))), 6, "0"))), ""))


def fingerprint(name: str) -> Column:
    """root ':' sections joined by '/', each its paragraphs joined by ';', each its phrase codes."""
    paragraphs, ends = F.col(f"{name}_codes"), F.col(f"{name}_ends")

    def one(end: Column, at: Column) -> Column:
        before = F.when(at == 0, F.lit(0)).otherwise(F.try_element_at(ends, at))
        return F.array_join(F.slice(paragraphs, before + 1, end - before), ";")

    return F.concat(F.substring(F.col(f"{name}_root"), 1, 32), F.lit(":"), F.array_join(F.transform(ends, one), "/"))


def nodes(print_: Column) -> Column:
    """The tree that a fingerprint writes down: struct of its root and its distinct sections, paragraphs and phrases,
    each named by the codes under it."""
    body = F.substring(print_, 34, 2_000_000_000)
    sections = F.array_distinct(F.split(body, "/"))
    paragraphs = F.array_distinct(F.flatten(F.transform(sections, lambda s: F.split(s, ";"))))
    leaves = F.array_distinct(F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p, F.lit("[0-9a-f]{6}"), F.lit(0)))))
    return F.struct(F.substring(print_, 1, 32).alias("root"), sections.alias("sections"), paragraphs.alias("paragraphs"), leaves.alias("phrases"))


def likeness(a: Column, b: Column) -> Column:
    """Of two trees (see nodes), the nodes in common over those of the larger: 1 for equal roots and only for them.
    Below equal branches all is equal, so what is lost lies under the branches that differ."""
    levels = ("sections", "paragraphs", "phrases")
    common = sum((F.size(F.array_intersect(a[c], b[c])) for c in levels), F.lit(0))
    most = F.greatest(*(sum((F.size(t[c]) for c in levels), F.lit(1)) for t in (a, b)))
    return F.when(a["root"] == b["root"], 1.0).otherwise(common / most).cast("double")


def changed(a: Column, b: Column, level: str) -> Column:
    """1-based places in array a (the `level` hashes of one tree) of what array b, the other tree's, lacks."""
    lost = F.array_except(a, b)
    return F.filter(F.transform(a, lambda x, i: F.when(F.array_contains(lost, x), i + 1)), lambda i: i.isNotNull()).alias(level)


def changed_branches(df: DataFrame, a: str, b: str) -> DataFrame:
    """For trees named a and b in df (see with_tree): the 1-based sections of a that b lacks, and in those the
    paragraphs of a that b lacks. Both are empty when the roots are equal."""
    same = F.col(f"{a}_root") == F.col(f"{b}_root")
    for level in ("sections", "paragraphs"):
        found = changed(F.col(f"{a}_{level}"), F.col(f"{b}_{level}"), level)
        df = df.withColumn(f"changed_{level}", F.when(same, F.array().cast("array<int>")).otherwise(found))
    return df


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changed_sections,
    changed_paragraphs for every row.

    The edited text has the last half replaced by as much of the next document's beginning; changed_* are the 1-based
    branches of its tree that the document's tree lacks. near_* compare fingerprints as written (see likeness). A
    null text is empty; an empty text is one empty paragraph. Rows that repeat a doc_id follow each other in the order
    of their texts; null doc_ids come last. The only document of a table is its own next. Extra columns are ignored;
    an empty table gives no rows."""
    rows = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column_or_null(docs, "text", "string"), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", "text", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    for text, name in (("text", "a"), ("edited", "e"), ("next_text", "x")):
        rows = with_tree(rows, text, name)
        rows = rows.withColumn(f"{name}_codes", codes(F.col(f"{name}_leaves"))).withColumn(f"{name}_print", fingerprint(name))
        rows = rows.withColumn(f"{name}_nodes", nodes(F.col(f"{name}_print")))
    rows = changed_branches(rows, "e", "a")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.col("a_print").alias("fingerprint"), F.col("e_print").alias("edited_fingerprint"),
        likeness(F.col("a_nodes"), F.col("e_nodes")).alias("near_edited"), likeness(F.col("a_nodes"), F.col("x_nodes")).alias("near_next"),
        "changed_sections", "changed_paragraphs",
    )
