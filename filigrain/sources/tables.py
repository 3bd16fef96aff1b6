"""Sources and sinks: chunk files, catalogues, manifests, gold sets, caches, index folders, databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from filigrain.operators import lexical
from filigrain.operators.requests import Index, RetrievalUnavailableError
from filigrain.session import written

#: The stored chunk's columns; gold states that count.
CHUNK = (
    "chunk_id string, ticker string, cik string, company string, form string, fiscal_year int, fiscal_period string, period_of_report string, filing_date string, accession string, "
    "section string, section_title string, is_table boolean, seq int, n_tokens int, source_url string, chunking_version string, extraction_version string, text string"
)
GOLD_STATES = ("labeled", "reviewed")
#: A labelled question. Filter and evidence values that may be single or lists are read as arrays.
EVIDENCE_KEYS = ("ticker", "form", "fiscal_year", "fiscal_period", "section", "accession", "accession_number", "is_table")
GOLD = "qid string, question string, status string, tier string, filters map<string,string>, gold struct<chunk_ids:array<string>,evidence:array<map<string,string>>>, expected map<string,string>"


def read_chunks(spark: SparkSession, path: str, schema: str = CHUNK) -> DataFrame:
    """Chunks of JSON lines (blank lines skipped); an empty
    file is an error."""
    rows = spark.read.schema(schema).json(path)
    if rows.limit(1).count() == 0:
        raise ValueError(f"no chunks in {path}")
    return rows


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Parquet, one folder a form, so that filters prune files; the number of files follows from the input."""
    chunks.write.mode("overwrite").partitionBy("form").parquet(path)


def keep_first(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def read_catalogue(spark: SparkSession, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    """A CSV catalogue of chunks: quoted line breaks, a byte order mark, other column names; of rows with one chunk_id
    the first of the file stays."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    rows = rows.withColumnsRenamed({c: c.lstrip("﻿") for c in rows.columns}).withColumn("_at", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    names = {"accession_number": "accession", "company_name": "company", "reporting_period_end": "period_of_report"} | (renames or {})
    return keep_first(rows, ["chunk_id"], F.col("_at")).drop("_at").withColumnsRenamed({k: v for k, v in names.items() if k in rows.columns})


def read_filings(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """Manifest rows with the HTML of their local_path below root."""
    rows = spark.read.json(manifest)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.element_at(F.split("path", "/"), -1).alias("_file"), "path", F.decode("content", "UTF-8").alias("html"))
    own = rows.withColumn("_file", F.element_at(F.split("local_path", "/"), -1))
    return own.join(files, "_file").filter(F.endswith("path", F.concat(F.lit("/"), "local_path"))).drop("_file", "path")


def newest_filings(listed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first n filings of each (ticker, form) of wanted(ticker, form, n); listed(ticker, form, page, pos, ...) is
    in the order newest first, forms match exactly, an absent report date falls back to the filing date."""
    rows = listed.join(F.broadcast(wanted) if wanted.limit(100_001).count() <= 100_000 else wanted, ["ticker", "form"])
    rows = rows.withColumn("_r", F.row_number().over(W.partitionBy("ticker", "form").orderBy("page", "pos"))).filter("_r <= n").drop("_r", "n")
    return rows.withColumn("period_of_report", F.coalesce(F.nullif("report_date", F.lit("")), "filing_date"))


def columnar_rows(blocks: DataFrame, key: str, block: str, names: list[str]) -> DataFrame:
    """Rows of a struct of equally long arrays, with pos."""
    zipped = F.arrays_zip(*(F.col(f"{block}.{c}").alias(c) for c in names))
    return blocks.select(key, F.posexplode(zipped).alias("pos", "r")).select(key, "pos", *(F.col(f"r.{c}").alias(c) for c in names))


def _listed(value: Column) -> Column:
    """A JSON value as an array of strings: the items of a list, else the value alone; null stays null."""
    return F.when(F.startswith(F.trim(value), F.lit("[")), F.from_json(value, "array<string>")).otherwise(F.when(value.isNotNull(), F.array(value)))


def _lists(values: Column) -> Column:
    return F.transform_values(values, lambda _, v: _listed(v))


def read_gold(spark: SparkSession, path: str, drafts: bool = False, schema: str = GOLD) -> DataFrame:
    """Gold questions of JSON lines: blank and // lines skipped, state labeled by default, with chunk ids or evidence.

    Columns qid, question, status, tier, filters and expected (maps of arrays), chunk_ids, and evidence: an array of
    (item, chunk_ids, spec, contains), where spec is a map of arrays over EVIDENCE_KEYS."""
    lines = spark.read.text(path).filter(~F.ltrim("value").startswith("//") & (F.trim("value") != ""))
    rows = lines.select(F.from_json("value", schema).alias("q")).select("q.*").withColumn("status", F.coalesce("status", F.lit("labeled")))
    rows = rows.filter(F.col("status").isin(*GOLD_STATES, *(["draft"] if drafts else [])))
    rows = rows.filter((F.coalesce(F.size("gold.chunk_ids"), F.lit(0)) > 0) | (F.coalesce(F.size("gold.evidence"), F.lit(0)) > 0))

    def item(e: Column, i: Column) -> Column:
        lists = _lists(e)
        get = lambda k: F.try_element_at(lists, F.lit(k))
        spec = F.map_filter(lists, lambda k, v: k.isin(*EVIDENCE_KEYS) & v.isNotNull())
        return F.struct(i.alias("item"), get("chunk_ids").alias("chunk_ids"), F.when(F.size(spec) > 0, spec).alias("spec"), get("contains").alias("contains"))

    return rows.select("qid", "question", "status", "tier", _lists(F.col("filters")).alias("filters"), _lists(F.col("expected")).alias("expected"), F.col("gold.chunk_ids").alias("chunk_ids"), F.transform("gold.evidence", item).alias("evidence"))


def evidence_items(gold: DataFrame) -> DataFrame:
    """(qid, item, chunk_ids, spec, contains) of read gold questions; their chunk ids alone are an item of their own."""
    own = gold.filter(F.size("chunk_ids") > 0).select("qid", F.lit(-1).alias("item"), "chunk_ids", F.lit(None).cast("map<string,array<string>>").alias("spec"), F.lit(None).cast("array<string>").alias("contains"))
    return gold.select("qid", F.explode("evidence").alias("e")).select("qid", "e.*").unionByName(own)


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of filings; rows whose validation is set and not passed are left out."""
    rows = spark.read.option("header", True).csv(path)
    state = F.nullif(F.trim("validation_status"), F.lit(""))
    return rows.filter(state.isNull() | (F.lower(state) == "passed"))


def coverage_of(chunks: DataFrame) -> DataFrame:
    """One filing per accession: its first chunk's columns."""
    return keep_first(chunks, ["accession"], F.col("pos") if "pos" in chunks.columns else F.col("chunk_id"))


def freeze_check(frozen: DataFrame, chunks: DataFrame, sets: int = 1) -> DataFrame:
    """(key, state, n) of every key of the freeze list frozen(key) and of chunks(key, set_id): present, extra, missing or
    set_mismatch, where a filing has more than `sets` processing sets; n counts its chunks."""
    have = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("set_id").alias("_sets"))
    j = frozen.select("key", F.lit(True).alias("_frozen")).join(have, "key", "full")
    state = F.when(F.col("_frozen").isNull(), "extra").when(F.col("n").isNull(), "missing").when(F.col("_sets") > sets, "set_mismatch").otherwise("present")
    return j.select("key", state.alias("state"), F.coalesce("n", F.lit(0)).alias("n"))


def read_answers(spark: SparkSession, path: str, schema: str, key: str, at: str) -> DataFrame:
    """A cache of JSON lines: broken lines are left out, of equal keys the last by `at` counts."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), at).alias("r")).select("r.*")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def new_texts(chunks: DataFrame, cache: DataFrame, text: str = "text") -> DataFrame:
    """(hash, text) of texts that the cache(hash, ...) lacks, each once."""
    return chunks.select(F.sha1(F.col(text)).alias("hash"), F.col(text).alias("text")).dropDuplicates(["hash"]).join(cache.select("hash"), "hash", "left_anti")


def read_database(spark: SparkSession, url: str, query: str, fallback: str | None = None, split: tuple[str, int, int, int] | None = None, first: str = "SET TRANSACTION READ ONLY", **options: str) -> DataFrame:
    """A JDBC query, 2,000 rows a fetch, after a `first` statement in each session (by default for read-only transactions); `split` (column, low, high, parts) reads in
    parallel. A query that is not permitted is replaced by the fallback."""

    def load(sql: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({sql}) q").option("fetchsize", "2000").options(**options)
        reader = reader.option("sessionInitStatement", first) if first else reader
        if split:
            for name, value in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split):
                reader = reader.option(name, str(value))
        return reader.load()

    if fallback is None:
        return load(query)
    try:
        return load(query)
    except Exception as error:  # the driver's own class differs by database
        if "permission" not in str(error).lower():
            raise
        return load(fallback)


def with_positions(chunks: DataFrame, order: str = "chunk_id") -> DataFrame:
    """chunks with pos, gapless places in the order of a column. The sorted ranges are written once, as a range read a
    second time could be cut elsewhere; then they are counted, and every row adds what stands before its range."""
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = chunks.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id())
    rows = written(ranges.withColumns({"_part": F.shiftright("_id", 33), "_i": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id"), "positions")
    base = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_base", base).select("_part", "_base")
    return rows.join(F.broadcast(counts), "_part").withColumn("pos", F.col("_base") + F.col("_i")).drop("_part", "_i", "_base")  # counts: a row a partition


def version_of(chunks: DataFrame) -> str:
    """Changes if and only if an id or text does; needs no order."""
    digest = F.sum(F.xxhash64("chunk_id", "text").cast("decimal(38,0)"))
    row = chunks.agg(F.count(F.lit(1)).alias("n"), digest.alias("d")).first()
    return f"{row['n']}-{int(row['d'] or 0) & (2**64 - 1):016x}"


def save_index(chunks: DataFrame, path: str, vectors: DataFrame | None = None) -> None:
    """chunks(pos, chunk_id, text, ...) with the lexical tables and, if given, vectors(pos, embedding). Postings lie
    clustered by term, so that a query reads few files' row groups."""
    if chunks.groupBy("chunk_id").count().filter("count > 1").limit(1).count():
        raise ValueError("chunk_id repeats")
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    stored = chunks.sparkSession.read.parquet(f"{path}/chunks")
    built = lexical.build(stored)
    built.postings.repartitionByRange("term").sortWithinPartitions("term", "pos").write.mode("overwrite").parquet(f"{path}/postings")
    chunks.sparkSession.read.parquet(f"{path}/postings").groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(f"{path}/terms")
    built.corpus.withColumn("version", F.lit(version_of(stored))).write.mode("overwrite").parquet(f"{path}/corpus")
    if vectors is not None:
        vectors.write.mode("overwrite").parquet(f"{path}/vectors")


def load_index(spark: SparkSession, path: str, expected: str | None = None) -> Index:
    """The index of a folder; RetrievalUnavailableError when it is missing or of another version than expected."""
    from pyspark.errors import AnalysisException

    try:
        tables = {t: spark.read.parquet(f"{path}/{t}") for t in ("chunks", "postings", "terms", "corpus")}
    except AnalysisException as error:
        raise RetrievalUnavailableError(f"no index in {path}") from error
    try:
        vectors = spark.read.parquet(f"{path}/vectors")
    except AnalysisException:
        vectors = None
    version = tables["corpus"].first()["version"]
    if expected and version != expected:
        raise RetrievalUnavailableError(f"index version {version}, expected {expected}")
    return Index(tables["chunks"], lexical.LexicalIndex(tables["postings"], tables["terms"], tables["corpus"].drop("version")), vectors, version)


def same_vectors(a: DataFrame, b: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row: missing (ids in one only) and moved (vectors further apart than the tolerance)."""
    both = a.select("pos", F.col("embedding").alias("x")).join(b.select("pos", F.col("embedding").alias("y")), "pos", "full_outer")
    gap = F.array_max(F.zip_with("x", "y", lambda p, q: F.abs(p.cast("double") - q.cast("double"))))
    return both.agg(F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("missing"), F.count_if(gap > tolerance).alias("moved"))


def pinned(spark: SparkSession, **views: str) -> DataFrame:
    """The corpus query: pinned ids of two kinds, joined to what they belong to and, where there is one, to a first large
    line. SQL with a common table expression, as a database would be asked; `views` name the tables."""
    return spark.sql(
        """
        WITH pins AS (
          SELECT o_orderkey FROM {orders} WHERE o_orderpriority = '1-URGENT'
          UNION ALL
          SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'
        ), large AS (
          SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM {lineitem} WHERE l_quantity > 40 GROUP BY l_orderkey
        )
        SELECT o.o_orderkey, c_name, n_name, l_linenumber
        FROM pins JOIN {orders} o ON pins.o_orderkey = o.o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        LEFT JOIN large ON l_orderkey = o.o_orderkey
        """.format(**views)
    )


def survey(nation: DataFrame, supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """A survey by region with correlated scalar sub-queries, which Catalyst turns into joins."""
    spark = nation.sparkSession
    for name, df in (("nation", nation), ("supplier", supplier), ("customer", customer)):
        df.createOrReplaceTempView(f"surveyed_{name}")
    return spark.sql(
        """
        WITH n AS (
          SELECT n_regionkey, count(*) AS nations, listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name) AS names FROM surveyed_nation GROUP BY n_regionkey
        )
        SELECT n_regionkey, nations, names,
          (SELECT count(DISTINCT s_suppkey) FROM surveyed_supplier JOIN surveyed_nation m ON s_nationkey = m.n_nationkey WHERE m.n_regionkey = n.n_regionkey) AS suppliers,
          (SELECT count(*) FROM surveyed_customer JOIN surveyed_nation m ON c_nationkey = m.n_nationkey WHERE m.n_regionkey = n.n_regionkey AND c_acctbal < 0) AS debtors
        FROM n
        """
    )
