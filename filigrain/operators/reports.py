"""Reports over scored questions: figures and anchors found in retrieved texts, fixes of anchors, rates, comparisons of
runs, causes of misses, costs. One plan each, whatever the number of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

#: Sources whose anchors may be spread over several chunks; a region's share and its words.
SPREAD_SOURCES = ("eval_w8_review", "sec_r_page_pending_round1_chunks")
REGION_SHARE, REGION_WORDS, REGION_WORD = 0.6, 5, r"[a-z0-9][a-z0-9,.%-]{3,}"
#: Causes of a miss, the first that holds is the primary one.
CAUSES = ("cross_company", "scattered", "fusion", "anchor_problem", "no_section", "wording")


def plain(text: Column) -> Column:
    """Lower case, blanks collapsed, curly apostrophes and long dashes plain."""
    return F.lower(F.replace(F.replace(F.regexp_replace(text, r"(?U)\s+", " "), F.lit("’"), F.lit("'")), F.lit("—"), F.lit("-")))


def question_kind() -> Column:
    """What a question can be scored by, from the columns snapshot_status, route_expected, answerable, answer_type,
    n_facts, n_values and n_anchors: the first rule that holds."""
    return (
        F.when(F.col("snapshot_status") == "review_required", "excluded_filing")
        .when(F.col("route_expected") == "graph", "graph_route")
        .when(~F.col("answerable") | (F.col("answer_type") == "refusal"), "unanswerable")
        .when((F.col("answer_type") == "exact_numeric") & (F.col("n_facts") > 0) & (F.col("n_values") > 0), "number")
        .when(F.col("n_anchors") > 0, "anchored_prose")
        .otherwise("prose_no_anchor")
    )


def meta_match(spec: Column, row: dict[str, Column]) -> Column:
    """Whether a row's columns have, in any case of letters, one of the values that spec (a map of arrays) lists for each
    of its keys. A key without a column matches nothing; a null spec everything."""
    out = F.lit(True)
    for name, have in row.items():
        want = F.transform(F.try_element_at(spec, F.lit(name)), lambda v: F.upper(v))
        out = out & (want.isNull() | F.coalesce(F.array_contains(want, F.upper(have.cast("string"))), F.lit(False)))
    known = F.forall(F.map_keys(spec), lambda k: k.isin(*row))
    return F.coalesce(out & known, spec.isNull())


def evidence_hits(items: DataFrame, chunks: DataFrame, keys: tuple[str, ...] = ("ticker", "form", "fiscal_year", "fiscal_period", "section", "accession", "is_table")) -> DataFrame:
    """(qid, item, chunk_id): chunks that satisfy evidence items (qid, item, chunk_ids, spec, contains).

    A chunk named by id counts. Else it has to match the spec and contain all strings, in any case; an item that names
    ids only is met by those alone. Named chunks come by an equi join; strings are looked for only in chunks that hold
    the longest word of the item's first string, so texts are not compared pair by pair."""
    named = items.select("qid", "item", F.explode("chunk_ids").alias("chunk_id")).join(chunks.select("chunk_id"), "chunk_id").select("qid", "item", "chunk_id")
    has_strings, has_spec = F.coalesce(F.size("contains") > 0, F.lit(False)), F.coalesce(F.size("spec") > 0, F.lit(False))
    rest = items.filter(has_strings | has_spec | ~F.coalesce(F.size("chunk_ids") > 0, F.lit(False)))
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    # the first and last word of a string may be cut in it, those between stand whole in a text
    inner = F.flatten(F.transform("contains", lambda s: F.slice(words(s), 2, F.greatest(F.size(words(s)) - 2, F.lit(0)))))
    probe = F.array_max(F.transform(inner, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
    rest = rest.withColumn("_w", probe)
    low = F.lower("text")
    row = {k: F.col(k) for k in keys if k in chunks.columns}
    fits = meta_match(F.col("spec"), row) & F.forall(F.coalesce("contains", F.array().cast("array<string>")), lambda s: F.contains(low, F.lower(s)))
    wanted = F.broadcast(rest.select("_w").distinct())  # one short word an item
    tokens = chunks.select("chunk_id", F.explode(F.array_distinct(words(F.col("text")))).alias("_w")).join(wanted, "_w", "left_semi")
    probed = rest.filter("_w IS NOT NULL").join(tokens, "_w").join(chunks, "chunk_id").filter(fits)
    bare = rest.filter("_w IS NULL").join(chunks, fits)
    return named.union(probed.select("qid", "item", "chunk_id")).union(bare.select("qid", "item", "chunk_id")).distinct()


def same_filing(anchor: str, chunk: str) -> Column:
    """Ticker, form and accession of an anchor, where given, are the chunk's."""
    out = F.lit(True)
    for c in ("ticker", "form", "accession"):
        want = F.nullif(F.col(f"{anchor}.{c}"), F.lit(""))
        out = out & (want.isNull() | (want == F.coalesce(F.col(f"{chunk}.{c}"), F.lit(""))))
    return out


def _within(blob: Column):
    return lambda s: F.contains(blob, s)


def anchors_found(anchors: DataFrame, results: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """(qid, item, found_k ...) of anchors (qid, item, ticker, form, accession, contains, anchor_source) in results (qid,
    rank, ticker, form, accession, text): all strings in one of the first k chunks of the filing, or, for sources whose
    anchors are spread, each somewhere in them."""
    j = anchors.alias("a").join(results.alias("r"), (F.col("a.qid") == F.col("r.qid")) & same_filing("a", "r"))
    j = j.select("a.qid", "a.item", "rank", F.transform("contains", plain).alias("c"), plain(F.col("r.text")).alias("t"), F.coalesce(F.col("anchor_source").isin(*SPREAD_SOURCES), F.lit(False)).alias("spread"))
    j = j.withColumn("whole", F.forall("c", lambda s: F.contains("t", s)))
    out = []
    for k in ks:
        top = F.col("rank") <= k
        blob = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(top, F.struct("rank", "t")))), lambda x: x["t"]), " ")
        out.append(F.when(F.first("spread"), F.forall(F.first("c"), _within(blob))).otherwise(F.coalesce(F.bool_or(top & F.col("whole")), F.lit(False))).alias(f"found_{k}"))
    met = j.groupBy("qid", "item").agg(*out)
    empty = F.forall("contains", lambda s: F.lit(False))
    return anchors.select("qid", "item", "contains").join(met, ["qid", "item"], "left").select("qid", "item", *[F.coalesce(f"found_{k}", empty).alias(f"found_{k}") for k in ks])


def figures_found(figures: DataFrame, results: DataFrame, gold: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """(qid, loose_k, strict_k ...): whether one spelling of every figure (qid, figure, spellings) stands in the first k
    texts of a question; strictly, in those of the filings gold (qid, accession) names."""
    top = results.join(gold.select("qid", "accession").distinct().withColumn("own", F.lit(True)), ["qid", "accession"], "left")
    text = F.struct("rank", plain(F.col("text")).alias("t"))

    def blob(holds: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(holds, text))), lambda x: x["t"]), " ")

    blobs = top.groupBy("qid").agg(*[blob((F.col("rank") <= k) & own).alias(f"_{n}_{k}") for k in ks for n, own in (("loose", F.lit(True)), ("strict", F.coalesce("own", F.lit(False))))])
    names = [f"{n}_{k}" for k in ks for n in ("loose", "strict")]
    j = figures.join(blobs, "qid", "left")
    shown = [F.bool_and(F.coalesce(F.exists(F.transform("spellings", plain), _within(F.col(f"_{n}"))), F.lit(False))).alias(n) for n in names]
    return j.groupBy("qid").agg(*shown)


def rates(rows: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Per keys and metric: {metric} (mean to three digits, nulls left out) and n_{metric}."""
    out = [x for m in metrics for x in (F.round(F.avg(F.col(m).cast("double")), 3).alias(m), F.count(m).alias(f"n_{m}"))]
    return rows.groupBy(*keys).agg(*out)


def fixed_anchors(anchors: DataFrame, fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchors after the fixes, with anchor_fix; counts by outcome). fixes: qid, action (drop, remove, narrow),
    rag_anchor and suggested_anchor, strings parted by bars. An anchor is meant when its strings are the fix's."""
    def parts(c: Column) -> Column:
        return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[|]"), lambda s: F.trim(s)), lambda s: s != "")

    f = fixes.select("qid", "action", parts(F.col("rag_anchor")).alias("_old"), F.contains(F.coalesce("suggested_anchor", F.lit("")), F.lit("|")).alias("_two"), parts(F.col("suggested_anchor")).alias("_new"))
    a = anchors.withColumn("_old", F.transform("contains", lambda s: F.trim(s)))
    here = a.select("qid", "_old").distinct().withColumn("_here", F.lit(True))
    known = anchors.select("qid").distinct().withColumn("_known", F.lit(True))
    outcome = (
        F.when(F.col("action") == "drop", "dropped")
        .when(F.col("_here").isNull(), F.concat(F.col("action"), F.lit(" already applied")))
        .when(F.col("action") == "remove", "removed")
        .when((F.col("action") == "narrow") & F.col("_two"), "narrowed")
        .otherwise("narrow pending")
    )
    told = f.join(known, "qid", "left_semi").join(here, ["qid", "_old"], "left").withColumn("outcome", outcome)
    counts = told.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    own = told.filter(F.col("outcome").isin("removed", "narrowed", "narrow pending")).groupBy("qid", "_old").agg(F.max_by(F.struct("outcome", "_new"), F.col("outcome") == "removed").alias("_f"))
    j = a.join(own, ["qid", "_old"], "left").filter(~F.coalesce(F.col("_f.outcome") == "removed", F.lit(False)))
    narrowed = F.col("_f.outcome") == "narrowed"
    j = j.withColumn("contains", F.when(narrowed, F.col("_f._new")).otherwise(F.col("contains"))).withColumn("anchor_fix", F.col("_f.outcome"))
    return j.select(*anchors.columns, "anchor_fix"), counts


def gains_losses(scores: DataFrame, run: str, base: str, metric: str) -> DataFrame:
    """Per run other than base: gained and lost questions against it, as sorted arrays, and their numbers."""
    b = scores.filter(F.col(run) == base).select("qid", F.col(metric).cast("double").alias("_base"))
    j = scores.filter(F.col(run) != base).join(b, "qid").withColumn("_d", F.col(metric).cast("double") - F.col("_base"))
    sides = [F.array_sort(F.collect_list(F.when(s, F.col("qid")))).alias(n) for n, s in (("gained", F.col("_d") > 0), ("lost", F.col("_d") < 0))]
    out = j.groupBy(run).agg(*sides)
    return out.select(run, "gained", "lost", F.size("gained").cast("long").alias("n_gained"), F.size("lost").cast("long").alias("n_lost"))


def parity(a: DataFrame, b: DataFrame, top_k: int) -> DataFrame:
    """(qid, common, overlap) of two ranked lists (qid, rank, id): common ids of the first top_k over the longer list's
    length, at most top_k."""
    x, y = (d.filter(F.col("rank") <= top_k).groupBy("qid").agg(F.collect_set("id").alias(n)) for d, n in ((a, "x"), (b, "y")))
    none = F.array().cast(dict(a.dtypes)["id"].join(("array<", ">")))
    j = x.join(y, "qid", "full").select("qid", F.coalesce("x", none).alias("x"), F.coalesce("y", none).alias("y"))
    common, longest = F.size(F.array_intersect("x", "y")), F.greatest(F.size("x"), F.size("y"))
    return j.select("qid", common.cast("long").alias("common"), (common / F.greatest(F.lit(1), F.least(longest, F.lit(top_k)))).alias("overlap"))


def parity_passes(recalls: DataFrame, controls: bool, most: float = 0.02) -> DataFrame:
    """One row (n, left, right, delta, passed) of recalls (qid, left, right): the means differ by `most` at most, and the
    controls (same version, vectors and number of chunks) hold."""
    out = recalls.agg(F.count(F.lit(1)).alias("n"), F.avg("left").alias("left"), F.avg("right").alias("right")).withColumn("delta", F.col("right") - F.col("left"))
    return out.withColumn("passed", F.lit(controls) & (F.abs("delta") <= most))


def causes(misses: DataFrame, anchors: DataFrame) -> DataFrame:
    """(qid, primary, causes) of misses (qid, n_tickers, bm25_hit, dense_hit) from anchors (qid, item, chunks, sections):
    where each anchor's text was found among the allowed chunks. No found chunk holds all anchors: scattered, if their
    first chunks differ; one method alone finds it: fusion; an anchor in no chunk: anchor_problem; found chunks without
    section: no_section; none of these: wording."""
    found = F.size("chunks") > 0
    per = anchors.groupBy("qid").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(found).alias("_located"),
        F.collect_list(F.when(found, F.col("chunks"))).alias("_lists"), F.count_distinct(F.when(found, F.get("chunks", 0))).alias("_firsts"),
        F.bool_and(F.when(found, ~F.exists("sections", lambda s: s != ""))).alias("_bare"),
    )
    common = F.aggregate(F.slice("_lists", 2, 1 << 30), F.get("_lists", 0), lambda s, x: F.array_intersect(s, x))
    together = (F.col("_located") > 0) & (F.size(common) > 0)
    j = misses.join(per, "qid", "left")
    holds = (F.col("n_tickers") > 1, ~together & (F.col("_firsts") >= 2), F.col("bm25_hit") | F.col("dense_hit"), F.col("_located") < F.col("_n"), (F.col("_located") > 0) & F.col("_bare"))
    listed = F.array_compact(F.array(*[F.when(h, F.lit(c)) for h, c in zip(holds, CAUSES)]))
    listed = F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(CAUSES[-1])))
    return j.select("qid", F.get(listed, 0).alias("primary"), listed.alias("causes"))


def in_region(text: Column, region: Column) -> Column:
    """Whether a text of more than five distinct words of four letters or more has 60 percent of them in the region."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(REGION_WORD), F.lit(0)))
    own = words(text)
    return (F.size(own) > REGION_WORDS) & (F.size(F.array_intersect(own, words(region))) >= F.size(own) * F.lit(REGION_SHARE) - 1e-9)


def by_groups(scores: DataFrame, keys: list[str], groups: dict[str, Column], metrics: list[str]) -> DataFrame:
    """Means of metrics per keys and group, where a row counts once for each of its groups and for ALL."""
    own = [F.coalesce(c, F.lit("?")) if not name else F.concat(F.lit(f"{name}="), F.coalesce(c, F.lit("?"))) for name, c in groups.items()]
    rows = scores.withColumn("group", F.explode(F.array(*own, F.lit("ALL"))))
    return rows.groupBy(*keys, "group").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 3).alias(m) for m in metrics])


def costs(runs: DataFrame, price_in: float, price_out: float, accuracy: str) -> DataFrame:
    """runs (run, in_tokens, out_tokens per question, ...) plus usd_per_1k and slope: the gain of accuracy over the cheapest
    run per additional dollar, null for runs that cost as much."""
    usd = (F.col("in_tokens") * price_in + F.col("out_tokens") * price_out) / 1000.0
    rows = runs.withColumn("usd_per_1k", usd)
    base = rows.agg(F.min_by(F.struct("usd_per_1k", F.col(accuracy).alias("a")), F.struct("usd_per_1k", "run")).alias("_b"))
    more = F.col("usd_per_1k") - F.col("_b.usd_per_1k")
    return rows.crossJoin(F.broadcast(base)).withColumn("slope", F.when(more > 1e-9, (F.col(accuracy) - F.col("_b.a")) / more)).drop("_b")  # base is one row


def cheapest_meeting(priced: DataFrame, target: float, *metrics: str, run: str = "run", cost: str = "usd_per_1k", by: tuple[str, ...] = (), order: Column | None = None) -> DataFrame:
    """Per metric (and `by`) the cheapest run whose metric reaches the target, and the least cost of those; null if none
    does. `order` is what the run is chosen by, if that is not the cost itself; ties go to the first run."""
    best = []
    for m in metrics:
        rank = F.when(F.col(m) >= target, F.struct((F.col(cost) if order is None else order).alias("o"), F.col(run)))
        best += [F.min_by(run, rank).alias(f"{m}_run"), F.min(F.when(F.col(m) >= target, F.col(cost))).alias(f"{m}_cost")]
    return priced.groupBy(*by).agg(*best)


def threshold_counts(rows: DataFrame, value: Column, thresholds: list[float], hit: Column) -> DataFrame:
    """(threshold, flagged, caught): rows at or below each threshold, and how many of them `hit` marks."""
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    rows = rows.select(value.alias("_v"), hit.alias("_h"), t)
    low = F.col("_v") <= F.col("threshold")
    return rows.groupBy("threshold").agg(F.count_if(low).alias("flagged"), F.count_if(low & F.coalesce("_h", F.lit(False))).alias("caught"))


def status_counts(rows: DataFrame, by: str, status: Column, states: list[str]) -> DataFrame:
    """by x states: how many rows of each status; 0 where none."""
    return rows.withColumn("_s", status).groupBy(by).pivot("_s", states).count().fillna(0)


def latest(rows: DataFrame, key: str, order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key, with their place rn."""
    return rows.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order)).cast("long")).filter(F.col("rn") <= n)


def chunk_diagnostics(chunks: DataFrame, by: list[str], n_tokens: str, text: str, most: int = 512) -> DataFrame:
    """Per group: n chunks, how many are over `most` tokens, the longest, and the share of table cells that are empty."""
    rows = F.filter(F.split(F.col(text), "\n"), lambda x: F.startswith(F.trim(x), F.lit("|")))
    cells = F.flatten(F.transform(rows, lambda r: F.transform(F.split(F.btrim(F.trim(r), F.lit("|")), "[|]"), lambda c: F.trim(c))))
    empty, size = F.size(F.filter(cells, lambda c: c == "")), F.size(cells)
    longest = F.max(n_tokens).alias("longest")
    out = chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(n_tokens) > most).alias("long"), longest, F.sum(empty).alias("_e"), F.sum(size).alias("_c"))
    return out.withColumn("empty_cells", F.round(F.try_divide("_e", "_c"), 4)).drop("_e", "_c")


def cut_boundaries(chunks: DataFrame, group: list[str], seq: str, text: str, table: str | None = None) -> DataFrame:
    """chunks plus mid_word: the one before it in its group ends with a letter, and mid_table: both are table text."""
    w = W.partitionBy(*group).orderBy(seq)
    last = F.substring(F.lag(text).over(w), -1, 1)
    tables = F.lag(table).over(w) & F.col(table) if table else F.lit(False)
    return chunks.withColumns({"mid_word": F.coalesce(last.rlike("^[a-z]$"), F.lit(False)), "mid_table": F.coalesce(tables, F.lit(False))})
