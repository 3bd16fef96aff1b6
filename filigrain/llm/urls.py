"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees are trained from labelled URLs (url, label): a table of them, or else those that the rules decide. No
feature holds a label, so a score says what a URL looks like and not which rule came near. Everything is DataFrame
functions and Spark's own tree learner; there is no Python on the rows."""

from __future__ import annotations

from collections import namedtuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from filigrain.llm.common import column_or_null, written

Rule = namedtuple("Rule", "verdict host path")
#: The rules of the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: Distinct labelled URLs that training reads at most, in the order of a hash; each weighs as many rows as it has.
TRAIN_ROWS = 20_000
#: Bytes of statistics that are broadcast at most, a suffix taking its length and 60 bytes; larger ones are merged.
SMALL = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters whose shares make up the entropy; all others count as one more.
ALPHABET = LOWER + "0123456789" + "-._~/?#&=%+:@"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.lit(2_000_000_000)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2_000_000_000))
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when((F.instr(url, "://") > 0) & (F.instr(rest, "/") > 0), F.substring(rest, F.instr(rest, "/"), F.lit(2_000_000_000))).otherwise("")


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(text, verdict) of the longest rule that fits, else null: one codegen'd CASE over the rules."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _count(text: Column, c: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy in nats over ALPHABET and the rest, from character counts in codegen."""
    low = F.translate(text, UPPER, LOWER)
    n = F.greatest(F.length(low), F.lit(1)).cast("double")
    known = F.translate(low, ALPHABET, "")
    counts = [_count(low, c) for c in ALPHABET] + [F.length(known).cast("double")]
    total = F.lit(0.0)
    for c in counts:
        total = total + F.when(c > 0, c * F.ln(c)).otherwise(0.0)
    return F.ln(n) - total / n


FEATURES = (
    "length", "depth", "digit_ratio", "entropy", "parameters", "host_parts", "host_length", "host_entropy", "dashes", "longest_label", "fragment",
    "last_length", "last_dots", "suffix_share", "suffix_length", "suffix_depth", "suffix_digits",
)


def lexical(df: DataFrame) -> DataFrame:
    """df (url, host, path) with the lexical features of each URL and its `suffix`, the last host label."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring(url, F.instr(url, "?") + 1, F.lit(2_000_000_000)), "#", 1)).otherwise("")
    last = F.substring_index(path, "/", -1)
    longest = F.array_max(F.transform(F.split(host, "[.]"), lambda x: F.length(x)))
    return df.select(
        "*",
        F.length(url).cast("double").alias("length"),
        _count(path, "/").alias("depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("digit_ratio"),
        entropy(url).alias("entropy"),
        _count(query, "=").alias("parameters"),
        (_count(host, ".") + 1).alias("host_parts"),
        F.length(host).cast("double").alias("host_length"),
        entropy(host).alias("host_entropy"),
        _count(host, "-").alias("dashes"),
        longest.cast("double").alias("longest_label"),
        _count(url, "#").alias("fragment"),
        F.length(last).cast("double").alias("last_length"),
        _count(last, ".").alias("last_dots"),
        suffix_of(host).alias("suffix"),
    )


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """Of every suffix among lexical rows: its share of them and the mean length, depth and digit ratio of its URLs."""
    means = [F.avg(c).alias(f"suffix_{name}") for c, name in (("length", "length"), ("depth", "depth"), ("digit_ratio", "digits"))]
    all_ = rows.agg(F.count(F.lit(1)).alias("_all"))
    per = rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("_n"), *means)
    return per.crossJoin(F.broadcast(all_)).withColumn("suffix_share", F.col("_n") / F.col("_all")).drop("_n", "_all")  # all_ is one row


def with_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    names = [c for c in statistics.columns if c != "suffix"]
    return rows.join(statistics, "suffix", "left").fillna(dict.fromkeys(names, 0.0))


def training(urls: DataFrame) -> DataFrame:
    """The first TRAIN_ROWS of distinct labelled urls by hash, and as many of the other label if they have but one."""

    def first(some: DataFrame) -> DataFrame:
        return written(lexical(some.orderBy(F.xxhash64("url"), "url").limit(TRAIN_ROWS)), "urls")

    train = first(urls)
    low, high = train.agg(F.min("label"), F.max("label")).first()
    return train.unionByName(first(urls.filter(F.col("label") != low))) if low == high else train


def parted(df: DataFrame) -> DataFrame:
    """df with host and path of its url; empty for a null url or one without ://."""
    return df.withColumns({"host": F.coalesce(host_of(F.col("url")), F.lit("")), "path": F.coalesce(path_of(F.col("url")), F.lit(""))})


def distinct_labelled(labelled: DataFrame) -> DataFrame:
    """url, host, path, label, _copies of labelled (url, label): one row per distinct url and label."""
    rows = parted(labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label")).filter("label IS NOT NULL"))
    return written(rows.groupBy("url", "host", "path", "label").agg(F.count(F.lit(1)).cast("double").alias("_copies")), "labelled")


def ruled_labels(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(url, label) of the pages that a rule decides: 1 allowed, 0 blocked."""
    rows = parted(pages.select(column_or_null(pages, "url", "string").alias("url")))
    verdict = rule_column(F.col("host"), F.col("path"), rules)["verdict"]
    return rows.select("url", F.when(verdict == "allow", 1.0).when(verdict == "block", 0.0).alias("label")).filter("label IS NOT NULL")


class Trees:
    """Boosted trees over lexical features, fitted on distinct labelled URLs; `rate` alone where one label occurs. Both
    labels weigh alike in sum, however rare one is, so 0.5 parts what looks more like the one or the other."""

    def __init__(self, known: DataFrame, statistics: DataFrame, trees: int = 12, depth: int = 4):
        n, rate = known.agg(F.count(F.lit(1)), F.sum(F.col("label") * F.col("_copies")) / F.sum("_copies")).first()
        self.rate, self.model, self.statistics = (rate if n else 1.0), None, statistics
        if n and rate not in (0.0, 1.0):
            size = statistics.agg(F.sum(F.length("suffix") + 60)).first()[0] or 0
            self.statistics = F.broadcast(statistics) if size <= SMALL else statistics.hint("merge")
            self.assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
            weight = F.col("_copies") / F.when(F.col("label") == 1, 2 * rate).otherwise(2 * (1 - rate))
            train = self.assemble.transform(with_statistics(training(known), self.statistics)).select("features", "label", weight.alias("_weight"))
            self.model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=5, cacheNodeIds=False, weightCol="_weight").fit(train.coalesce(4))

    def scores(self, rows: DataFrame) -> DataFrame:
        """rows (url, host, path, ...) with `allowed`, the probability of label 1."""
        names = rows.columns
        if self.model is None:
            return rows.withColumn("allowed", F.lit(float(self.rate)))
        judged = self.model.transform(self.assemble.transform(with_statistics(lexical(rows), self.statistics)))
        return judged.select(*names, vector_to_array("probability")[1].alias("allowed"))


def held_out_auc(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None, part: int = 4) -> tuple[float, int]:
    """(area under the curve, URLs) on every `part`-th host by hash, with trees fitted on the other hosts alone."""
    known = distinct_labelled(labelled if labelled is not None else ruled_labels(pages, rules))
    apart = F.pmod(F.xxhash64("host"), F.lit(part)) == 0
    statistics = written(suffix_statistics(lexical(known.filter(~apart))), "suffixes")
    scored = Trees(known.filter(~apart), statistics).scores(known.filter(apart)).withColumnRenamed("allowed", "rawPrediction")
    return BinaryClassificationEvaluator().evaluate(scored), scored.count()


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None, trees: int = 12, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, allowed for every row; allowed is the trees' probability, null where a
    rule decides. Labelled URLs (url, label 1 or 0) are those of `labelled`, else those that the rules decide;
    suffix statistics count all pages.

    A null url or one without :// has an empty host and path, so no rule fits and the trees judge it. Without
    labelled URLs, or with one label among them, that label (else allow) is everyone's. A null page_id and repeated
    rows pass through. Extra columns are ignored; an empty table gives no rows."""
    rows = parted(pages.select(column_or_null(pages, "page_id", "long").alias("page_id"), column_or_null(pages, "url", "string").alias("url")))
    rows = rows.withColumn("_rule", rule_column(F.col("host"), F.col("path"), rules))
    statistics = written(suffix_statistics(lexical(rows.select("url", "host", "path"))), "suffixes")
    learnt = Trees(distinct_labelled(labelled if labelled is not None else ruled_labels(pages, rules)), statistics, trees, depth)
    ruled = rows.filter("_rule IS NOT NULL").select("page_id", "host", "path", F.col("_rule.text").alias("rule"), F.col("_rule.verdict").alias("verdict"), F.lit(None).cast("double").alias("allowed"))
    free = learnt.scores(rows.filter("_rule IS NULL").drop("_rule"))
    verdict = F.when(F.col("allowed") >= 0.5, "allow").otherwise("block").alias("verdict")
    return ruled.unionByName(free.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict, "allowed"))
