"""Latent vectors: TF-IDF with sublinear counts, cut to the strongest singular directions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from filigrain.functions.text import tokens

#: Dimensions, features, documents a term must occur in.
DIMS, FEATURES, LEAST_DOCS = 256, 50_000, 1


class Latent(NamedTuple):
    """terms(term, idf, direction: array) of the features kept; at most FEATURES rows."""

    terms: DataFrame


def weighted(texts: DataFrame, pos: str = "pos", text: str = "text") -> DataFrame:
    """(pos, term, w): 1 + ln(count) for each term of each text."""
    rows = texts.select(F.col(pos).alias("pos"), F.explode(tokens(F.col(text))).alias("term")).groupBy("pos", "term").agg(F.count(F.lit(1)).alias("tf"))
    return rows.select("pos", "term", (F.ln("tf") + 1).alias("w"))


def fit(texts: DataFrame, dims: int = DIMS, features: int = FEATURES, pos: str = "pos", text: str = "text") -> Latent:
    """Directions of the corpus. The decomposition is MLlib's distributed SVD: rows stay on the executors, the driver
    holds vectors of as many entries as there are features."""
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix

    rows = weighted(texts, pos, text)
    n = texts.count()
    df = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= LEAST_DOCS).orderBy(F.desc("df"), "term").limit(features)
    vocabulary = [(r["term"], i, float(r["idf"])) for i, r in enumerate(df.select("term", (F.ln((F.lit(n) + 1.0) / (F.col("df") + 1)) + 1).alias("idf")).collect())]  # at most `features` rows
    spark, size = texts.sparkSession, len(vocabulary)
    if not size:
        return Latent(spark.createDataFrame([], "term string, idf double, direction array<double>"))
    terms = spark.createDataFrame(vocabulary, "term string, at int, idf double")
    vectors = rows.join(F.broadcast(terms), "term").groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("at", (F.col("w") * F.col("idf")).alias("x")))).alias("v"))

    def row(r):
        norm = sum(e["x"] ** 2 for e in r["v"]) ** 0.5 or 1.0
        return Vectors.sparse(size, [e["at"] for e in r["v"]], [e["x"] / norm for e in r["v"]])

    matrix = RowMatrix(vectors.select("v").rdd.map(row), 0, size)  # MLlib's matrix takes rows of vectors only
    directions = matrix.computeSVD(min(dims, size, n)).V.toArray()
    found = [(term, idf, [float(x) for x in directions[at]]) for term, at, idf in vocabulary]
    return Latent(spark.createDataFrame(found, "term string, idf double, direction array<double>"))


def embed(model: Latent, texts: DataFrame, pos: str = "pos", text: str = "text") -> DataFrame:
    """(pos, embedding) of unit length for every text; a text without known terms has zeros."""
    first = model.terms.select(F.size("direction").alias("d")).first()
    dims = first["d"] if first else 0
    zero = F.array_repeat(F.lit(0.0), dims)
    hit = weighted(texts, pos, text).join(F.broadcast(model.terms), "term")  # at most FEATURES rows
    sums = hit.groupBy("pos").agg(*(F.sum(F.col("w") * F.col("idf") * F.col("direction")[i]).alias(f"_{i}") for i in range(dims))) if dims else hit.groupBy("pos").agg(F.count(F.lit(1)).alias("_"))
    raw = sums.select("pos", F.array(*(F.col(f"_{i}") for i in range(dims))).cast("array<double>").alias("_v"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x))
    unit = raw.withColumn("_n", F.greatest(norm, F.lit(1e-12))).select("pos", F.transform("_v", lambda x: x / F.col("_n")).alias("embedding"))
    return texts.select(F.col(pos).alias("pos")).join(unit, "pos", "left").withColumn("embedding", F.coalesce("embedding", zero))
