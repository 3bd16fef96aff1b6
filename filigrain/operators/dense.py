"""Exact dense ranking: unit vectors, dot products in double, blocks of queries against batches of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filigrain.operators.lexical import top


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double") / F.greatest(norm(v), F.lit(1e-12)))


def dense(vectors: DataFrame, query_vectors: DataFrame, candidates: int = 100, most_queries: int = 256) -> DataFrame:
    """(qid, pos, score, rank) of query_vectors(qid, vec) against vectors(pos, embedding); ties by position.

    Queries go in blocks of about `most_queries`, cut by a hash of qid, whose matrix is small whatever their number;
    each batch of rows is one matrix product, and only its best candidates per query leave it."""
    kind = dict(query_vectors.dtypes)["qid"]
    blocks = max(1, -(-query_vectors.count() // most_queries))
    block = F.pmod(F.xxhash64("qid"), F.lit(blocks))
    found = None
    for i in range(blocks):
        some = query_vectors.filter(block == i) if blocks > 1 else query_vectors
        one = _scored(vectors, some.orderBy("qid").collect(), candidates, kind)  # about most_queries rows
        found = one if found is None else found.union(one)
    return top(found, candidates, positive=False)


def _scored(vectors: DataFrame, queries: list, candidates: int, kind: str, rows: int = 4096) -> DataFrame:
    import numpy as np

    ids = [r["qid"] for r in queries]
    matrix = np.array([r["vec"] for r in queries], float).T

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for a in range(0, batch.num_rows if ids else 0, rows):
                part = batch.slice(a, rows)
                held = part.column("embedding")
                pos = part.column("pos").to_numpy()
                scores = np.round(held.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(pos), -1) @ matrix, 6)
                kth = min(candidates, len(pos))
                least = np.partition(scores, len(pos) - kth, axis=0)[len(pos) - kth]
                for j, q in enumerate(ids):
                    some = np.flatnonzero(scores[:, j] >= least[j])
                    best = some[np.lexsort((pos[some], -scores[some, j]))[:candidates]]
                    yield pa.RecordBatch.from_arrays([pa.array([q] * len(best), qid), pa.array(pos[best]), pa.array(scores[best, j])], ["qid", "pos", "score"])

    qid = _arrow(kind)
    return vectors.select(F.col("pos").cast("long").alias("pos"), "embedding").mapInArrow(run, f"qid {kind}, pos long, score double")


def _arrow(kind: str):
    import pyarrow as pa

    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
