"""Near-duplicate detection by a signature-coordinate inverted join.

Each distinct shingle set is signed by `coords` min-hashes and posted under each (coordinate, value) pair. A pair
that agrees in at least `least` coordinates must share one of the coords - least + 1 rarest pairs of either, so only
that prefix is merged; documents whose prefix nobody shares are skipped whole, and so are the long lists, where only
pairs that met in a merged list are looked up. Collisions of both kinds are counted, and the pairs with `least` or more
are confirmed on full shingle sets.

Groups stay linear: equal sets are one class first; each posting list is compared with its hub, the member whose
pairs are the most common (the centre of a group of edited copies); after the linked classes are merged into
components, lists that still hold several components are compared across components only, by what sets their
members apart from the hub (see cross_pairs)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from filigrain.llm.common import Words, arrow_batches, arrow_bytes, column_or_null, fits_broadcast, fresh, mix64, rows_in_slices, split_join, spread_join, written
from filigrain.llm.components import connected_components

COORDS = 64
#: Bytes of text hashed at once; the arrays beside them take some 30 times as much.
SLICE = 1 << 19


def least_matches(similarity: float, coords: int = COORDS, sigmas: float = 5.75) -> int:
    """Coordinates that pairs at `similarity` share but for a chance of about 1e-8."""
    return max(1, math.floor(coords * similarity - sigmas * math.sqrt(coords * similarity * (1 - similarity))))


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): 64-bit hashes of the k-word shingles, those of text i at first[i]:first[i + 1]. A text of
    fewer words has its whole sequence as one; a text without words has none."""
    counts = words.counts()
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    total = int(first[-1])
    at = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(total)
    size = np.repeat(np.minimum(counts, k), n)
    odd = mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for i in range(k):
        inside = size > i
        out[inside] += words.hash[at[inside] + i] * odd[i]
    return mix64(out), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    hashes, first = shingle_hashes(Words(data, offsets, lower=True), k)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def multipliers(coords: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * coords + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return seeds[:coords] | np.uint64(1), seeds[coords:]


def signed(docs: DataFrame, k: int, coords: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the shingle set) and signature (little-endian unsigned 32-bit minima)."""

    def run(batches):
        import pyarrow as pa

        a, b = multipliers(coords)
        for batch in rows_in_slices(batches, SLICE):
            hashes, first = shingle_hashes(Words(*arrow_bytes(batch.column("text")), lower=True), k)
            rows = np.flatnonzero(np.diff(first))
            minima = np.zeros((batch.num_rows, coords), np.uint32)
            if len(rows):
                for c in range(coords):
                    minima[rows, c] = np.minimum.reduceat((hashes * a[c] + b[c]) >> np.uint64(32), first[rows])
            sizes, digests, signs = [0] * batch.num_rows, [None] * batch.num_rows, [None] * batch.num_rows
            for i in rows.tolist():
                s = np.unique(hashes[first[i] : first[i + 1]])
                sizes[i], digests[i], signs[i] = len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), minima[i].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "digest", "signature"]
            )

    narrow = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), column_or_null(docs, "text", "string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def postings(classes: DataFrame, coords: int, least: int) -> DataFrame:
    """(key, node, score): the prefix of each class, without pairs that only it has. score is how common the
    class's pairs are, over its whole signature."""

    def explode(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                flat = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, coords)
                keys = flat.astype(np.int64) | (np.arange(coords, dtype=np.int64) << 32)
                nodes = np.repeat(batch.column("node").to_numpy(), coords)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], ["key", "node"])

    rows = written(classes.select("node", "signature").mapInArrow(explode, "key long, node long"), "coordinates")
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    # pairs that no other class has stay out of the join's output; how many a class has follows from the rest
    common = split_join(rows, shared, ["key"])
    per = common.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("at"), F.sum("n").alias("score"))
    prefix = coords - least + 1
    left = F.greatest(F.lit(0), F.lit(prefix - coords) + F.size("at"))
    return per.select("node", "score", F.explode(F.slice("at", F.lit(1), left)).alias("p")).select(F.col("p.key").alias("key"), "node", "score")


def merged(lists: DataFrame, hub_of: DataFrame) -> DataFrame:
    """(a, b, met): members of the merged lists and their hubs; met has a bit for each coordinate at which a list
    counted a collision of the two."""
    pairs = split_join(lists, hub_of, ["key"]).filter("node <> b")
    return pairs.groupBy(F.col("node").alias("a"), "b").agg(F.bit_or(F.expr("shiftleft(1L, int(shiftright(key, 32)))")).alias("met"))


def matching(pairs: DataFrame, classes: DataFrame, coords: int, least: int) -> DataFrame:
    """Of pairs (a, b, met), those with `least` collisions or more: those counted by the merged lists, which are not
    compared again, and those of the lists that were skipped, looked up in the signatures."""
    bits = np.arange(coords, dtype=np.int64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, coords) for c in ("sa", "sb"))
                met = (batch.column("met").to_numpy()[:, None] >> bits & 1).astype(bool)
                collisions = met.sum(axis=1) + ((x == y) & ~met).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(collisions >= least))

    sign = classes.select("node", "signature")
    hubs = written(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(sign.toDF("b", "sb"), "b"), "hubs")
    both = split_join(pairs, hubs, ["b"]).join(sign.toDF("a", "sa"), "a")
    return both.select("a", "b", "met", "sa", "sb").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those with 100 * intersection >= percent * union over full shingle sets."""
    both = F.size(F.array_intersect("set_a", "set_b"))
    return with_both_sets(pairs, sets).filter(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b").distinct()


def with_both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with set_a and set_b. The hubs b are few; their sets travel, spread where many pairs hold one."""
    left = pairs.select("a", "b").join(sets.toDF("a", "set_a"), "a")
    hubs = written(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(sets.toDF("b", "set_b"), "b"), "hubs")
    return spread_join(left, hubs, ["b"], "a").drop("n")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    A-Z are lower-cased, words are [^\\x20\\x09-\\x0D]+, shingles have k words; documents whose sets have a Jaccard
    similarity of percent / 100 or more are linked, and component_id is the smallest doc_id reachable. An empty or
    null text links with nothing. Rows that repeat a doc_id are one node, linked by any of their texts. A null
    doc_id links with nothing and stays. Extra columns are ignored; an empty table gives no rows."""
    with arrow_batches(docs.sparkSession):
        least = least_matches(percent / 100, coords)
        rows = written(signed(docs, k, coords), "signatures")
        able = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        heads = able.groupBy("digest").agg(F.min(F.struct("doc_id", "signature")).alias("h"), F.max("doc_id").alias("_last")).select("digest", F.col("h.doc_id").alias("node"), F.col("h.signature").alias("signature"), "_last")
        heads = written(heads, "classes")
        classes = heads.select("node", "signature")
        copies = able.join(heads.filter("node <> _last").select("digest", "node"), "digest").filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        lists = written(postings(classes, coords, least), "postings")
        hubs = lists.groupBy("key").agg(F.max(F.struct("score", (-F.col("node")).alias("m"))).alias("h"), F.count(F.lit(1)).alias("n"))
        hub_of = written(hubs.select("key", (-F.col("h.m")).alias("b"), "n"), "hubs")
        near = written(matching(written(merged(lists, hub_of), "collisions"), classes, coords, least), "pairs")
        sets = written(shingle_table(docs, written(lists.select("node").distinct(), "nodes"), k), "sets")
        edges = written(confirmed(near, sets, percent).union(copies), "links")
        roots = connected_components(edges)
        across = written(cross_pairs(lists, hub_of, roots, sets, percent), "collisions")
        more = written(matching(across.withColumn("met", F.lit(0).cast("long")), classes, coords, least), "pairs")
        if more.limit(1).count():
            more = written(more.join(near, ["a", "b"], "left_anti").join(near.toDF("b", "a"), ["a", "b"], "left_anti"), "pairs")
            fresh = written(confirmed(more, sets, percent), "links")
            if fresh.limit(1).count():
                roots = connected_components(roots.filter("node <> root").toDF("a", "b").union(fresh))
        roots = roots.filter("node <> root")
    out = rows.join(roots, rows["doc_id"] == roots["node"], "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def shingle_table(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, set) of the nodes: the shingle set of each one's text, hashed once for all later steps."""

    def run(batches):
        import pyarrow as pa

        for batch in rows_in_slices(batches, SLICE):
            own = shingle_sets(*arrow_bytes(batch.column("text")), k)
            at = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(own).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], ["node", "set"])

    text = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    return text.join(fits_broadcast(nodes), "node").mapInArrow(run, "node long, set array<long>")


def residuals(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, rest) of pairs (a, b): rest is the symmetric difference of the two shingle sets."""
    rest = F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a"))
    return with_both_sets(pairs, sets).select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), rest.alias("rest"))


#: Width of the classes of residual sizes: this share of the hub's set near the hub, growing with the distance.
CLASS_WIDTH = 0.02


def cross_pairs(lists: DataFrame, hub_of: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a posting list and may be linked, each once.

    Members of a list are described by what sets them apart from its hub h: R(x), the symmetric difference of x and
    h. Links allow |x - y| <= D = (1 - t) / (1 + t) (|x| + |y|) differing shingles, so R(x) and R(y) have at least
    (|R(x)| + |R(y)| - D) / 2 in common; and as one of the two is not linked to h, at least t / 2 of the smaller.
    So a prefix of each, rarest first, shares a shingle (prefix filter, by classes of |R|), and what only one member
    of the list has is never joined. Edited copies that went separate ways have nothing rare in common."""
    t = percent / 100
    placed = lists.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    members = split_join(placed, written(mixed.join(hub_of, "key"), "mixed"), ["key"]).filter("node <> b")
    members = written(members.groupBy(F.col("node").alias("a"), "b").agg(F.max("root").alias("root")), "members")
    rest = written(residuals(members.select("a", "b"), sets), "residuals")
    each = rest.select("a", "b", F.explode("rest").alias("f"))
    shared = written(each.groupBy("b", "f").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    common = split_join(each, shared, ["b", "f"]).groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("n", "f"))).alias("s"))
    size = F.size("rest")
    rows = rest.select("a", "b", "n_b", size.alias("r"), (F.lit((1 - t) / (1 + t) * (1 + 1 / t)) * F.col("n_a")).alias("d"))

    def class_of(r: Column) -> Column:
        return F.floor(F.log1p(F.greatest(r, F.lit(0.0)) / F.greatest(F.col("n_b"), F.lit(1))) / CLASS_WIDTH).cast("int")

    rows = rows.withColumn("q", class_of(F.col("r"))).withColumn("p", F.explode(F.sequence(class_of(F.col("r") - F.col("d")), class_of(F.col("r") + F.col("d")))))
    least = F.floor(F.expm1(F.col("p") * CLASS_WIDTH) * F.col("n_b"))  # no partner of class p has fewer
    overlap = F.greatest(F.lit(1), F.ceil((F.col("r") + least - F.col("d")) / 2 - 1e-6), F.ceil(t / 2 * F.least("r", least) - 1e-6)).cast("int")
    posted = rows.withColumn("prefix", F.col("r") - overlap + 1).filter("prefix > 0").join(common, ["a", "b"])
    taken = F.col("prefix") - (F.col("r") - F.size("s"))  # shingles of its own come first and meet nobody
    posted = posted.withColumn("taken", taken).filter("taken > 0").select("a", "b", "q", "p", F.explode(F.slice("s", F.lit(1), F.least("taken", F.size("s")))).alias("e"))
    posted = posted.join(members, ["a", "b"]).select("b", "q", "p", F.col("e.f").alias("f"), "a", "root")
    posted = written(posted, "posted")
    x, y = posted, posted.select("b", F.col("p").alias("q"), F.col("q").alias("p"), "f", F.col("a").alias("c"), F.col("root").alias("other"))
    # merged: these rows take little room in files, by which Spark would judge them fit to be broadcast
    found = x.hint("merge").join(y, ["b", "q", "p", "f"]).filter("a > c AND root <> other")
    return found.select("a", F.col("c").alias("b")).distinct()


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The documents kept, the smallest doc_id of each group, with their columns.

    Rows that repeat a doc_id are one node and stay or go together. Null and empty texts and null doc_ids link with
    nothing and stay. Other columns pass through under any names; an empty table gives no rows."""
    one, = fresh(docs, "_id")
    gone = near_duplicates(docs, **settings).filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(one)).distinct()
    gone = fits_broadcast(written(gone, "gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone[one], "left_anti").select(*docs.columns)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
  FROM d
), p AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.x = b.x
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT a AS doc_id, b AS o FROM l
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.o
)
SELECT s.doc_id, len(s.g) AS n_shingles, coalesce(min(r.o), s.doc_id) AS component_id, s.doc_id = coalesce(min(r.o), s.doc_id) AS kept
FROM s LEFT JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(s.g)
"""
