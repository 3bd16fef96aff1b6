"""Shared pieces: scratch tables in the cluster's shared folder, global order without a single-task sort."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

#: The contract's white space: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that is unset, a local master has a temporary one of its own;
    on a cluster executors could not see it, so there the setting is required."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _OWN_ROOTS.get(context.applicationId) or tempfile.mkdtemp(prefix="filigrain-")
        _OWN_ROOTS[context.applicationId] = root
    return root.rstrip("/")


_OWN_ROOTS: dict[str, str] = {}


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the columns of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors, and
    fixes values such as partition numbers that a recomputation could change."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/filigrain/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int = 4 << 20):
    """What is run inside sends batches of about `size` bytes to Python. By default a batch has 10,000 rows, so its
    buffers, in the JVM and in Python, grow with the length of the texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def ranked_parts(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """df sorted over the whole cluster and written once, with _part (range number) and _idx (0, 1, ... in it).

    Range partitioning splits a hot key when the order ends in a finer column, so no task gets a whole group."""
    sort = df.repartitionByRange(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order)
    mono = sort.sortWithinPartitions(*order).withColumn("_mono", F.monotonically_increasing_id())
    return written(
        mono.withColumn("_part", F.shiftright("_mono", 33).cast("int")).withColumn("_idx", F.col("_mono").bitwiseAND((1 << 33) - 1)).drop("_mono"),
        name,
    )


def global_rank(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """df plus _rank, its 0-based place in the total order. Only one row per partition meets in one task."""
    rows = ranked_parts(df, *order, name=name)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    base = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(base), "_part").withColumn("_rank", F.col("_base") + F.col("_idx")).drop("_base", "_part", "_idx")


def fits_broadcast(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its values are measured to take BROADCAST_BYTES at most; else as it is. df should be
    a written table, as it is read for the measure."""
    kinds = dict(df.dtypes)
    wide = [F.sum(F.octet_length(F.col(f"`{c}`"))) for c in df.columns if kinds[c] in ("string", "binary")]
    rows, *bytes_ = df.agg(F.count(F.lit(1)), *wide).first()
    return F.broadcast(df) if rows * 16 * len(df.columns) + sum(b or 0 for b in bytes_) <= BROADCAST_BYTES else df


#: A key is hot if it holds more than this share of the rows and more than this number of narrow ones, or of wide ones,
#: which may be whole sets of very long texts.
HOT_SHARE, HOT_ROWS, HOT_WIDE_ROWS = 1 / 4096, 10_000, 16


def _hot_limit(one: DataFrame, least: int) -> int | None:
    """Rows above which a key of one (with n, how many rows hold it) is hot; None if no key is."""
    most, total = one.agg(F.max("n"), F.sum("n")).first()
    limit = max(least, math.ceil((total or 0) * HOT_SHARE))
    return limit if (most or 0) > limit else None


def split_join(many: DataFrame, one: DataFrame, keys: list[str]) -> DataFrame:
    """many joined with narrow rows of one, a written table that has one row per key and in `n` how many rows of many hold
    it.

    Hot keys are fewer than 1 / HOT_SHARE, whatever the tables' size; their rows of `one` are broadcast, so the rows of
    many that hold them stay where they lie. The others are shuffled."""
    limit = _hot_limit(one, HOT_ROWS)
    if limit is None:
        return many.join(one, keys)
    hot = one.filter(F.col("n") > limit)
    rest = many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(one.filter(F.col("n") <= limit), keys)
    return many.join(F.broadcast(hot), keys).unionByName(rest)


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], by: str) -> DataFrame:
    """As split_join for wide rows: rows of a hot key are dealt by column `by` over as many tasks as hold a share each, and
    its row of `one` is sent to all of them; only the keys are broadcast."""
    limit = _hot_limit(one, HOT_WIDE_ROWS)
    if limit is None:
        return many.join(one, keys)
    tasks = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    hot = F.broadcast(one.filter(F.col("n") > limit).select(*keys, tasks.alias("_tasks")))
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.col("_tasks")), F.lit(0)).cast("int")
    dealt = many.join(hot, keys, "left").withColumn("_salt", salt).drop("_tasks")
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")


LONGEST = (1 << 63) - 1
BROADCAST_BYTES = 24 << 20


def below(c: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are <= c, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds))


def with_next(rows: DataFrame, key: str, value: str, ties: str, per_partition: int = 4, most: int = 4096) -> DataFrame:
    """rows plus next_{value}: that of the row that follows by ascending `key` (a long; nulls last), then `ties`; the
    last row is followed by the first.

    Buckets are cut at keys that occur (quantiles of one bounded summary, `most` at most), so the row that follows
    a bucket is known by its key and is sent to both buckets; rows are shuffled once."""
    rows = rows.withColumn("_k", F.coalesce(F.col(key), F.lit(LONGEST)))
    n = min(most, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * per_partition)
    found = rows.agg(F.min("_k").alias("lo"), F.percentile_approx("_k", [i / n for i in range(1, n)] or [0.5], 10 * n).alias("cuts")).first()
    if found["lo"] is None:
        return rows.drop("_k").withColumn(f"next_{value}", F.col(value))
    bounds = sorted({found["lo"], *(found["cuts"] or [])})
    before = F.when(F.col("_b") == 1, F.lit(len(bounds))).otherwise(F.col("_b") - 1)
    own = F.struct(F.col("_b").alias("b"), F.lit(0).alias("g"))
    guard = F.struct(before.alias("b"), F.lit(1).alias("g"))
    both = rows.withColumn("_b", below(F.col("_k"), bounds)).withColumn("_at", F.explode(F.when(F.col("_k").isin(bounds), F.array(own, guard)).otherwise(F.array(own))))
    by = W.partitionBy("_at.b").orderBy("_at.g", "_k", ties)
    return both.withColumn(f"next_{value}", F.lead(value).over(by)).filter("_at.g = 0").drop("_k", "_b", "_at")


# ---- vectorised word hashing (numpy over whole Arrow batches) ----

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_Q = np.uint64(0xD6E8FEB86659FD93 | 1)


def _inverse(p: np.uint64) -> np.uint64:
    return np.uint64(pow(int(p), -1, 1 << 64))


_PI, _QI = _inverse(_P), _inverse(_Q)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(p: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = p
        np.multiply.accumulate(out, out=out)
    return out


_CACHE: dict[str, np.ndarray] = {}


def powers(which: str, n: int) -> np.ndarray:
    have = _CACHE.get(which)
    if have is None or len(have) < n:
        have = _CACHE[which] = _powers({"P": _P, "PI": _PI, "Q": _Q, "QI": _QI}[which], max(n, 1 << 16))
    return have[:n]


def range_hasher(values: np.ndarray, base: str):
    """A function of (start, end): 64-bit polynomial hashes of values[start:end] for many ranges at once."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    back = powers(f"{base}I", n + 1)
    return lambda start, end: mix64((sums[end] - sums[start]) * back[start])


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: str) -> np.ndarray:
    return range_hasher(values, base)(start, end)


def arrow_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is empty."""
    import pyarrow as pa

    array = (array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array).cast(pa.large_string())
    array = array.fill_null("")
    _, offsets, data = array.buffers()
    offs = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or not len(array) or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


class Words:
    """The words of a batch of texts: byte ranges, hashes and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[offsets <= len(data)]] = True  # a word never crosses two texts
        word = ~space
        start = word.copy()
        start[1:] &= space[:-1] | edge[1:-1]
        end = word.copy()
        end[:-1] &= space[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.offsets = data, offsets
        self.hash = range_hash(data.astype(np.uint64) + np.uint64(1), self.start, self.end, "P") if len(self.start) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, offsets)  # words of text i: first[i] .. first[i + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def give_back() -> None:
    """Hand memory that Python and Arrow hold unused back to the system; idle workers count against their executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def rows_in_slices(batches, size: int = 8 << 20):
    """Arrow batches cut so that each has about `size` bytes of its text column, or a single long text."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(n) - n) // size
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)
    give_back()
