"""Quality classifier: random Fourier features of document statistics, ridge scores from partition-summed normal
equations, isotonic calibration. Only sums of bounded size (features squared, or bins) reach the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from filigrain.llm.common import Words, arrow_batches, arrow_bytes, column_or_null, fits_broadcast, fresh, rows_in_slices, written

STATS = (
    "log_chars", "word_length", "word_spread", "upper", "digits", "marks", "symbols", "wide_bytes", "line_length", "log_lines",
    "repeated_words", "top_word", "echoes", "repeated_lines", "entropy", "closed_words",
)
FEATURES = 256
BINS = 400
#: Bytes of text whose statistics are taken at once; the arrays beside them take some 30 times as much.
SLICE = 1 << 19
#: Marks usual in prose; other printable ASCII that is no letter or digit counts as a symbol.
PROSE_MARKS = b".,;:!?'\"()-"


def _kinds() -> np.ndarray:
    """Per byte: 1 upper, 2 digit, 3 prose mark, 4 symbol, 5 byte of a longer character, 0 others."""
    kind = np.zeros(256, np.uint8)
    kind[33:127] = 4
    kind[list(PROSE_MARKS)] = 3
    kind[48:58] = 2
    kind[65:91] = 1
    kind[97:123] = 0
    kind[128:] = 5
    return kind


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATS per text; an empty text is zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATS)))
    words = Words(data, offsets)
    size, count = np.diff(offsets), words.counts()
    some, many = np.maximum(size, 1), np.maximum(count, 1)
    kind = _kinds()[data]

    def share(flags: np.ndarray, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
        return (sums[at[1:]] - sums[at[:-1]]) / by

    out[:, 0] = np.log1p(size)
    length = (words.end - words.start).astype(float)
    out[:, 1] = share(length, words.first, many)
    out[:, 2] = np.sqrt(np.maximum(0, share(length**2, words.first, many) - out[:, 1] ** 2))
    for column, k in ((3, 1), (4, 2), (5, 3), (6, 4), (7, 5)):
        out[:, column] = share(kind == k, offsets, some)
    lines = data == 10
    out[:, 9] = share(lines, offsets, 1)
    out[:, 8] = np.log1p(size / (out[:, 9] + 1))
    out[:, 9] = np.log1p(out[:, 9])
    echo = np.zeros(len(words.hash))
    if len(words.hash):
        echo[1:] = words.hash[1:] == words.hash[:-1]
        echo[words.first[:-1][count > 0]] = 0
        ends = data[words.end - 1]
        out[:, 15] = share(_kinds()[ends] > 1, words.first, many)
    out[:, 12] = share(echo, words.first, many)
    # lines as ranges between line feeds, hashed like words
    whole = data.copy()
    blank = (whole == 32) | ((whole >= 9) & (whole <= 13) & (whole != 10))
    whole[blank] = 1  # a character that ends no word, so that a line is one word
    rows = Words(whole, offsets)
    for i in range(n):
        own = words.hash[words.first[i] : words.first[i + 1]]
        if len(own):
            _, c = np.unique(own, return_counts=True)
            # distinct words grow slower than the text: compared with a square-root law
            out[i, 10] = np.log(len(own) / len(c)) / np.log(len(own) + 2)
            out[i, 11] = c.max() / len(own)
        own = rows.hash[rows.first[i] : rows.first[i + 1]]
        if len(own):
            out[i, 13] = 1 - len(np.unique(own)) / len(own)
        text = data[offsets[i] : offsets[i + 1]]
        if len(text):
            p = np.bincount(text, minlength=256) / len(text)
            p = p[p > 0]
            out[i, 14] = -(p * np.log(p)).sum()
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics (array of double) over the whole text; null counts as empty."""

    def run(batches):
        import pyarrow as pa

        for batch in rows_in_slices(batches, SLICE):
            x = statistics(*arrow_bytes(batch.column("text")))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), flat], ["doc_id", "stats"])

    narrow = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), column_or_null(docs, "text", "string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, stats array<double>")


class Fourier:
    """Standardised statistics and the features sqrt(2 / D) cos(w x + b) of a Gaussian kernel."""

    def __init__(self, mean, spread, features: int = FEATURES, width: float = 3.0, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.mean, self.spread = np.asarray(mean), np.maximum(np.asarray(spread), 1e-9)
        self.w = draw.standard_normal((len(self.mean), features)) / width
        self.b = draw.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -4, 4)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([z, np.ones((len(z), 1))])


def ridge(rows: DataFrame, kernel: Fourier, penalty: float = 1e-4, groups: int = 8) -> np.ndarray | None:
    """Weights from rows (stats, y): each task sums its normal equations, `groups` tasks add those, the driver
    adds the last ones and solves."""
    d = len(kernel.b) + 1

    def partial(batches):
        import pyarrow as pa

        a, v, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            if batch.num_rows:
                z = kernel(np.stack(batch.column("stats").to_numpy(zero_copy_only=False)))
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                a, v, n = a + z.T @ z, v + z.T @ y, n + len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([v.tobytes()]), pa.array([n])], ["a", "v", "n"])

    def add(batches):
        import pyarrow as pa

        a, v, n = np.zeros(d * d), np.zeros(d), 0
        for batch in batches:
            for x, y, m in zip(*(batch.column(c).to_pylist() for c in ("a", "v", "n"))):
                a, v, n = a + np.frombuffer(x), v + np.frombuffer(y), n + m
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([v.tobytes()]), pa.array([n])], ["a", "v", "n"])

    kind = "a binary, v binary, n long"
    sums = rows.select("stats", "y").mapInArrow(partial, kind).repartition(groups).mapInArrow(add, kind).collect()  # at most `groups` rows
    if not sums:
        return None
    a = sum(np.frombuffer(r["a"]) for r in sums).reshape(d, d)
    v, n = sum(np.frombuffer(r["v"]) for r in sums), sum(r["n"] for r in sums)
    return np.linalg.solve(a + penalty * n * np.eye(d), v)


def isotonic(at: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending order: block centres and non-decreasing rates."""
    blocks: list[list[float]] = []
    for x, g, c in zip(at, good, count):
        blocks.append([x * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def raw_scores(rows: DataFrame, kernel: Fourier, weights: np.ndarray, knots=None) -> DataFrame:
    """rows (doc_id, stats, ...) with `score` in place of stats: raw, or calibrated through the knots."""
    names = [c for c in rows.columns if c != "stats"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                s = kernel(np.stack(batch.column("stats").to_numpy(zero_copy_only=False))) @ weights
                if knots is not None:
                    s = np.clip(np.interp(s, *knots), 0, 1)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(s)], [*names, "score"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "score double"]))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Ridge weights come from labelled rows of folds 0 and 1, calibration from fold 3; fold 2 is held out of both.
    The rate in the calibration bins is smoothed by one row at the base rate. Scores see nothing but the text's
    statistics. Null and empty texts have zero statistics and are scored like others; a null doc_id is of fold 0
    and has no label; null labels are skipped; of repeated labels the lower counts. Without labels every score is
    0.5. Extra columns are ignored; an empty table gives no rows."""
    with arrow_batches(docs.sparkSession):
        rows = written(document_statistics(docs), "statistics")
    d = len(STATS)
    sums = rows.agg(F.count(F.lit(1)), *[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(d)]).first()
    marked = F.col("held_out"), F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    rows = rows.withColumn("held_out", fold(F.col("doc_id")) == 2)
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    own = own.filter(fold(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.min("y").alias("y"))
    train = written(rows.filter(~F.col("held_out")).join(own, "doc_id").select("doc_id", "stats", "y"), "labelled") if sums[0] else None
    kernel = Fourier(sums[1 : d + 1], sums[d + 1 :]) if sums[0] else None
    weights = ridge(train.filter(fold(F.col("doc_id")) != 3), kernel) if kernel else None
    if weights is None:
        return rows.withColumn("score", F.lit(0.5)).select("doc_id", marked[0], "score", marked[1])
    placed = raw_scores(train.filter(fold(F.col("doc_id")) == 3), kernel, weights)
    bin_ = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("score") + 0.5) * (BINS / 2)))).cast("int")
    bins = placed.groupBy(bin_.alias("bin")).agg(F.avg("score").alias("at"), F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()  # at most BINS rows
    if bins:
        at, good, n = (np.array([float(b[c]) for b in bins]) for c in ("at", "good", "n"))
        base = good.sum() / n.sum()
        knots = isotonic(at, good + base, n + 1)
    else:
        knots = None
    scored = raw_scores(rows.select("doc_id", "held_out", "stats"), kernel, weights, knots if knots is not None else (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    return scored.select("doc_id", marked[0], "score", marked[1])


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """The documents whose score is at least `least`, with their columns.

    Of rows that repeat a doc_id the lowest score decides, of rows with a null doc_id the lowest of theirs. Null and
    empty texts are scored like others. Other columns pass through; without labels every score is 0.5, so nothing stays
    under a higher `least`; an empty table gives no rows."""
    one, = fresh(docs, "_id")
    bad = quality_scores(docs, labels).filter(F.col("score") < least).select(F.col("doc_id").alias(one)).distinct()
    bad = fits_broadcast(written(bad, "bad"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad[one]), "left_anti").select(*docs.columns)
