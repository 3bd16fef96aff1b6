"""Repeated passages by a sparse suffix array.

Suffixes are retained at minimiser positions only: of every least - SEED + 1 consecutive SEED-word beginnings, the
one with the smallest hash. Two texts that share `least` words retain the same suffix inside them, wherever these
stand. A pass over the hashes alone drops suffixes whose beginning no other suffix has. What is left carries its next
`least` words and the words before it, as 32-bit word ids, and is sorted by them: each task holds the suffixes of some
beginnings in order. Common prefixes of neighbours then give, for every depth, the runs of suffixes that go on alike
to the right; the order of the words before them gives the runs that are alike to the left; where `least` words in all
agree with a suffix of another document, the match is extended over them. So no match of `least` words or more is
missed, and nothing is compared pair by pair. The few beginnings that very many suffixes have are split by the words
around them, each of whose windows is counted on its own."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F, Window as W

from filigrain.llm.common import BROADCAST_BYTES, Words, arrow_batches, arrow_bytes, column_or_null, fits_broadcast, range_hash, range_hasher, rows_in_slices, split_join, written

SEED = 16
#: Rows that a task holds at once; runs of one beginning above it, or above 1 / SPLIT of all rows, are split.
RUN = 20_000
SPLIT = 1024
#: Bytes of text whose word arrays are held at once.
SLICE = 1 << 20


def beginnings(words: Words, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the `seed` words from each word on, whether all are in the word's own text)."""
    n = len(words.hash)
    last = np.repeat(words.first[1:], words.counts())
    at = np.arange(n)
    inside = at + seed <= last
    hashes = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    if inside.any():
        hashes[inside] = range_hash(words.hash, at[inside], at[inside] + seed, "Q")
    return hashes, inside


def minimisers(words: Words, seed: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions retained, their hashes): the minima of each run of least - seed + 1 beginnings within a text."""
    hashes, inside = beginnings(words, seed)
    run = least - seed + 1
    if len(hashes) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(words.first[1:], words.counts())
    whole = np.arange(len(hashes) - run + 1) + least <= last[: len(hashes) - run + 1]
    keep = np.zeros(len(hashes), bool)
    view = np.lib.stride_tricks.sliding_window_view(hashes, run)
    for a in range(0, len(view), 1 << 18):
        some = np.flatnonzero(whole[a : a + (1 << 18)]) + a
        keep[some + view[some].argmin(axis=1)] = True
    at = np.flatnonzero(keep)
    return at, hashes[at]


def retained(docs: DataFrame, seed: int, least: int) -> DataFrame:
    """(hash, doc_id, word): the retained suffixes of docs (doc_id, nth, text); word counts from 0 in the text and has
    nth in its upper half, so the texts of one doc_id never touch."""

    def run(batches):
        import pyarrow as pa

        for batch in rows_in_slices(batches, SLICE):
            words = Words(*arrow_bytes(batch.column("text")))
            at, hashes = minimisers(words, seed, least)
            row = np.searchsorted(words.first, at, "right") - 1
            nth = batch.column("nth").to_numpy().astype(np.int64)
            docs_ = batch.column("doc_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.astype(np.int64)), docs_, pa.array((nth[row] << 32) + at - words.first[row])], ["hash", "doc_id", "word"])

    return docs.select("doc_id", "nth", "text").mapInArrow(run, "hash long, doc_id long, word long")


def neighbours(sorted_rows: DataFrame) -> DataFrame:
    """Of suffixes sorted within partitions by (hash, doc_id, word), those with an equal neighbour in the order. The
    first and last run of a partition may go on in the next one, so their rows pass too; windows decide later."""

    def run(batches):
        import pyarrow as pa

        # the last row is held back until its follower is seen; the first run of the partition always passes
        held, first, names = None, None, ["hash", "doc_id", "word"]
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("hash").to_numpy()
            if held is None:
                first, before = h[0], None
            else:
                before = held[0]
            same = h[1:] == h[:-1]
            keep = np.zeros(len(h), bool)
            keep[1:] |= same
            keep[:-1] |= same
            keep |= h == first
            if before is not None and h[0] == before:
                keep[0] = True
            if held is not None:
                if held[1] or h[0] == before:
                    yield held[2]
            last = batch.slice(len(h) - 1, 1).select(names)
            keep_last, keep[-1] = keep[-1], False
            yield batch.select(names).filter(pa.array(keep))
            held = (h[-1], keep_last, last)
        if held is not None:
            yield held[2]

    return sorted_rows.mapInArrow(run, "hash long, doc_id long, word long")


def positions(equal: DataFrame) -> DataFrame:
    """(doc_id, nth, at): per text its suffixes (word, split); split ones have a very common beginning."""
    total = equal.count()
    counts = equal.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    most = min(RUN, max(256, total // SPLIT))
    if total <= RUN * SPLIT:  # then few beginnings are above, whatever the table's size
        split = F.broadcast(counts.filter(F.col("n") > most).select("hash", F.lit(True).alias("split")))
        marked = equal.join(split, "hash", "left").withColumn("split", F.coalesce("split", F.lit(False)))
    else:
        marked = split_join(equal, written(counts, "counts"), ["hash"]).withColumn("split", F.col("n") > most)
    nth, word = F.shiftright("word", 32).cast("int").alias("nth"), F.col("word").bitwiseAND((1 << 32) - 1).cast("int").alias("word")
    return marked.groupBy("doc_id", nth).agg(F.collect_list(F.struct(word, "split")).alias("at"))


def contexts(docs: DataFrame, at: DataFrame, seed: int, least: int) -> DataFrame:
    """(doc_id, word, ahead, behind, split): the suffixes with the ids of the `least` words from each on and of the
    least - seed words before it, backwards, as big-endian 32-bit numbers; zero where the text has no word."""

    def run(batches):
        import pyarrow as pa

        ahead, behind = np.arange(least), -1 - np.arange(least - seed)
        for batch in rows_in_slices(batches, SLICE):
            words = Words(*arrow_bytes(batch.column("text")))
            ids = np.concatenate([np.maximum(words.hash >> np.uint64(32), np.uint64(1)).astype(">u4"), np.zeros(1, ">u4")])
            nothing = len(ids) - 1
            found = batch.column("at")
            n = np.diff(np.asarray(found.offsets))
            flat = found.flatten()
            word, split = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64), flat.field(1)
            row = np.repeat(np.arange(batch.num_rows), n)
            begin, end, docs_ = words.first[row], words.first[row + 1], batch.column("doc_id").take(pa.array(row))
            whole = (batch.column("nth").to_numpy().astype(np.int64)[row] << 32) + word
            for a in range(0, len(row), 4096):
                b = min(a + 4096, len(row))
                columns = []
                for steps in (ahead, behind):
                    place = (begin[a:b] + word[a:b])[:, None] + steps
                    place = np.where((place >= begin[a:b, None]) & (place < end[a:b, None]), place, nothing)
                    columns.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * len(steps)), b - a, [None, pa.py_buffer(ids[place].tobytes())]).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays([docs_.slice(a, b - a), pa.array(whole[a:b]), *columns, split.slice(a, b - a)], ["doc_id", "word", "ahead", "behind", "split"])

    key = ["doc_id", "nth"]
    some = docs.join(fits_broadcast(written(at.select(*key), "ids")), key, "left_semi")  # others' texts are not shuffled
    return some.join(at, key).select(*key, "text", "at").mapInArrow(run, "doc_id long, word long, ahead binary, behind binary, split boolean")


def alike(rows: np.ndarray) -> np.ndarray:
    """Of sorted rows of numbers, how many each has in common with the row before; 0 for the first."""
    differ = np.ones((len(rows), rows.shape[1] + 1), bool)
    differ[1:, :-1] = rows[1:] != rows[:-1]
    out = differ.argmax(axis=1)
    out[:1] = 0
    return out


def extended(doc: np.ndarray, word: np.ndarray, ahead: np.ndarray, behind: np.ndarray, least: int) -> list[np.ndarray]:
    """[doc, from, to, first, times] of passages around suffixes sorted by `ahead`, whose runs are complete: all windows
    of `least` words around a suffix that a suffix of another document has around it, overlapping ones as one."""
    n, most = len(doc), behind.shape[1]
    right = alike(ahead)
    order = np.argsort(np.ascontiguousarray(behind).view(f"S{4 * most}").reshape(-1), kind="stable") if most else np.arange(n)
    left = alike(behind[order])
    reach, back = (ahead != 0).sum(axis=1), (behind != 0).sum(axis=1)
    low, high, first, times = (np.full(n, v, np.int64) for v in (-1, -1, np.iinfo(np.int64).max, 0))
    for j in range(most + 1):
        going = np.cumsum(right < least - j)
        before = np.empty(n, np.int64)
        before[order] = np.cumsum(left < j)
        able = np.flatnonzero((reach >= least - j) & (back >= j))
        if not len(able):
            continue
        key = going[able] * (n + 1) + before[able]
        by = np.argsort(key, kind="stable")
        key, rows = key[by], able[by]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        lowest, highest = np.minimum.reduceat(doc[rows], starts), np.maximum.reduceat(doc[rows], starts)
        some = np.repeat(lowest < highest, sizes)
        hit = rows[some]
        low[hit] = np.where(low[hit] < 0, j, low[hit])
        high[hit] = j
        first[hit] = np.minimum(first[hit], np.repeat(lowest, sizes)[some])
        times[hit] = np.maximum(times[hit], np.repeat(sizes, sizes)[some])
    rows = np.flatnonzero(high >= 0)  # as most < least, all windows of a suffix overlap
    return [doc[rows], word[rows] - high[rows], word[rows] - low[rows] + least, first[rows], times[rows]]


PASSAGES = "doc_id long, from long, to long, first_doc_id long, occurrences long"
NAMES = [x.split()[0] for x in PASSAGES.split(", ")]


def matches(suffixes: DataFrame, seed: int, least: int) -> DataFrame:
    """PASSAGES around the suffixes, see extended: tasks hold whole beginnings, sorted by what follows."""

    def run(batches):
        import pyarrow as pa

        held: list = []

        def passages(table):
            ahead, behind = (np.frombuffer(b"".join(table.column(c).to_pylist()), ">u4").reshape(table.num_rows, -1) for c in ("ahead", "behind"))
            found = extended(table.column("doc_id").to_numpy(), table.column("word").to_numpy(), ahead, behind, least)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], NAMES)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < RUN:
                continue
            table = pa.Table.from_batches(held)
            begin = [x[: 4 * seed] for x in table.column("ahead").to_pylist()]
            cut = next((i for i in range(len(begin) - 1, 0, -1) if begin[i] != begin[i - 1]), 0)
            if cut:
                yield passages(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield passages(pa.Table.from_batches(held))

    dealt = suffixes.repartition(F.substring("ahead", 1, 4 * seed))
    return dealt.select("doc_id", "word", "ahead", "behind").sortWithinPartitions("ahead", "behind", "doc_id", "word").mapInArrow(run, PASSAGES.replace("from", "`from`").replace(" to ", " `to` "))


def counted_windows(suffixes: DataFrame, seed: int, least: int) -> DataFrame:
    """PASSAGES around suffixes of very common beginnings, of one window each: windows that
    are equal and have their suffix at the same place are counted map-side first,
    and windows that very many places hold are spread over tasks."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            ahead, behind = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(batch.num_rows, -1) for c in ("ahead", "behind"))
            doc, word = batch.column("doc_id").to_numpy(), batch.column("word").to_numpy()
            line = np.concatenate([behind[:, ::-1], ahead], axis=1).astype(np.uint64)
            width = line.shape[1]
            row, hashers = np.arange(len(doc)) * width, [range_hasher(line.reshape(-1), base) for base in ("P", "Q")]
            for j in range(behind.shape[1] + 1):
                begin = row + behind.shape[1] - j
                some = np.flatnonzero((line[:, behind.shape[1] - j] != 0) & (line[:, behind.shape[1] - j + least - 1] != 0))
                if len(some):
                    keys = [hasher(begin[some], begin[some] + least).astype(np.int64) for hasher in hashers]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, np.full(len(some), j, np.int32), doc[some], word[some] - j)], ["hash", "other", "back", "doc_id", "from"])

    windows = written(suffixes.select("doc_id", "word", "ahead", "behind").mapInArrow(run, "hash long, other long, back int, doc_id long, `from` long"), "windows")
    shared = windows.groupBy("hash", "other", "back").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.filter("first_doc_id <> _last").drop("_last"), "shared")
    met = split_join(windows, shared, ["hash", "other", "back"])
    return met.select("doc_id", "from", (F.col("from") + least).alias("to"), "first_doc_id", F.col("n").alias("occurrences"))


def code_points(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """passages (doc_id, from, to, ...) as (doc_id, start, stop, words, ...): start and stop are the code points where
    their words begin and end."""
    names = ("doc_id", "start", "stop", "words", "first_doc_id", "occurrences")

    def run(batches):
        import pyarrow as pa

        for batch in rows_in_slices(batches, SLICE):
            words = Words(*arrow_bytes(batch.column("text")))
            points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            found = batch.column("found")
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(found.offsets)))
            begin, end, first, times = (found.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            zero = points[words.offsets[row]]
            start = points[words.start[words.first[row] + begin]] - zero
            stop = points[words.end[words.first[row] + end - 1]] - zero
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), *(pa.array(x.astype(np.int64)) for x in (start, stop, end - begin, first, times))], names)

    low = (1 << 32) - 1
    one = F.struct(*[F.col(c).bitwiseAND(low).alias(c) for c in ("from", "to")], "first_doc_id", "occurrences")
    per = passages.groupBy("doc_id", F.shiftright("from", 32).cast("int").alias("nth")).agg(F.collect_list(one).alias("found"))
    per = F.broadcast(per) if passages.count() * 40 <= BROADCAST_BYTES else per
    return docs.join(per, ["doc_id", "nth"]).select("doc_id", "text", "found").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def numbered(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, text) with nth: 0, 1, ... among the texts of one doc_id."""
    again = written(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "again")
    if not again.limit(1).count():
        return docs.withColumn("nth", F.lit(0))
    again = fits_broadcast(again)
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("text")) - 1
    several = docs.join(again, "doc_id", "left_semi").distinct().withColumn("nth", place)
    return docs.join(again, "doc_id", "left_anti").withColumn("nth", F.lit(0)).unionByName(several)


def repeats(docs: DataFrame, least: int = 50, seed: int = SEED) -> DataFrame:
    """doc_id, start, stop (code points), words, first_doc_id, occurrences: one row per passage of a document of which
    every window of `least` words is also in another document; first_doc_id is the smallest document with any of
    the windows, occurrences the most places that hold one of them.

    Words are [^\\x20\\x09-\\x0D]+ and compared as they are, by 32-bit ids; white space between them may differ.
    Overlapping and touching passages are one. Null and empty texts and those under `least` words have none. Texts that
    repeat a doc_id are one document: each text is searched, and equal ones once. Rows with a null doc_id are ignored,
    as no result could name them. Extra columns are ignored; an empty table gives no rows."""
    docs = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), column_or_null(docs, "text", "string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    with arrow_batches(docs.sparkSession):
        docs = numbered(docs)
        rows = written(retained(docs, seed, least), "suffixes")
        n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        order = ("hash", "doc_id", "word")
        equal = written(neighbours(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)), "neighbours")
        suffixes = written(contexts(docs, positions(equal), seed, least), "contexts")
        found = matches(suffixes.filter("NOT split"), seed, least)
        if suffixes.filter("split").limit(1).count():
            found = found.unionByName(counted_windows(suffixes.filter("split"), seed, least))
        found = written(found, "matches")
        by = W.partitionBy("doc_id").orderBy("from", "to")
        before = F.coalesce(F.max("to").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
        runs = found.withColumn("_new", F.when(F.col("from") > before, 1).otherwise(0)).withColumn("_run", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
        out = runs.groupBy("doc_id", "_run").agg(F.min("from").alias("from"), F.max("to").alias("to"), F.min("first_doc_id").alias("first_doc_id"), F.max("occurrences").alias("occurrences"))
        return written(code_points(docs, written(out.drop("_run"), "passages")), "repeats")
