"""Packing by minimum bin slack over a length histogram.

Windows are chosen on the driver from the histogram alone (as many counters as the window has tokens, whatever the
corpus): a bitset subset-sum dynamic program finds the fill closest to capacity around the longest remaining length,
the counts are backtracked, and the found window is repeated as often as the counts allow. A window without an exact
fill ends with a cut piece, whose rest goes back to the histogram. The executors then place each piece by its rank within
its length, so nothing but narrow ranks is ordered globally."""

from __future__ import annotations

import json
import re
from array import array
from collections import namedtuple
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F, Window as W

from filigrain.llm.common import arrow_batches, column_or_null, give_back, written

CAPACITY = 1024

#: `repeat` windows from window `first` on; counts: ((length, copies in each window), ...), longest first; cut: None or
#: (length, taken): each window ends with the first `taken` ids of one more piece of that length.
Pattern = namedtuple("Pattern", "first repeat counts cut")


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within counts, whose sum is closest to room without passing it.

    Each length enters a bitset subset-sum program as parts of 1, 2, 4, ... copies; the bitsets before each part are
    kept, and counts are read back from the last part, the longest lengths, to the first."""
    mask = (1 << (room + 1)) - 1
    reach, kept = 1, []
    for length in sorted(counts):
        if length > room:
            break
        left, part = min(counts[length], room // length), 1
        while left > 0:
            n = min(part, left)
            kept.append((reach, length, n))
            reach |= (reach << (n * length)) & mask
            left -= n
            part *= 2
    total, found = reach.bit_length() - 1, {}
    for before, length, n in reversed(kept):
        if total >= n * length and before >> (total - n * length) & 1:
            total -= n * length
            found[length] = found.get(length, 0) + n
    return found


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY, slack: int = 0) -> list[Pattern]:
    """Windows for a histogram of lengths up to capacity, around the longest remaining length each.

    What a best fill leaves open, if more than `slack`, is filled by cutting the longest piece that remains (none is
    short enough to fit whole, or the fill were better); its rest is a piece again, for later windows. So only the
    last window stays short."""
    left = {k: v for k, v in histogram.items() if v > 0}
    patterns, first = [], 0
    while left:
        seed = max(left)
        left[seed] -= 1
        counts = best_fill(left, capacity - seed)
        left[seed] += 1
        counts[seed] = counts.get(seed, 0) + 1
        room = capacity - sum(k * n for k, n in counts.items())
        cut = next((k for k in sorted(left, reverse=True) if left[k] > counts.get(k, 0)), None) if room > slack else None
        need = dict(counts)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        repeat = min(left[k] // n for k, n in need.items())
        patterns.append(Pattern(first, repeat, tuple(sorted(counts.items(), reverse=True)), (cut, room) if cut else None))
        first += repeat
        for k, n in need.items():
            left[k] -= n * repeat
            if not left[k]:
                del left[k]
        if cut:
            left[cut - room] = left.get(cut - room, 0) + repeat
    return patterns


class Placer:
    """Places pieces of known (length, rank) by a plan. The rests of cut pieces rank after the pieces of the histogram,
    in the order of the patterns that cut them, which is also the order in which patterns take ranks."""

    def __init__(self, patterns: list[Pattern], histogram: dict[int, int], capacity: int = CAPACITY):
        self.spans: dict[int, list[tuple]] = {}
        at: dict[int, int] = {}
        known = dict(histogram)
        for p in patterns:
            offset = 0
            for length, n in p.counts:
                begin = at.get(length, 0)
                self.spans.setdefault(length, []).append((begin, n, p.first, offset, length, 0))
                at[length] = begin + n * p.repeat
                offset += n * length
            if p.cut:
                length, taken = p.cut
                begin, rest = at.get(length, 0), known.get(length - taken, 0)
                self.spans.setdefault(length, []).append((begin, 1, p.first, offset, taken, rest))
                at[length] = begin + p.repeat
                known[length - taken] = rest + p.repeat
        self.begins = {k: np.array([s[0] for s in v]) for k, v in self.spans.items()}

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, window, offset) of the parts of one piece."""
        out, start = [], 0
        while length:
            begin, n, first, offset, taken, rest = self.spans[length][int(np.searchsorted(self.begins[length], rank, "right")) - 1]
            copy, which = divmod(rank - begin, n)
            out.append((start, taken, first + copy, offset + which * length))
            start, length, rank = start + taken, length - taken, rest + copy
        return out


#: The pre-token pattern of `tokenizers`' ByteLevel, and the printable bytes that stand for themselves.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes by id when a tokenizer's JSON is a plain byte-level BPE whose ids follow its merges; else None."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or spec.get("normalizer"):
        return None
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    code = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(code[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    joined = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return ranks if joined == sorted(joined) and len(ranks) == 256 + len(joined) else None


class Encoder:
    """Token ids of whole texts by a `tokenizers` file. Texts of a plain byte-level BPE are merged by tiktoken under
    the ranks read from that file, which gives the same ids in a fifth of the time (tests compare whole texts); any
    other file, and texts that hold the string of an added token, are left to `tokenizers`."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.kind is np.uint16 else "I"
        spec = json.loads(self.tokenizer.to_str())
        ranks = byte_ranks(spec)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.merge = None
        if ranks:
            import tiktoken

            self.merge = tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text; no end token is added."""
        if not self.merge:
            return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return [array(self.code, self.whole(t) if self.added and self.added.search(t) else self.merge(t)).tobytes() for t in texts]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per vocabulary file in a Python worker, which serves many tasks."""
    return Encoder(path)


def tokenised(docs: DataFrame, tokenizer: str, end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, doc_tokens, ids (little-endian, 2 or 4 bytes an id, with the end id), and for placing: _part,
    _full (ranks of whole windows start here) and _rest (rank among remainders of this length), within the part."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        own = encoder(tokenizer)
        width, part, full, rest = np.dtype(own.kind).itemsize, TaskContext.get().partitionId(), 0, {}
        ending = np.array([end], own.kind).tobytes()
        for batch in batches:
            texts, ids, n = batch.column("text").to_pylist(), batch.column("doc_id"), batch.num_rows
            begin = 0
            while begin < n:
                stop, chars = begin, 0
                while stop < n and (stop == begin or chars + len(texts[stop] or "") <= 1 << 20):
                    chars += len(texts[stop] or "")
                    stop += 1
                tokens = [x + ending for x in own.encode([t or "" for t in texts[begin:stop]])]
                counts = [len(x) // width for x in tokens]
                fulls, rests = [], []
                for c in counts:
                    fulls.append(full)
                    full += c // capacity
                    r = c % capacity
                    rests.append(rest.get(r, 0))
                    rest[r] = rests[-1] + 1
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, stop - begin).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(tokens, pa.binary()), pa.array([width] * len(counts), pa.int32()), pa.array([part] * len(counts), pa.int32()), pa.array(fulls, pa.int64()), pa.array(rests, pa.int64())],
                    ["doc_id", "doc_tokens", "ids", "width", "_part", "_full", "_rest"],
                )
                begin = stop
        give_back()

    narrow = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), column_or_null(docs, "text", "string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, doc_tokens long, ids binary, width int, _part int, _full long, _rest long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, slack: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, unsigned 32-bit
    little-endian). Sequences and offsets are gapless from 0; only the last sequence, and none but those within
    `slack`, can stay short of capacity.

    A null or empty text is its end id alone. Rows that repeat a doc_id are packed each. A null doc_id stays null.
    Extra columns are ignored; an empty table gives no rows."""
    with arrow_batches(docs.sparkSession):
        tokens = written(tokenised(docs, tokenizer, end, capacity), "tokens")
    rest = (F.col("doc_tokens") % capacity).cast("int")
    per = tokens.select("_part", rest.alias("_len"), F.floor(F.col("doc_tokens") / capacity).alias("_n")).groupBy("_part", "_len").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_n").alias("_fulls"))
    per = written(per, "lengths")
    hist = {r["_len"]: r["n"] for r in per.groupBy("_len").agg(F.sum("_rows").alias("n")).collect() if r["_len"]}  # below capacity rows
    fulls = per.agg(F.sum("_fulls")).first()[0] or 0
    if fulls:
        hist[capacity] = fulls
    plan = plan_windows(hist, capacity, slack)
    # where each part's ranks begin: windows over one row per part and length
    before = F.coalesce(F.sum("_rows").over(W.partitionBy("_len").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = per.select("_part", "_len", before.alias("_rest_base"))
    whole = per.groupBy("_part").agg(F.sum("_fulls").alias("_f"))
    whole = whole.select("_part", F.coalesce(F.sum("_f").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_full_base"))
    # one row per part: its bases by length, at most `capacity` entries
    maps = bases.groupBy("_part").agg(F.map_from_entries(F.collect_list(F.struct("_len", "_rest_base"))).alias("_bases")).join(whole, "_part")
    shared = docs.sparkSession.sparkContext.broadcast(json.dumps([plan, list(hist.items())]))

    def place(batches):
        import pyarrow as pa

        patterns, histogram = json.loads(shared.value)
        placer = Placer([Pattern(*p) for p in patterns], dict(histogram), capacity)
        for batch in batches:
            out = [[] for _ in range(7)]
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "ids", "width", "_full_rank", "_rest_rank")]
            for doc, n, ids, width, full, rest_rank in zip(*cols):
                ids = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32).astype("<u4")
                pieces = [(k * capacity, *placer.place(capacity, full + k)[0][1:]) for k in range(n // capacity)]
                begin = n // capacity * capacity
                if n > begin:
                    pieces += [(begin + s, *x) for s, *x in placer.place(n - begin, rest_rank)]
                for start, length, sequence, offset in pieces:
                    for column, v in zip(out, (doc, start, length, n, sequence, offset, ids[start : start + length].tobytes())):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out[:6]] + [pa.array(out[6], pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        give_back()

    ranked = tokens.join(F.broadcast(maps) if _small(maps, per) else maps, "_part").select(
        "doc_id", "doc_tokens", "ids", "width", (F.col("_full_base") + F.col("_full")).alias("_full_rank"), (F.coalesce(F.try_element_at("_bases", rest), F.lit(0)) + F.col("_rest")).alias("_rest_rank")
    )
    return ranked.mapInArrow(place, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _small(maps: DataFrame, per: DataFrame, most: int = 500_000) -> bool:
    """Whether the part and length counters are few enough to broadcast (about 16 bytes each)."""
    return per.count() <= most


def op2(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
