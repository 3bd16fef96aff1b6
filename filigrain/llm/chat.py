"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is rendered once as
the prompt; the rest of each is a completion with a mask over its assistant turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filigrain.llm.common import column_or_null, with_next

TURNS = "array<struct<role:string,text:string>>"
OPEN, BREAK, CLOSE = "<|", "|>\n", "<|end|>\n"


def render(turn: dict) -> str:
    return f"{OPEN}{turn['role']}{BREAK}{turn['text']}{CLOSE}"


def completion(turns: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns, and the code point spans that count for the loss: assistant texts with their close mark."""
    out, spans, at = [], [], 0
    for t in turns:
        text = render(t)
        if t["role"] == "assistant":
            spans.append((at + len(text) - len(t["text"]) - len(CLOSE), at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), spans


def format_pair(chosen: list[dict], rejected: list[dict]) -> tuple:
    """(prompt turns, prompt, chosen text, chosen mask, rejected text, rejected mask, usable)."""
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    (a, x), (b, y) = completion(chosen[n:]), completion(rejected[n:])
    return n, "".join(map(render, chosen[:n])), a, x, b, y, bool(x) and bool(y)


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pair_id, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask, usable for each row of pairs
    (pair_id, chosen, rejected: arrays of (role, text)).

    Masks are arrays of (start, stop) code points of the completion. A null role is `user`, a null text empty, a
    null conversation has no turns. Equal conversations share all turns and leave empty completions; such a pair,
    or one where a side has no assistant turn to learn from, is kept with usable = false. Nulls in pair_id and
    repeated rows pass through; extra columns are ignored; an empty table gives no rows."""
    spans = "array<struct<start:long,stop:long>>"

    def clean(turns):
        return [{"role": (t or {}).get("role") or "user", "text": (t or {}).get("text") or ""} for t in turns or []]

    def run(batches):
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            rows = [format_pair(clean(c), clean(r)) for c, r in zip(batch.column("chosen").to_pylist(), batch.column("rejected").to_pylist())]
            n, prompt, a, x, b, y, usable = zip(*rows) if rows else [[]] * 7
            x, y = ([[{"start": s, "stop": e} for s, e in m] for m in masks] for masks in (x, y))
            yield pa.RecordBatch.from_arrays(
                [batch.column("pair_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(prompt, pa.string()), pa.array(a, pa.string()), pa.array(x, span), pa.array(b, pa.string()), pa.array(y, span), pa.array(usable, pa.bool_())],
                ["pair_id", "prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask", "usable"],
            )

    narrow = pairs.select(column_or_null(pairs, "pair_id", "long").alias("pair_id"), F.col("chosen").cast(TURNS).alias("chosen"), F.col("rejected").cast(TURNS).alias("rejected"))
    return narrow.mapInArrow(run, f"pair_id long, prompt_turns long, prompt string, chosen string, chosen_mask {spans}, rejected string, rejected_mask {spans}, usable boolean")


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text), turns in order, ties by role and text; a conversation
    is rendered as one row, so its turns meet in one task."""
    role = F.coalesce(column_or_null(turns, "role", "string"), F.lit("user"))
    text = F.coalesce(column_or_null(turns, "text", "string"), F.lit(""))
    t = turns.select(column_or_null(turns, "conv_id", "long").alias("conv_id"), F.struct(column_or_null(turns, "turn", "long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    grouped = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def swapped_answers(turns: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) from plain conversations: chosen ends with the last assistant turn,
    rejected answers the same turns with the last assistant turn of the next conversation by ascending conv_id
    (the last is followed by the first). A conversation without an assistant turn is chosen whole; where the next
    has none, the rejected answer is empty."""
    c = conversations(turns)
    last = F.array_max(F.filter(F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i + 1)), lambda i: i.isNotNull()))
    c = c.withColumn("_last", F.coalesce(last, F.size("turns"))).withColumn("_has", last.isNotNull())
    c = c.withColumn("answer", F.when(F.col("_has"), F.try_element_at("turns", F.col("_last"))["text"]).otherwise(""))
    c = with_next(c, "conv_id", "answer", "answer")
    other = F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce("next_answer", F.lit("")).alias("text")))
    head = F.slice("turns", F.lit(1), F.col("_last") - F.when(F.col("_has"), 1).otherwise(0))
    return c.select(F.col("conv_id").alias("pair_id"), F.slice("turns", F.lit(1), F.col("_last")).alias("chosen"), F.concat(head, other).alias("rejected"))


def trailing_turns(turns: DataFrame) -> DataFrame:
    """pair_id, trailing_turns, trailing for every conversation: how many turns follow the last assistant turn, and their
    rendered text. They have no answer to learn from, so swapped_answers leaves them out of chosen."""
    c = conversations(turns)
    last = F.array_max(F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i + 1)))
    c = c.select("conv_id", F.slice("turns", F.coalesce(last, F.size("turns")) + 1, F.size("turns")).alias("t"))
    text = F.transform("t", lambda x: F.concat(F.lit(OPEN), x["role"], F.lit(BREAK), x["text"], F.lit(CLOSE)))
    return c.select(F.col("conv_id").alias("pair_id"), F.size("t").cast("long").alias("trailing_turns"), F.array_join(text, "").alias("trailing"))


def op1(turns: DataFrame) -> DataFrame:
    def text(mask: str):
        return F.array_join(F.transform(mask, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")

    out = format_preferences(swapped_answers(turns))
    return out.select("pair_id", "prompt_turns", "prompt", "chosen", text("chosen_mask").alias("chosen_mask"), "rejected", text("rejected_mask").alias("rejected_mask"), "usable")


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
), c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS l FROM t GROUP BY conv_id
), e AS (
  SELECT conv_id, l, list_max(list_filter(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN l[i].role = 'assistant' THEN i END), lambda i: i IS NOT NULL)) AS a FROM c
), f AS (
  SELECT conv_id, l, coalesce(a, len(l)) AS n, a IS NOT NULL AS has, CASE WHEN a IS NOT NULL THEN l[a].text ELSE '' END AS answer FROM e
), g AS (
  SELECT *, coalesce(lead(answer) OVER o, first_value(answer) OVER o) AS other FROM f WINDOW o AS (ORDER BY conv_id)
), p AS (
  SELECT conv_id, l[1:n] AS chosen, list_concat(l[1:n - has::INT], [{'role': 'assistant', 'text': other}]) AS rejected FROM g
), q AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[i] <> rejected[i])) - 1, least(len(chosen), len(rejected))) AS n FROM p
), r AS (
  SELECT conv_id, n, chosen[1:n] AS p, chosen[n + 1:] AS x, rejected[n + 1:] AS y FROM q
), s AS (
  SELECT conv_id, n,
    list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS rp,
    list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS rx,
    list_transform(y, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS ry, x, y FROM r
), m AS (
  SELECT *,
    list_filter(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN x[i].role = 'assistant' THEN
      (length(array_to_string(rx[1:i], '')) - length(x[i].text) - 8)::VARCHAR || '-' || length(array_to_string(rx[1:i], ''))::VARCHAR END), lambda v: v IS NOT NULL) AS mx,
    list_filter(list_transform(range(1, len(y) + 1), lambda i: CASE WHEN y[i].role = 'assistant' THEN
      (length(array_to_string(ry[1:i], '')) - length(y[i].text) - 8)::VARCHAR || '-' || length(array_to_string(ry[1:i], ''))::VARCHAR END), lambda v: v IS NOT NULL) AS my
  FROM s
)
SELECT conv_id AS pair_id, n::BIGINT AS prompt_turns, array_to_string(rp, '') AS prompt, array_to_string(rx, '') AS chosen, array_to_string(mx, ',') AS chosen_mask,
  array_to_string(ry, '') AS rejected, array_to_string(my, ',') AS rejected_mask, len(mx) > 0 AND len(my) > 0 AS usable
FROM m
"""
