"""Operator 3, chat formatting: budgeted, turn-aligned windows of conversations, in DataFrame functions only.

Template: a turn is ``<|t|>role<|x|>text<|e|>``; a turn that an earlier window has already is ``<|r|>role<|x|>text<|e|>``. Control
strings of this and of common other templates inside roles and texts are escaped by a backslash after their first
character (one more than they have already), so no text can end or begin a turn, and the escape is reversible.

Windows: turns cost their tokens and four for their marks. Prefix sums of the costs are cut greedily: a turn that no
longer fits the budget begins a window. Every later window repeats the system turn, if the conversation begins with
one, and as many of the last ``HISTORY_TURNS`` turns before it as fit ``history``. Repeated turns are never under the loss
mask; assistant turns are, once. A single turn over the budget has a window of its own.

Tokens are counted natively: letters by six, digits and marks one by one. One conversation is one row while it is cut:
its turns are in order and its digest spans them all, so its size is bounded by a row's, not by this operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.llm._common import table

BUDGET = 1_024
HISTORY = 128
HISTORY_TURNS = 8
MARKS = 4

#: What follows "<" or "[" in control strings of this and other chat templates.
CONTROL = r"\||/?s>|/?INST\]|/?SYS>|/?(?:unk|pad|bos|eos|mask)>|/?(?:start|end)_of_turn>"
TOKEN = r"[\p{L}\p{M}]{1,6}|\p{N}|[^\s\p{L}\p{M}\p{N}]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={CONTROL})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={CONTROL})", r"$1$2")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window int, formatted string, loss_spans array<struct<start int, end int>>, cost int``; spans count code points.

    Turns come in the order of ``turn``, a null one first, ties by role and text. Defined cases: null text and role are empty; a
    null conv_id is one conversation; repeated rows are turns of their own; a very long turn has a window of its own, which is
    over the budget; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    body, role = escape(F.coalesce("text", F.lit(""))), escape(F.coalesce("role", F.lit("")))
    turn = F.struct("turn", role.alias("role"), body.alias("body"), (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN)) + MARKS).alias("cost"))
    talks = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("ts"))
    talks = talks.withColumn("sys", F.expr("if(ts[0].role = 'system', 1, 0)")).withColumn("sysc", F.expr("if(sys = 1, ts[0].cost, 0)"))
    starts = f"""
        if(size(ts) > sys, aggregate(sequence(sys, size(ts) - 1), named_struct('used', 0, 's', array(sys)),
          (a, i) -> if(a.used > 0 and a.used + ts[i].cost > {budget} - sysc - if(size(a.s) > 1, {history}, 0),
            named_struct('used', ts[i].cost, 's', concat(a.s, array(i))), named_struct('used', a.used + ts[i].cost, 's', a.s)), a -> a.s), array(sys))"""
    windows = f"""
        transform(starts, (s, w) -> named_struct('w', w, 'a', if(w = 0, 0, s), 'e', if(w + 1 < size(starts), starts[w + 1], size(ts)),
          'h', if(w = 0, 0, size(filter(sequence(1, least({HISTORY_TURNS}, s - sys)), k -> aggregate(slice(ts, s - k + 1, k), 0, (x, t) -> x + t.cost) <= {history})))))"""
    blocks = """
        transform(windows, v -> named_struct('w', v.w, 'blocks', concat(
          transform(slice(ts, 1, if(v.w > 0, sys, 0)), t -> named_struct('kind', 'r', 'role', t.role, 'body', t.body, 'cost', t.cost)),
          transform(slice(ts, v.a - v.h + 1, v.h), t -> named_struct('kind', 'r', 'role', t.role, 'body', t.body, 'cost', t.cost)),
          transform(slice(ts, v.a + 1, v.e - v.a), t -> named_struct('kind', 't', 'role', t.role, 'body', t.body, 'cost', t.cost)))))"""
    cut = talks.withColumn("starts", F.expr(starts)).withColumn("windows", F.expr(windows)).select("conv_id", F.explode(F.expr(blocks)).alias("x"))
    spans = """
        aggregate(blocks, named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int>>)),
          (a, b) -> named_struct('at', a.at + 15 + char_length(b.role) + char_length(b.body), 'spans',
            if(b.kind = 't' and b.role = 'assistant', concat(a.spans, array(named_struct('start', a.at + 10 + char_length(b.role), 'end', a.at + 10 + char_length(b.role) + char_length(b.body)))), a.spans)),
          a -> a.spans)"""
    text = "array_join(transform(blocks, b -> concat('<|', b.kind, '|>', b.role, '<|x|>', b.body, '<|e|>')), '')"
    rows = cut.select("conv_id", F.col("x.w").alias("window"), F.col("x.blocks").alias("blocks"))
    return rows.select("conv_id", "window", F.expr(text).alias("formatted"), F.expr(spans).alias("loss_spans"), F.expr("aggregate(blocks, 0, (x, b) -> x + b.cost)").alias("cost"))


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, window, turns array<struct<role, text>>, loss array<string>``: what the formatted text says, repeated turns left out."""
    own = F.filter(F.split("formatted", r"<\|e\|>"), lambda b: F.startswith(b, F.lit("<|t|>")))
    turns = F.transform(own, lambda b: F.struct(unescape(F.substring_index(F.substr(b, F.lit(6)), "<|x|>", 1)).alias("role"), unescape(F.substring_index(b, "<|x|>", -1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "window", turns.alias("turns"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    parts = read_back(windows).select(
        "conv_id", "chars", F.size("turns").cast("long").alias("n"),
        F.struct("window", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"), F.array_join("loss", "").alias("loss")).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("part")).alias("parts"))
    said, loss = F.array_join("parts.said", ""), F.array_join("parts.loss", "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return whole.select("conv_id", "n_turns", digest(said).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), digest(loss).alias("loss_sha256"), "formatted_chars")


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations as read back from their windows; cases as in ``format_windows``."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], said.schema)
    return conversation_digests(format_windows(said.unionAll(more)))
