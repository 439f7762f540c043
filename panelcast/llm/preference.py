"""Preference formatting: a shared prompt, and two masked completions. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatFormat:
    """How a turn is rendered: ``open`` role ``middle`` text ``close``; {role} names the role."""

    open: str = "<|{role}|>\n"
    close: str = "<|end|>\n"
    trained: tuple[str, ...] = ("assistant",)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as one array.

    Order is by turn, ties by role, then text; null turns come last. Null roles and texts are empty.
    Repeated rows are repeated turns. A conversation is one row of the result, so its turns meet in
    one task; nothing larger does. Rows without conv_id belong to no conversation.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("last"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    held = conversations.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return held.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def rejected_turns(turns: Column) -> Column:
    """The same conversation with an earlier answer in place of the last one.

    The last assistant turn ends it and gets the text of the assistant turn before; without one, its
    text is empty. Without any assistant turn the conversation is its own alternative.
    """
    answers = F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i)), lambda i: i.isNotNull())
    n = F.size(answers)
    last = F.get(answers, n - 1)
    before = F.get(turns, F.get(answers, n - 2))["text"]
    swapped = F.struct(F.lit("assistant").alias("role"), F.coalesce(before, F.lit("")).alias("text"))
    return F.when(n > 0, F.concat(F.slice(turns, F.lit(1), last), F.array(swapped))).otherwise(turns)


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations have in common from the start, role and text alike."""
    most = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), most), lambda i: (i == most) | ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return differ[0]


def rendered(turns: Column, chat: ChatFormat) -> Column:
    """The text of some turns."""
    return F.concat_ws("", F.transform(turns, lambda t: _turn(t, chat)))


def _head(turn: Column, chat: ChatFormat) -> Column:
    first, _, rest = chat.open.partition("{role}")
    return F.concat(F.lit(first), turn["role"], F.lit(rest)) if "{role}" in chat.open else F.lit(chat.open)


def _turn(turn: Column, chat: ChatFormat) -> Column:
    return F.concat(_head(turn, chat), turn["text"], F.lit(chat.close))


def trained_spans(turns: Column, chat: ChatFormat) -> Column:
    """Characters [start, end) of the rendered turns that a loss counts: trained roles' texts and closes."""
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(_head(turn, chat))
        end = start + F.length(turn["text"]) + len(chat.close)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"].isin(*chat.trained), F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, step, lambda acc: acc["spans"])


def preferences(pairs: DataFrame, chat: ChatFormat = ChatFormat()) -> DataFrame:
    """(…, prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans, differ) of each pair.

    ``pairs`` has columns chosen and rejected, arrays of (role, text); its other columns stay, but
    not those named like a result. The longest common prefix of turns is rendered once as ``prompt``;
    what follows on either side is its completion, of which only the spans are trained on. Nothing
    of the prompt is. Equal conversations have empty completions and ``differ`` false; empty and
    null arrays are conversations without turns.
    """
    none = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    ours = ("prompt_turns", "prompt", "chosen", "chosen_spans", "rejected", "rejected_spans", "differ")
    kept = [F.col(f"`{c}`") for c in pairs.columns if c.lower() not in ours]
    # the other columns travel as one struct, so none of theirs can clash
    own, back = ([F.struct(*kept).alias("kept")], ["kept.*"]) if kept else ([], [])
    both = pairs.select(*own, F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    both = both.withColumn("prompt_turns", common_turns(F.col("a"), F.col("b")))

    def rest(c: str) -> Column:
        return F.slice(c, F.col("prompt_turns") + 1, F.size(c))

    names = ["kept"] if kept else []
    split = both.select(*names, "prompt_turns", F.slice("a", F.lit(1), F.col("prompt_turns")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    return split.select(
        *back,
        "prompt_turns",
        rendered(F.col("p"), chat).alias("prompt"),
        rendered(F.col("a"), chat).alias("chosen"),
        trained_spans(F.col("a"), chat).alias("chosen_spans"),
        rendered(F.col("b"), chat).alias("rejected"),
        trained_spans(F.col("b"), chat).alias("rejected_spans"),
        ((F.size("a") > 0) | (F.size("b") > 0)).alias("differ"),
    )
