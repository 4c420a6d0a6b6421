"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, adjacent turns of one role are merged by an
array aggregation, and the text is built by concatenation::

    <|start|>ROLE<|message|>TEXT[<|sep|>TEXT ...]<|end|>

``<|sep|>`` separates the texts of merged turns.  In roles and texts ``&`` becomes ``&amp;``
and ``<|`` becomes ``&lt;|``, so no control string can come from data, and unescaping
(``&lt;`` first, ``&amp;`` last) gives back every character.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, MESSAGE, SEP, END = "<|start|>", "<|message|>", "<|sep|>", "<|end|>"


def _quoted(s: str) -> str:
    return s.replace("|", "\\|")


def escape(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def merge_turns(turns) -> F.Column:
    """array<struct<role, texts>> with adjacent turns of the same role merged, texts escaped."""
    empty = F.lit(None).cast("array<struct<role:string,texts:array<string>>>")

    def step(acc, t):
        last = F.element_at(acc, -1)
        same = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["role"] == t["role"])
        grown = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(t["text"])).alias("texts"))
        fresh = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        return F.when(same, F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(acc, F.array(fresh)))

    return F.aggregate(turns, F.coalesce(empty, F.array().cast("array<struct<role:string,texts:array<string>>>")), step)


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", learn_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (array of start, length).

    Spans count code points from 0 and cover the (escaped) texts of ``learn_role`` only, neither
    marks nor separators.  Turns are ordered by turn, then role, then text; a null turn comes
    first, null role and text count as empty, null conversation ids form one conversation.
    Repeated rows are repeated turns.  Other columns are not read; no rows give no rows.
    """
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"),
                    escape(F.coalesce(F.col(f"`{role_col}`"), F.lit(""))).alias("role"),
                    escape(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"))
    chats = conversations.groupBy(F.col(f"`{conv_col}`").alias(conv_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    merged = chats.select(conv_col, merge_turns(F.col("turns")).alias("merged"))

    def piece(m):
        return F.concat(F.lit(START), m["role"], F.lit(MESSAGE), F.array_join(m["texts"], SEP), F.lit(END))

    def spans(acc, m):
        """acc: position so far and spans so far"""
        at0 = acc["at"] + F.length(m["role"]) + F.lit(len(START) + len(MESSAGE))
        inner = F.aggregate(m["texts"], F.struct(at0.alias("at"), acc["spans"].alias("spans")), lambda a, t: F.struct(
            (a["at"] + F.length(t) + F.lit(len(SEP))).alias("at"),
            F.when(m["role"] == escape(F.lit(learn_role)), F.concat(a["spans"], F.array(F.struct(
                a["at"].alias("start"), F.length(t).alias("length"))))).otherwise(a["spans"]).alias("spans")))
        return F.struct((inner["at"] + F.lit(len(END) - len(SEP))).alias("at"), inner["spans"].alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    return merged.select(
        conv_col, F.array_join(F.transform("merged", piece), "").alias("formatted"),
        F.aggregate("merged", F.struct(F.lit(0).alias("at"), none.alias("spans")), spans)["spans"].alias("loss_spans"))


def read_back(formatted) -> F.Column:
    """array<struct<role, text>> of the original turns, from the formatted text alone."""
    parts = F.split(formatted, _quoted(START))
    turns = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def one(t):
        halves = F.split(F.replace(t, F.lit(END), F.lit("")), _quoted(MESSAGE))
        return F.transform(F.split(F.get(halves, F.lit(1)), _quoted(SEP)), lambda x: F.struct(
            unescape(F.get(halves, F.lit(0))).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(turns, one))


def masked_text(formatted, spans) -> F.Column:
    """Unescaped text under the loss mask, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def chat_digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations give when read again: turns and loss text as digests."""
    got = formatted.select(conv_col, "formatted", read_back(F.col("formatted")).alias("turns"),
                           masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
