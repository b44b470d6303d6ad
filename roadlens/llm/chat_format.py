r"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts. A visitor walks the parts in order: text stays as it is,
image, audio and document parts become numbered placeholders, and each of these leaves an attachment
(ordinal, kind, reference, expanded token count). Turns are then put between marks:

    <|turn|>role<|says|>content<|done|>\n

Control strings inside roles and texts are escaped by a backslash after their first character, and
backslashes are doubled; ``unescape`` takes that back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>\n"
#: What a text may not hold unescaped. Marks of other common templates are among them.
CONTROL = r"(<)(?=\||/?s>)|(\[)(?=/?INST\])"
PART = "array<struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
#: Expanded tokens of one attachment.
PATCH, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 512


def escape(text: Column) -> Column:
    r"""Backslashes doubled, then a backslash put into each control string: ``<|`` becomes ``<\|``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    """The inverse of escape."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """Plain text as an array of one text part; null is the empty text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("long").alias("width"), F.lit(None).cast("long").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("long").alias("pages"),
        )
    )


def _tokens(part: Column) -> Column:
    """Tokens that a placeholder stands for once it is expanded."""
    side = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / F.lit(PATCH))
    return (
        F.when(part["kind"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(TOKENS_A_SECOND)))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * F.lit(TOKENS_A_PAGE))
        .otherwise(F.lit(0))
        .cast("long")
    )


def flatten_parts(content: Column) -> Column:
    """Visit parts in order: struct(body, attachments array<struct<ordinal,kind,ref,n_tokens>>).

    The body holds escaped text and placeholders ``<|image:0|>`` numbered from 0 within the turn. A
    part of an unknown kind, or a null part, adds nothing; a text part without text is empty.
    """
    parts = F.filter(F.coalesce(content, F.array().cast(PART)), lambda p: p["kind"].isin("text", "image", "audio", "document"))
    media = F.filter(parts, lambda p: p["kind"] != "text")
    attachments = F.transform(
        media, lambda p, i: F.struct(i.cast("long").alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("n_tokens"))
    )
    start = F.struct(F.lit("").alias("body"), F.lit(0).alias("n"))
    walked = F.aggregate(
        parts,
        start,
        lambda s, p: F.when(p["kind"] == "text", F.struct(F.concat(s["body"], escape(F.coalesce(p["text"], F.lit("")))).alias("body"), s["n"].alias("n"))).otherwise(
            F.struct(F.concat(s["body"], F.lit("<|"), p["kind"], F.lit(":"), s["n"].cast("string"), F.lit("|>")).alias("body"), (s["n"] + 1).alias("n"))
        ),
    )
    return F.struct(walked["body"].alias("body"), attachments.alias("attachments"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content", spoken: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, n_turns, n_media_tokens.

    ``loss_spans`` are (start, length) in code points over ``formatted``; they cover the content of
    the turns of role ``spoken`` and nothing of the marks. Turns are ordered by turn, nulls first,
    ties by role and content. Null roles and contents are empty; rows with a null conversation form
    one conversation of their own; an empty table gives an empty result; extra columns are ignored.
    A conversation is one output string, so its turns meet in one row; conversations are spread.
    """
    flat = flatten_parts(F.col(content))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), flat.alias("flat"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("flat.body").alias("body"), F.col("flat.attachments").alias("attachments")))).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS)).alias("head"), t["body"].alias("body"), (t["role"] == spoken).alias("loss")))
    sized = grouped.withColumn("pieces", pieces).withColumn(
        "ends",
        F.aggregate(
            "pieces",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
            lambda s, p: F.struct(
                (s["at"] + F.length(p["head"]) + F.length(p["body"]) + F.lit(len(DONE))).alias("at"),
                F.when(p["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length")))))
                .otherwise(s["spans"]).alias("spans"),
            ),
        ),
    )
    media = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(i.cast("long").alias("turn_index"), a["ordinal"].alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")))))
    return sized.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(DONE))), "").alias("formatted"),
        F.col("ends.spans").alias("loss_spans"),
        media.alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate(F.transform(media, lambda a: a["n_tokens"]), F.lit(0).cast("long"), lambda s, n: s + n).alias("n_media_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Read a formatted string back: array of struct(role, text), unescaped; placeholders stay in text."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p, SAYS, 1)).alias("role"),
            unescape(F.regexp_replace(F.substr(p, F.instr(p, F.lit(SAYS)) + F.lit(len(SAYS))), r"<\|done\|>\n\z", "")).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and concatenated."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
