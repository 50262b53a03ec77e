"""Chat formatting [DataFrame functions only]: prefix-target expansion.

A conversation is written as turn blocks ``<s>role\\ntext</s>\\n``. Every assistant turn becomes its own example: the
blocks of all preceding turns as context, then its own block, in which only the reply is trainable. As examples of
one conversation are prefixes of its full transcript, the expansion explodes positions and cuts each example
from the transcript, row by row; nothing but the transcript is ever held for a conversation.

A conversation whose last turn is not an assistant's gets one more example of all its turns with an empty
mask, so that the output holds every turn.

Control strings cannot occur inside a role or text: backslash, ``<``, ``[`` (and, in roles, line ends) are written as
``\\0``, ``\\1``, ``\\2`` (``\\3``), which ``unescape`` reverses.

Defined cases: null role or text counts as empty; turns are ordered by turn, then role, then text (null turns first);
repeated rows are repeated turns; rows of null ``conv_id`` form one conversation of null id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, ASSISTANT = "<s>", "</s>\n", "assistant"
#: fixed order: the backslash goes first when escaping and last when reversing
ESCAPES = [("\\", "\\0"), ("<", "\\1"), ("[", "\\2")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "\\3")]


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, transcript, marks: one row per conversation; ``marks`` has an entry per turn with its role and where
    its text and block end in the transcript (code points).

    The rows of a conversation have to meet, as every example holds all of its earlier turns."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    blocks = turns.select(
        "conv_id", "turn", empty("role").alias("role"), empty("text").alias("text")
    ).select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("t"),
    )
    ordered = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    block = lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + F.lit(len(CLOSE))
    ends = F.aggregate(
        F.transform("ts", size),
        F.array(F.lit(0).cast("long")),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
    )
    return ordered.select(
        "conv_id",
        F.array_join(F.transform("ts", block), "").alias("transcript"),
        F.transform(F.col("ts"), lambda t: F.struct(t["role"].alias("role"), F.length(t["body"]).cast("long").alias("n"))).alias("bodies"),
        ends.alias("ends"),
    ).select(
        "conv_id",
        "transcript",
        F.transform(
            "bodies",
            lambda b, i: F.struct(
                b["role"].alias("role"), b["n"].alias("n"), F.element_at(F.col("ends"), i + 2).alias("end")
            ),
        ).alias("marks"),
    )


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end, last: ``text[loss_start:loss_end]`` alone is trainable."""
    size = F.size("marks")
    cut = transcripts(turns).select("conv_id", "transcript", size.alias("turns"), F.posexplode("marks").alias("turn", "m"))
    wanted = cut.where((F.col("m.role") == ASSISTANT) | (F.col("turn") == F.col("turns") - 1))
    stop = F.col("m.end") - len(CLOSE)
    start = F.when(F.col("m.role") == ASSISTANT, stop - F.col("m.n")).otherwise(stop)
    return wanted.select(
        "conv_id",
        F.col("turn").alias("example"),
        F.expr("substring(transcript, 1, cast(m.end as int))").alias("text"),
        start.alias("loss_start"),
        stop.alias("loss_end"),
        (F.col("turn") == F.col("turns") - 1).alias("last"),
    )


def turns_of(text: Column) -> Column:
    """Read an example back: array of (role, text)."""
    blocks = F.split(text, CLOSE)
    inner = F.transform(
        F.slice(blocks, 1, F.size(blocks) - 1), lambda b: F.substring(b, F.lit(len(OPEN) + 1), F.length(b))
    )
    return F.transform(
        inner,
        lambda b: F.struct(
            unescape(F.substring_index(b, "\n", 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(b, F.instr(b, "\n") + 1, F.length(b))).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, end: Column) -> Column:
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def read_back(ex: DataFrame) -> DataFrame:
    """Per conversation, from its examples: turns (array), loss (the trainable text in order), formatted_chars."""
    piece = F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    return ex.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("text"))).alias("whole"),
        F.array_sort(F.collect_list(piece)).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        turns_of(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"),
        "formatted_chars",
    )
