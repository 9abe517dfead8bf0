"""Chat rendering with a grammar that is checked by reading it back.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. The parser accepts exactly that
grammar and undoes escapes. Rendering starts without escapes; where the turns read back differ
from the source, conflicting content is escaped and the conversation is rendered again:

0. as it is;
1. a backslash is put into every ``<|`` of a text (``<|`` and ``<\\|`` become ``<\\|`` and ``<\\\\|``);
2. the same in roles, whose backslashes and newlines are also written as ``\\s`` and ``\\n``.

The last level is reversible for every text, so the loop ends there. All of it is SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
#: A role that no source has: it marks a piece outside the grammar.
BROKEN = "\u0000broken"
LEVELS = 3


def guard(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unguard(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def guard_role(role: Column) -> Column:
    return guard(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unguard_role(role: Column) -> Column:
    return F.replace(F.replace(unguard(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def render(turns: Column, level: int) -> Column:
    def one(turn: Column) -> Column:
        text = guard(turn["text"]) if level >= 1 else turn["text"]
        role = guard_role(turn["role"]) if level >= 2 else turn["role"]
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns of a rendered conversation; what breaks the grammar becomes a turn of role ``BROKEN``."""
    tail = END + "\n"

    def one(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.length(piece) - len(tail))
        line = F.locate("\n", body)
        good = piece.endswith(tail) & (line > 0) & ~body.contains(END)
        role = F.when(good, unguard_role(F.substring(body, F.lit(1), line - 1))).otherwise(F.lit(BROKEN))
        text = F.when(good, unguard(F.substring(body, line + 1, F.length(body)))).otherwise(piece)
        return F.struct(role.alias("role"), text.alias("text"))

    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    first = F.when(pieces[0] == "", F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))).otherwise(pieces)
    return F.transform(first, one).cast(TURNS)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``level`` and ``turns`` read back.

    Turns are ordered by turn number, then role, then text; null numbers come first. A null role
    or text is empty; a null ``conv_id`` is a conversation of its own; repeated rows are repeated
    turns. An empty table gives no row. A conversation is one value of one row, as its digest needs.
    """
    source = (
        turns.select(
            "conv_id",
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            ).alias("one"),
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("one")).alias("rows"))
        .select("conv_id", F.expr("transform(rows, r -> struct(r.role as role, r.text as text))").cast(TURNS).alias("source"))
    )
    state = source.select("conv_id", "source", render(F.col("source"), 0).alias("formatted"), F.lit(0).alias("level"))
    for level in range(1, LEVELS):
        state = state.withColumn("same", parse(F.col("formatted")) == F.col("source")).select(
            "conv_id",
            "source",
            F.when(F.col("same"), F.col("formatted")).otherwise(render(F.col("source"), level)).alias("formatted"),
            F.when(F.col("same"), F.col("level")).otherwise(F.lit(level)).alias("level"),
        )
    return state.select("conv_id", "formatted", "level", parse(F.col("formatted")).alias("turns"))


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digests of what is read back from ``formatted``; loss lies on the texts of assistant turns."""
    said = F.expr("transform(filter(turns, t -> t.role = 'assistant'), t -> t.text)")
    lines = F.expr("transform(turns, t -> concat(t.role, '\\n', t.text, '\\n'))")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(F.array_join(said, "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
