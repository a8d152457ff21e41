"""Chat formatting by prefix-target expansion, in native expressions.

A conversation becomes one string of turns, `[INST]role[/INST]text</s>` each, kept as an
array of segments with a loss flag. Control strings inside roles and texts get one more
backslash after their first character (`</s>` becomes `<\\/s>`, `<\\/s>` becomes
`<\\\\/s>`), which is reversible for every text.

Every assistant turn is an example of its own: all turns before it are context and only
its text is trainable. An example refers to its context by length, a prefix of the
conversation's string, so that a conversation of n turns costs n rows and not n*n texts;
`materialise` writes prompts out where they are wanted.

Defined results. Null text or role: empty. Turns order by turn (null first), then role,
then text, which settles ties and repeated rows. Null conversation ids: one conversation.
No assistant turn: a formatted conversation without examples. Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisio.plans.lineage import Scratch

#: The template's control strings.
OPEN, CLOSE, END, BEGIN = "[INST]", "[/INST]", "</s>", "<s>"
_CONTROL = r"/?s>|/?INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_CONTROL})", r"$1$2$3")


def format_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", assistant: str = "assistant") -> DataFrame:
    """One row per conversation: id, segments (array of text, loss), formatted (their concatenation)."""
    part = lambda text, loss=None: F.struct(text.alias("text"), (F.lit(False) if loss is None else loss).alias("loss"))
    rows = turns.select(F.col(conv_col), F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        part(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE))),
        part(escape(t["text"]), t["role"] == F.lit(assistant)),
        part(F.lit(END)),
    )))
    return grouped.select(conv_col, segments.alias("segments")).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def expand(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per assistant turn: id, example (from 0), segment, context_chars, target (escaped), by reference to its prefix."""
    before = Window.partitionBy(conv_col).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0).cast("long"))
    segments = formatted.select(conv_col, F.posexplode("segments").alias("segment", "s")).select(conv_col, "segment", "s.text", "s.loss")
    counted = segments.withColumns({"context_chars": so_far(F.length("text").cast("long")), "example": so_far(F.col("loss").cast("long")).cast("int")})
    return counted.where("loss").select(conv_col, "example", "segment", "context_chars", F.col("text").alias("target"))


def materialise(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per assistant turn with its whole prompt: id, example, prompt, target, both as the template has them."""
    spans = expand(formatted, conv_col)
    return spans.join(formatted.select(conv_col, "formatted"), spans[conv_col].eqNullSafe(formatted[conv_col])).select(
        spans[conv_col], "example", F.substring("formatted", F.lit(1), F.col("context_chars").cast("int")).alias("prompt"), "target"
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), unescaped, from a conversation's string."""
    pieces = F.split(formatted, END, -1)
    heads = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # nothing stands after the last end mark
    return F.transform(heads, lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)^\[INST\](.*?)\[/INST\]", 1)).alias("role"),
        unescape(F.regexp_extract(p, r"(?s)^\[INST\].*?\[/INST\](.*)$", 1)).alias("text"),
    ))


def digests(turns: DataFrame, **columns: str) -> DataFrame:
    """What the written conversations and examples say when they are read back, one row per conversation.

    Turns come from the formatted strings, the text under the loss mask from the targets of the examples.
    """
    scratch, conv = Scratch(turns.sparkSession, "chat"), columns.get("conv_col", "conv_id")
    formatted = scratch.cut(format_conversations(turns, **columns), "formatted")
    examples = scratch.cut(expand(formatted, conv), "examples")
    told = examples.groupBy(F.col(conv).alias("told_by")).agg(F.sort_array(F.collect_list(F.struct("example", "target"))).alias("told"))
    read = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.coalesce(F.array_join(F.transform("told", lambda e: unescape(e["target"])), ""), F.lit(""))
    return formatted.select(conv, "formatted").join(told, F.col(conv).eqNullSafe(F.col("told_by")), "left").select(
        conv, read.alias("read"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"), F.when(F.col("told").isNull(), 0).otherwise(F.size("told")).cast("long").alias("n_examples")
    ).select(
        conv, F.size("read").cast("long").alias("n_turns"), F.sha2(F.array_join("read", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars", "n_examples",
    )
