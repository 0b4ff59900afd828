"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, its text the only part under the loss mask. A
conversation that does not end with an assistant turn has one more row without a target, so that no turn is lost.

Template: ``<|turn|>role<|text|>text<|end|>``. In roles and texts a backslash is doubled and every control string (of this
template and of other common ones) gets a backslash after its first character; ``unescaped`` is the exact inverse.

Null roles and texts count as empty. Turns are ordered by turn (null first), then role and text, so ties and repeated rows have
a defined order and all stay. A row without conv_id is a conversation of its own. An empty table gives an empty result.
A conversation must fit into one row, as each of its examples must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed strings of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Fixed control strings that are escaped: their first character and the rest, as patterns.
CONTROL = r"<(?=\||s>|/s>|<SYS>>|</SYS>>)|\[(?=INST\]|/INST\])"
TARGET_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Text without raw control strings."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_key`` (unique), ``conv_id`` and its turns in order, escaped."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.when(F.col("conv_id").isNull(), F.concat(F.lit("row:"), F.monotonically_increasing_id().cast("string"))) \
        .otherwise(F.concat(F.lit("id:"), F.col("conv_id").cast("string")))
    return rows.select(key.alias("conv_key"), "conv_id", turn.alias("t")).groupBy("conv_key") \
        .agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list("t")).alias("turns"))


def examples(rows: DataFrame) -> DataFrame:
    """conv_key, conv_id, example (number of the last turn, from 1), n_turns, formatted, loss_start (from 1; 0: no target),
    loss_len. The loss mask covers code points loss_start .. loss_start + loss_len - 1 of ``formatted``."""
    segment = lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT), escaped(t["text"]), F.lit(END))
    conv = conversations(rows).withColumn("n_turns", F.size("turns")) \
        .withColumn("segments", F.transform("turns", segment)) \
        .withColumn("targets", F.filter(F.sequence(F.lit(1), F.col("n_turns")), lambda i: F.col("turns")[i - 1]["role"] == TARGET_ROLE))
    ends = F.when(F.array_contains("targets", F.col("n_turns")), F.col("targets")).otherwise(F.concat("targets", F.array("n_turns")))
    out = conv.select("conv_key", "conv_id", "n_turns", "segments", "turns", F.explode(ends).alias("example")) \
        .withColumn("last", F.col("turns")[F.col("example") - 1]) \
        .withColumn("is_target", F.col("last")["role"] == TARGET_ROLE)
    formatted = F.array_join(F.slice("segments", F.lit(1), F.col("example")), "")
    tail = F.length(escaped(F.col("last")["text"]))
    return out.withColumn("formatted", formatted) \
        .withColumn("loss_len", F.when(F.col("is_target"), tail).otherwise(0)) \
        .withColumn("loss_start", F.when(F.col("is_target"), F.length("formatted") - len(END) - tail + 1).otherwise(0)) \
        .select("conv_key", "conv_id", "example", "n_turns", "formatted", "loss_start", "loss_len")


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted text."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda s: s != "")
    return F.transform(pieces, lambda s: F.struct(
        unescaped(F.regexp_replace(F.substring_index(s, TEXT, 1), r"^<\|turn\|>", "")).alias("role"),
        unescaped(F.substring_index(s, TEXT, -1)).alias("text")))


def digest(formatted_rows: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted examples alone: turns, their digest, the text under the loss mask, its digest."""
    target = unescaped(F.expr("substring(formatted, loss_start, loss_len)"))
    parts = formatted_rows.select(
        "conv_key", "conv_id", "example", F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("loss_start") > 0, target).alias("target"),
        F.when(F.col("example") == F.col("n_turns"), F.col("formatted")).alias("whole"))
    joined = parts.groupBy("conv_key").agg(
        F.first("conv_id").alias("conv_id"), F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda x: F.coalesce(x["target"], F.lit(""))), "").alias("loss"))
    turns = joined.withColumn("turns", read_back(F.col("whole")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
