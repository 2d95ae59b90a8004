"""Preference pairs from chosen and rejected conversations.

The longest common turn prefix of a pair is rendered once as the prompt; the
turns after it are rendered as two completions with masks that cover what the
model is trained on: the text and end mark of assistant turns.

Native DataFrame code: one shuffle gathers a conversation's turns into its
record, pairs are equi-joins on conversation ids, the rest are array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The chat marks.
OPEN, SHUT = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as one record.

    Order is by turn number (null last), role, text; a null role is "unknown", a
    null text empty; chat marks inside texts are broken up. Repeated rows stay.
    Rows without conversation id belong to none."""
    c = lambda n: F.col(f"`{n}`")
    one = F.struct(c(turn).isNull().alias("late"), c(turn).alias("turn"), F.coalesce(c(role), F.lit("unknown")).alias("role"),
                   F.replace(F.coalesce(c(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    return (turns.where(c(conv).isNotNull()).groupBy(c(conv).alias("conv_id"))
            .agg(F.array_sort(F.collect_list(one)).alias("raw"))
            .select("conv_id", F.transform("raw", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                    .alias("turns")))


def common_prefix(a: str, b: str) -> Column:
    """Number of leading turns that agree in role and text."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                      lambda i: ~F.get(F.col(a), i).eqNullSafe(F.get(F.col(b), i)))
    return F.when(n == 0, F.lit(0)).otherwise(F.coalesce(F.get(differ, F.lit(0)), n))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(SHUT))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """Trained spans (start, end) in code points of the rendered turns."""
    span = "struct<start:int,end:int>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + len(OPEN) + F.length(t["role"]) + 1
        end = start + F.length(t["text"]) + len(SHUT)
        own = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(f"array<{span}>")
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["spans"], own))
                        .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, zero, add, lambda acc: acc["spans"])


def preference_rows(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen_turns, rejected_turns): pair_id, prompt_turns,
    prompt, chosen, rejected, chosen_mask, rejected_mask.

    Equal conversations give two empty completions; where one is a prefix of
    the other, the shorter one's completion is empty. Without a common turn the
    prompt is empty. Repeated pairs stay; an empty table gives no rows."""
    cut = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.size(c))
    p = pairs.withColumn("prompt_turns", common_prefix("chosen_turns", "rejected_turns"))
    p = p.select("pair_id", "prompt_turns", F.slice("chosen_turns", F.lit(1), F.col("prompt_turns")).alias("head"),
                 F.when(F.size("chosen_turns") > 0, cut("chosen_turns")).otherwise(F.col("chosen_turns")).alias("c"),
                 F.when(F.size("rejected_turns") > 0, cut("rejected_turns")).otherwise(F.col("rejected_turns")).alias("r"))
    return p.select("pair_id", "prompt_turns", render(F.col("head")).alias("prompt"), render(F.col("c")).alias("chosen"),
                    render(F.col("r")).alias("rejected"), mask(F.col("c")).alias("chosen_mask"),
                    mask(F.col("r")).alias("rejected_mask"))


def swapped_halves(convs: DataFrame) -> DataFrame:
    """Pairs for tables without preferences: conversation c is chosen; rejected
    is its first half followed by the other half of its neighbour (c xor 1).
    Conversations without neighbour give no pair."""
    other = convs.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("other"))
    half = F.floor(F.size("turns") / 2).cast("int")
    return (convs.withColumn("pair_id", F.col("conv_id").bitwiseXOR(F.lit(1).cast("long"))).join(other, "pair_id")
            .select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen_turns"),
                    F.concat(F.slice("turns", F.lit(1), half), F.slice("other", half + 1, F.size("other")))
                    .alias("rejected_turns")))


def spans_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))),
                        ",")
