"""Preference formatting (operator 4).

A pair of conversations, one chosen and one rejected, shares its first turns.
The longest common prefix (equal role and text, turn by turn) is rendered once
as the prompt; the rest of each is its completion. Masks say which characters
of prompt + completion a model is trained on: the assistant's turns of the
completion, with the end mark.

All of it is column expressions over arrays of turns; gathering the turns is
the only shuffle. Null roles and texts render as empty and equal only nulls
and each other's nulls. A missing side is an empty conversation. Turns with
equal numbers are ordered by role and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def _head(t: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("")), F.lit("\n"))


def _body(t: Column) -> Column:
    return F.concat(F.coalesce(t["text"], F.lit("")), F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def _mask(turns: Column, start: Column) -> Column:
    """(at, n) of the trained characters of `turns`, which begin at `start`."""
    empty = F.array().cast("array<struct<at: int, n: int>>")

    def step(acc, t):
        at = acc["at"] + F.char_length(_head(t))
        n = F.char_length(_body(t))
        span = F.array(F.struct(at.alias("at"), n.alias("n")))
        return F.struct((at + n + 1).alias("at"),
                        F.when(t["role"] == TRAINED, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(start.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Turns of the longest common prefix."""
    same = F.zip_with(a, b, lambda x, y: (x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"])
                                          & x["text"].eqNullSafe(y["text"])))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """pairs, whose columns `chosen` and `rejected` are arrays of (role, text),
    with: n_common, prompt, chosen_completion, rejected_completion, chosen_mask,
    rejected_mask (in place of columns of these names)."""
    none = F.array().cast(pairs.schema[chosen].dataType)
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    out = pairs.withColumn("n_common", common_turns(a, b))
    n = F.col("n_common")
    rest = (lambda turns: F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0))))
    out = out.withColumn("prompt", render(F.slice(a, F.lit(1), n)))
    at = F.char_length("prompt")
    return out.withColumns({"chosen_completion": render(rest(a)), "rejected_completion": render(rest(b)),
                            "chosen_mask": _mask(rest(a), at), "rejected_mask": _mask(rest(b), at)})


def conversation_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """pair_id, chosen, rejected: conversation 2k against 2k + 1. Rows without
    conversation are left out."""
    c = F.col(conv).cast("long")
    one = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    side = (lambda odd: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("_odd") == odd, F.col("_turn")))),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    return (turns.where(c.isNotNull())
            .select(F.shiftright(c, 1).alias("pair_id"), F.pmod(c, F.lit(2)).alias("_odd"), one.alias("_turn"))
            .groupBy("pair_id").agg(side(0).alias("chosen"), side(1).alias("rejected")))
