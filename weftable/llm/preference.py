"""Chat formatting of preference pairs.

Each pair has a chosen and a rejected conversation. Their longest common prefix of equal turns (role and
text) is rendered once as the prompt; what follows becomes two completions in which only the assistant's
text and its end mark count for the loss, given as spans of code points. Only built-in functions are used.

Defined cases: a null role is ``user``, a null text is empty; turns are ordered by number, ties by role
and text, and compared by place, so gaps in the numbers do not matter; rows without pair id or side are
left out, as are other sides; a pair with one side has no common prefix; equal conversations have empty
completions; an empty table gives no rows. A role or text containing the marks is rendered as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
SIDES = ("chosen", "rejected")


def _header(role: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"))


def preference_pairs(turns: DataFrame, pair: str, side: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per pair from one row per turn.

    The place of the first difference is a minimum over turns, summed up before it is shuffled; a
    conversation's turns come together only to be written as the one string they have to be.
    """
    own = turns.select(
        F.col(pair).alias("pair_id"),
        F.col(side).alias("side"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("user")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter(F.col("pair_id").isNotNull() & F.col("side").isin(*SIDES))
    placed = own.withColumn(
        "place", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")).cast("long")
    )
    at = placed.groupBy("pair_id", "place").agg(
        *[F.max(F.when(F.col("side") == s, F.struct("role", "text"))).alias(s) for s in SIDES]
    )
    pairs = at.groupBy("pair_id").agg(
        F.min(F.when(~F.col("chosen").eqNullSafe(F.col("rejected")), F.col("place"))).alias("differs"),
        F.count("*").alias("places"),
        *[
            F.sort_array(F.collect_list(F.when(F.col(s).isNotNull(), F.struct("place", f"{s}.role", f"{s}.text")))).alias(s)
            for s in SIDES
        ],
    )
    common = F.coalesce(F.col("differs") - 1, F.col("places")).alias("common_turns")
    cut = pairs.select("pair_id", common, *SIDES)
    shown = cut.select(
        "pair_id",
        "common_turns",
        F.filter("chosen", lambda t: t["place"] <= F.col("common_turns")).alias("prompt"),
        *[F.filter(s, lambda t: t["place"] > F.col("common_turns")).alias(s) for s in SIDES],
    )
    return shown.select(
        "pair_id",
        "common_turns",
        _rendered(F.col("prompt")).alias("prompt"),
        *[_rendered(F.col(s)).alias(f"{s}_text") for s in SIDES],
        *[_spans(F.col(s)).alias(f"{s}_spans") for s in SIDES],
    )


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t["role"]), t["text"], F.lit(END + "\n"))), "")


def _spans(turns: Column) -> Column:
    """``start:end`` of what the assistant writes, end exclusive, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + F.length(_header(t["role"]))
        last = first + F.length(t["text"]) + len(END)
        span = F.concat_ws(":", first.cast("string"), last.cast("string"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((last + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: chosen as it is, rejected with the last answer of its neighbour.

    Neighbours differ in the last bit of ``conv_id``. Without a neighbour, or if either has no answer,
    the rejected side is cut before the last answer.
    """
    own = conversations.select("conv_id", "turn", "role", "text").filter(F.col("conv_id").isNotNull())
    last = own.filter(F.col("role") == "assistant").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("instead"), F.lit(True).alias("has"))
    joined = own.join(last, "conv_id", "left").join(other, "conv_id", "left")
    answer = (F.col("role") == "assistant") & (F.col("turn") == F.col("last.turn"))
    answer = F.coalesce(answer, F.lit(False))
    columns = ["conv_id", "side", "turn", "role", "text"]
    chosen = joined.withColumn("side", F.lit("chosen")).select(*columns)
    rejected = (
        joined.filter(F.col("last").isNull() | F.coalesce(F.col("turn") < F.col("last.turn"), F.lit(False)) | (answer & F.col("has")))
        .withColumn("text", F.when(answer, F.col("instead")).otherwise(F.col("text")))
        .withColumn("side", F.lit("rejected"))
        .select(*columns)
    )
    return chosen.unionByName(rejected)
