"""Operator 8: chat formatting after collapsing cumulative snapshots.

A chat log often holds a conversation again after each turn. Every turn gets a rolling hash of the turns
up to it (128 bits: two exclusive-or sums of hashes labelled with the turn's place). A conversation whose
full hash is the prefix hash of a longer one is dropped by an anti-join, equal conversations keep the
smallest id, and the maximal ones are rendered.

Prefix hashes are made distinct before the join, so a first turn that a third of all conversations share
is one row in it. Defined results: turns are ordered by number (null first), then by the hash of role and
text; a null role reads ``unknown``, a null text is empty; a row without an id is a conversation of one turn
by itself, which any longer or equal one that has an id takes in; equal ones without an id are one;
repeated turns stay; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"


def _turns(log: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    # The role's length comes first, so no other role and text give the same bytes.
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return log.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(said).alias("what"))


def prefix_hashes(log: DataFrame) -> DataFrame:
    """(conv_id, n, of, a, b) for each turn of a named conversation: its place, the conversation's length, the rolling hash."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "what")
    numbered = _turns(log).filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", "what", F.row_number().over(order).alias("n"),
        F.count("*").over(Window.partitionBy("conv_id")).alias("of"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.select("conv_id", "n", "of", *[
        F.bit_xor(F.xxhash64(F.lit(i), "n", "what")).over(so_far).alias(name) for i, name in enumerate("ab")])


def _single(log: DataFrame) -> DataFrame:
    """The rows without an id as conversations of one turn, equal ones once: (what, role, text, n, a, b)."""
    alone = _turns(log).filter(F.col("conv_id").isNull()).groupBy("what").agg(
        F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    one = F.lit(1)
    return alone.select("what", "role", "text", one.alias("n"),
                        *[F.xxhash64(F.lit(i), one, "what").alias(name) for i, name in enumerate("ab")])


def maximal(log: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the named conversations that are neither a prefix of another nor a copy of one
    with a smaller id."""
    hashes = prefix_hashes(log)
    whole = hashes.filter("n = of").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = hashes.filter("n < of").select("n", "a", "b").distinct()
    return whole.join(inner, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"))


def render(log: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat) of the maximal conversations."""
    begin, middle, end = TURN.partition("{role}")[0], "\n", TURN.partition("{text}")[2]

    def shown(role, text):
        return F.concat(F.lit(begin), role, F.lit(middle), text, F.lit(end))

    kept = maximal(log).withColumnRenamed("conv_id", "kept_id")
    turns = _turns(log).join(kept, F.col("conv_id") == F.col("kept_id"))
    chat = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "what", "role", "text"))), lambda t: shown(t["role"], t["text"])), "")
    named = turns.groupBy("conv_id", "n_turns").agg(chat.alias("chat"))
    known = prefix_hashes(log).filter("n = 1").select("n", "a", "b").distinct()
    alone = _single(log).join(known, ["n", "a", "b"], "left_anti").select(
        F.lit(None).cast(log.schema["conv_id"].dataType).alias("conv_id"), F.lit(1).cast("long").alias("n_turns"),
        shown(F.col("role"), F.col("text")).alias("chat"))
    return named.unionByName(alone)
