"""Operator 10: mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources in code-point order (null last) weigh 5, 2, 1, repeating. Targets share all words by weight; none
exceeds ``max_passes`` times its source, and what that leaves is shared by weight among the others. That
is one level L with target = min(max_passes * size, weight * L), found from running sums over the sources.

A source's documents are dealt to blocks by hash. Whole passes over a source draw every block; what is
left of the target draws the blocks of a random order until it is reached, the last one in part. The
numbers of blocks drawn from each source are split exactly among the output shards by a tree that halves
the shards and draws how much of each quota goes left; each shard then takes its quota of disjoint
blocks in random order. ``output`` deals the copies out and shuffles them within the shards.

Up to ``max_sources`` sources, counted first, the driver and a broadcast hold one row per source. Beyond it
sources and quotas stay tables: the sources are numbered range by range, the level comes from repeated
sums, and the tree is drawn in two steps with the same law. The driver splits the totals of groups of about
``max_sources`` sources, and one task per group splits each group's part among its sources.

Defined results: a null or empty text has size 0 and is in the mix when its place in the order says so,
taking no words; a source without words has target 0; repeated rows count each; a null source is a
source. The result depends on the rows and the seed only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import joined_words, stored, word_count
from .hypergeometric import split_tree


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (5, 2, 1)
    max_passes: int = 3
    shards: int = 8
    block_rows: int = 1000       # documents in a block, until a source has max_blocks
    max_blocks: int = 1_000_000  # blocks of one source; their table is never collected or broadcast
    max_sources: int = 100_000   # on the driver and broadcast up to this many rows of about 200 bytes
    seed: int = 20240310


def measure(docs: DataFrame, settings: Settings, source: str = "source", text: str = "text") -> DataFrame:
    """``row`` (all columns), ``skey`` (the source, never null), ``size`` in words, and the hash ``h``."""
    hashed = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        # The order of these keys is the order of the sources, null last.
        F.coalesce(F.concat(F.lit("0"), F.col(f"`{source}`")), F.lit("1")).alias("skey"),
        word_count(joined_words(F.col(f"`{text}`"))).alias("size"),
        F.xxhash64(F.lit(settings.seed), *hashed).alias("h"))


def _hash(settings: Settings, *cols) -> Column:
    return F.xxhash64(F.lit(settings.seed + 1), *cols)


def totals(sizes: DataFrame) -> DataFrame:
    """One row per source: its words and how many documents it has."""
    return sizes.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))


def _weighed(sources: DataFrame, place: Column, settings: Settings) -> DataFrame:
    listed = F.array(*[F.lit(float(w)) for w in settings.weights])
    weighed = sources.withColumn("weight", F.element_at(listed, (place % len(settings.weights) + 1).cast("int")))
    limit = (F.lit(settings.max_passes) * F.col("source_size")).cast("double")
    return weighed.withColumn("limit", limit).withColumn("ratio", limit / F.col("weight"))


def targets(sources: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """From ``totals`` of at most ``max_sources`` sources, a row for each: ``source_size``, ``target``, how many
    whole ``passes`` and the words ``left`` for a part of a pass, and the number of its ``blocks``."""
    weighed = _weighed(sources, F.row_number().over(Window.orderBy("skey")) - 1, settings)
    before = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()

    def total(c):
        return F.sum(c).over(everyone)

    level = (total(F.col("source_size")) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        total(F.col("weight")) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    capped = weighed.withColumn("capped", F.col("ratio") < level)
    free = F.when(~F.col("capped"), F.col("weight"))
    rest = (total(F.col("source_size")) - total(F.when(F.col("capped"), F.col("limit")).otherwise(0.0))) / total(free)
    return _passes(capped.withColumn("rest", rest), settings)


def targets_by_range(sources: DataFrame, ranges: int, settings: Settings = Settings()) -> DataFrame:
    """What ``targets`` gives, for any number of sources: no task holds more than one of the ``ranges``."""
    spark = sources.sparkSession
    # Written, so that a source's range is settled.
    ranged = stored(spark, sources.repartitionByRange(ranges, "skey").withColumn(
        "range", F.spark_partition_id()), "mix-ranges")
    counts = ranged.groupBy("range").agg(F.count("*").alias("held"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = counts.select("range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("skey")) - 1
    numbered = ranged.withColumn("inside", inside).join(starts, "range")
    weighed = stored(spark, _weighed(numbered, F.col("start") + F.col("inside"), settings), "mix-weights")
    # The level rises as sources reach their limits; it is found when no further source does.
    level, known = F.lit(-1.0), -1
    while True:
        is_capped = F.col("ratio") < level
        r = weighed.agg(
            F.count_if(is_capped).alias("capped"), F.sum("source_size").cast("double").alias("words"),
            F.sum(F.when(is_capped, F.col("limit")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(~is_capped, F.col("weight"))).alias("weight")).first()
        rest = (r["words"] - r["taken"]) / r["weight"] if r["weight"] else 0.0
        if r["capped"] == known:
            break
        known, level = r["capped"], F.lit(rest)
    return _passes(weighed.withColumn("capped", is_capped).withColumn("rest", F.lit(rest)), settings)


def _passes(capped: DataFrame, settings: Settings) -> DataFrame:
    out = capped.withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(
        F.least("limit", F.col("weight") * F.col("rest"))))
    passes = F.when(F.col("source_size") > 0, F.least(
        F.lit(settings.max_passes), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0)).cast("int")
    out = out.withColumn("passes", passes)
    left = F.when(F.col("passes") < settings.max_passes, F.col("target") - F.col("passes") * F.col("source_size"))
    blocks = F.least(F.lit(settings.max_blocks), F.ceil(F.col("n") / settings.block_rows)).cast("int")
    return out.select("skey", "source_size", "target", "passes", F.coalesce(left, F.lit(0.0)).alias("left"),
                      blocks.alias("blocks"))


def _small(df: DataFrame, rows: int, settings: Settings) -> DataFrame:
    return F.broadcast(df) if rows <= settings.max_sources else df


CUTS = "skey string, cuts array<bigint>"


def _slots(every: int, shards: int) -> list[int]:
    return [every // shards + (j < every % shards) for j in range(shards)]


def _ends(tree: list[list[int]], quotas: int) -> list[list[int]]:
    """For each quota, where it is cut among the shards."""
    ends = np.cumsum(np.array(tree, dtype=np.int64).reshape(len(tree), quotas), axis=0)
    return [[int(x) for x in ends[:-1, i]] for i in range(quotas)]


def _cuts(quotas: DataFrame, settings: Settings) -> DataFrame:
    """Where each source's draws are cut among the shards; the quotas are on the driver."""
    rows = [(r["skey"], int(r["q"])) for r in quotas.orderBy("skey").collect()]
    tree = split_tree(np.random.default_rng(settings.seed), [q for _, q in rows],
                      _slots(sum(q for _, q in rows), settings.shards))
    return quotas.sparkSession.createDataFrame(
        [(k, cut) for (k, _), cut in zip(rows, _ends(tree, len(rows)), strict=True)], CUTS)


def _cuts_by_group(quotas: DataFrame, groups: int, settings: Settings) -> DataFrame:
    """The same law in two steps: the groups' totals are split among the shards, then within a task each
    group's part among its sources. The driver holds a row per group."""
    spark, seed = quotas.sparkSession, settings.seed
    grouped = quotas.withColumn("group", F.pmod(_hash(settings, "skey"), F.lit(groups)))
    sums = [(r["group"], int(r["q"])) for r in grouped.groupBy("group").agg(F.sum("q").alias("q")).orderBy("group").collect()]
    tree = split_tree(np.random.default_rng(seed), [q for _, q in sums], _slots(sum(q for _, q in sums), settings.shards))
    parts = spark.createDataFrame([(g, [int(row[i]) for row in tree]) for i, (g, _) in enumerate(sums)],
                                  "`group` bigint, slots array<bigint>")

    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("skey")
        rng = np.random.default_rng([seed, int(group["group"].iloc[0])])
        drawn = split_tree(rng, [int(q) for q in group["q"]], [int(x) for x in group["slots"].iloc[0]])
        return pd.DataFrame({"skey": group["skey"], "cuts": _ends(drawn, len(group))})

    return stored(spark, grouped.join(parts, "group").groupBy("group").applyInPandas(split, CUTS), "mix-cuts")


def plan(sizes: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, int]:
    """From (skey, size, h): the sources' rows; and a row per block with the shards that draw it, the
    words drawn ``before`` it in the part of a pass, and that part's shard; and the number of sources."""
    spark = sizes.sparkSession
    counted = stored(spark, totals(sizes), "mix-totals")
    n = counted.count()
    groups = -(-n // settings.max_sources)
    if groups <= 1:
        kind = "skey string, source_size long, target double, passes int, left double, blocks int"
        chosen = [tuple(r) for r in targets(counted, settings).orderBy("skey").collect()]
        sources = spark.createDataFrame(chosen, kind)
    else:
        sources = stored(spark, targets_by_range(counted, groups, settings), "mix-sources")
    small = _small(sources, n, settings)
    dealt = sizes.join(small.select("skey", "blocks"), "skey").withColumn("block", block_of())
    blocks = dealt.groupBy("skey", "block").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("skey").orderBy(_hash(settings, "skey", "block"), "block")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.withColumn("before", F.sum("words").over(running) - F.col("words"))
    blocks = blocks.join(small.select("skey", "passes", "left"), "skey").withColumn(
        "part", (F.col("before") < F.col("left")).cast("int"))
    blocks = stored(spark, blocks.select("skey", "block", "before", "passes", "part"), "mix-blocks")

    # The quotas: how many blocks are drawn from each source, over all its passes.
    quotas = blocks.groupBy("skey").agg(F.sum(F.col("passes") + F.col("part")).alias("q"))
    cuts = _cuts(quotas, settings) if groups <= 1 else _cuts_by_group(quotas, groups, settings)
    # Each draw of a block gets a place in its source's random order; the quotas cut that order.
    draws = blocks.withColumn("draw", F.explode(F.sequence(F.lit(0), F.col("passes") + F.col("part")))).filter(
        F.col("draw") < F.col("passes") + F.col("part"))
    place = F.row_number().over(Window.partitionBy("skey").orderBy(
        _hash(settings, "skey", "block", "draw"), "block", "draw")) - 1
    placed = draws.withColumn("place", place).join(_small(cuts, n, settings), "skey").select(
        "skey", "block", "draw", F.size(F.filter("cuts", lambda c: c <= F.col("place"))).alias("shard"))
    drawn = placed.groupBy("skey", "block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("draw", "shard"))), lambda x: x["shard"]).alias("shards"))
    return sources, blocks.join(drawn, ["skey", "block"], "left"), n


def block_of() -> Column:
    return F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")


def mix(docs: DataFrame, settings: Settings = Settings(), source: str = "source", text: str = "text") -> DataFrame:
    """All columns of ``docs`` in ``row``; ``size``, ``source_size``, ``target``, the ``shards`` that get a
    copy of the document, and ``taken``, the words that the mix takes from it."""
    measured = measure(docs, settings, source, text)
    # The narrow part is read several times: words are counted once for it.
    return mix_measured(measured, stored(docs.sparkSession, measured.select("skey", "size", "h"), "mix-sizes"), settings)


def mix_measured(measured: DataFrame, sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``mix`` of what ``measure`` gave; ``sizes`` are its columns (skey, size, h)."""
    sources, blocks, n = plan(sizes, settings)
    dealt = measured.join(_small(sources, n, settings), "skey").withColumn("block", block_of())
    # Rows that agree in this order are equal, so either may come first.
    inside = Window.partitionBy("skey", "block").orderBy(_hash(settings, "h"), "h").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.withColumn("upto", F.sum("size").over(inside))
    dealt = dealt.join(blocks.select("skey", "block", "before", "part", "shards"), ["skey", "block"])
    # The nearest end to what is left: the document is in when its middle is.
    extra = (F.col("part") == 1) & (F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("left"))
    copies = F.col("passes") + extra.cast("int")
    shards = F.coalesce(F.slice("shards", F.lit(1), copies), F.array().cast("array<int>"))
    return dealt.select("row", "size", "source_size", "target", shards.alias("shards"),
                        (F.col("size") * copies).alias("taken"), "h")


def output(docs: DataFrame, settings: Settings = Settings(), source: str = "source", text: str = "text") -> DataFrame:
    """The mix: each document as often as it was drawn, together by shard and in random order there."""
    mixed = mix(docs, settings, source, text).select("row", "h", F.posexplode("shards").alias("copy", "shard"))
    by = F.xxhash64(F.lit(settings.seed + 2), "h", "copy")
    keyed = mixed.withColumn("by", by).withColumn("part", F.pmod(F.xxhash64("by"), F.lit(settings.max_blocks)))
    return keyed.repartition("shard", "part").sortWithinPartitions("shard", "by").select("row.*")
