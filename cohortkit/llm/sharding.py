"""Operator 4: uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

The law is ``rows``: shard sizes differ by one at most. Rows are dealt to blocks by a hash. The matrix
says how many rows of each block go to each shard: a multivariate hypergeometric draw per block from
what the shards still lack, so its row sums are the blocks' sizes, its column sums the shards' sizes,
and all assignments are equally likely. A block permutes its rows and cuts them by its row of the
matrix; the rows are exchanged, and each shard permutes what it got, in slots without a gap.

The matrix has at most ``max_blocks`` rows and is drawn on the driver from the blocks' counts. A shard's
second permutation is by a random key: buckets of keys are counted, and a row's slot is the count of the
buckets before plus its place in its own. So no task holds a block or bucket larger than its share.

Defined results: an empty table gives an empty table; null or empty texts are rows like others; repeated
rows get slots of their own. The result depends on the rows and the seed only, not on their partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hypergeometric import draw_many


@dataclass(frozen=True)
class Settings:
    shards: int = 8
    block_rows: int = 1000   # rows in a block or bucket, until there are max_blocks of them
    max_blocks: int = 4096   # rows of the matrix; bounds what the driver and a broadcast hold
    seed: int = 20240229


def communication_matrix(blocks: list[int], settings: Settings) -> list[list[int]]:
    """Rows of each block that go to each shard."""
    rng = np.random.default_rng(settings.seed)
    n, k = sum(blocks), settings.shards
    lacking = [n // k + (j < n % k) for j in range(k)]
    out = []
    for size in blocks:
        got = draw_many(rng, lacking, size)
        lacking = [a - b for a, b in zip(lacking, got, strict=True)]
        out.append(got)
    return out


def deal(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``rows`` in the struct ``row``, with its shard (from 0) and slot (from 0)."""
    spark = rows.sparkSession
    hashed = [f"`{c}`" for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]

    def key(i):
        return F.xxhash64(F.lit(settings.seed + i), *hashed)

    n = rows.count()
    parts = max(1, min(settings.max_blocks, -(-n // settings.block_rows)))
    buckets = max(1, min(settings.max_blocks, -(-n // (settings.block_rows * settings.shards))))
    # A third key decides between rows in one block: blocks and order must not depend on each other.
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                        F.pmod(key(0), F.lit(parts)).cast("int").alias("block"), key(1).alias("by"),
                        F.pmod(key(2), F.lit(buckets)).cast("int").alias("bucket"), key(3).alias("then_by"))
    counts = {r["block"]: r["n"] for r in keyed.groupBy("block").agg(F.count("*").alias("n")).collect()}
    blocks = sorted(counts)
    matrix = communication_matrix([counts[b] for b in blocks], settings)
    cuts = spark.createDataFrame(
        [(b, [int(x) for x in np.cumsum(m)[:-1]]) for b, m in zip(blocks, matrix, strict=True)],
        "block int, cuts array<bigint>")
    ties = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.row_number().over(Window.partitionBy("block").orderBy("by", *[F.col(f"row.`{c}`") for c in ties])) - 1
    # At most max_blocks rows of `shards` numbers.
    dealt = keyed.withColumn("place", place).join(F.broadcast(cuts), "block").select(
        "row", "bucket", "then_by", F.size(F.filter("cuts", lambda c: c <= F.col("place"))).alias("shard"))
    before = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(
        "then_by", *[F.col(f"row.`{c}`") for c in ties])) - 1
    # At most shards * max_blocks rows of three numbers.
    return dealt.withColumn("inside", inside).join(F.broadcast(before), ["shard", "bucket"]).select(
        "row", "shard", (F.col("before") + F.col("inside")).alias("slot"))
