"""An index of the keys that a raw table holds, so that landing a batch costs what the batch needs.

The index lies beside the table and has two parts, both stored by bucket (a hash of the key):

* ``keys``: the keys themselves, as Parquet partitions, one per bucket;
* ``bloom``: per bucket, blocks of 32,768 bits. A key sets three bits of one block of its bucket.

A batch is first tested against the blocks of its buckets only. Keys that the blocks do not know are new. The
few that they may know are compared with the stored keys of the buckets that these keys are in; all other
partitions are pruned before the scan. So the answer is exact, and what is read of the target is two bytes a
key for the batch's buckets and the keys of the buckets in doubt.

The index follows the table: it lists the table's files that it covers, and before it is used it takes in the
keys of files that are not covered yet. Nothing has to be written with the rows, and a landing that dies at
any point leaves an index that the next one completes (a key taken in twice does no harm). If a covered file
is gone, or the blocks are filled beyond their size, the index is built anew as a new generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import registry
from .generations import Generations

BITS = 32_768  # of a block: what one bitmap aggregate holds
HASHES = 3
COVERED = "file string, keys long, buckets int, blocks int"


def index_path(table_path: str) -> str:
    home, _, name = table_path.rstrip("/").rpartition("/")
    return f"{home}/_index/{name}"


class KeyIndex:
    """The index of ``key`` of the Parquet table at ``table_path``.

    ``buckets`` is for the first build (the index remembers its own); ``keys_per_block`` gives a false
    positive rate of about one in 200, and the index is built anew when it holds four times as many.
    """

    def __init__(self, spark: SparkSession, table_path: str, key, buckets: int = 64, keys_per_block: int = 2048):
        self.spark, self.table_path = spark, table_path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.buckets, self.keys_per_block = buckets, keys_per_block
        self.generations = Generations(spark, index_path(table_path))
        self.folder: str | None = None
        self.blocks = 1

    # ------------------------------------------------------------------------------- places of a key
    def _hash(self, i: int) -> Column:
        return F.xxhash64(F.lit(i), *[F.col(k).cast("string") for k in self.key])

    def bucket(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.buckets)).cast("int")

    def _block(self) -> Column:
        return F.pmod(self._hash(1), F.lit(self.blocks)).cast("int")

    def _bits(self) -> list[Column]:
        return [F.pmod(self._hash(2 + i), F.lit(BITS)).cast("int") for i in range(HASHES)]

    # ------------------------------------------------------------------------------------- upkeep
    def _covered(self) -> dict[str, int]:
        """Files taken in, with their keys: as many rows as the table has files."""
        rows = self.spark.read.schema(COVERED).parquet(f"{self.folder}/covered").collect()
        for r in rows:
            self.buckets, self.blocks = r.buckets, r.blocks
        return {r.file: r["keys"] for r in rows}

    def refresh(self) -> "KeyIndex":
        """Take in what the table holds beyond the index."""
        if not registry.exists(self.spark, self.table_path):
            self.folder = None
            return self
        table = self.spark.read.parquet(self.table_path)
        files = set(table.inputFiles())
        self.folder = self.generations.current()
        covered = self._covered() if self.folder else {}
        room = 4 * self.buckets * self.blocks * self.keys_per_block
        if self.folder is None or set(covered) - files or sum(covered.values()) > room:
            keys = table.count()  # from the files' footers
            self.blocks = max(1, -(-2 * keys // (self.buckets * self.keys_per_block)))
            with self.generations.begin() as new:
                self._take(table, files, new.folder)
            self.folder = new.folder
        elif new_files := sorted(files - set(covered)):
            self._take(self.spark.read.schema(table.schema).parquet(*new_files), new_files, self.folder)
        return self

    def _take(self, table: DataFrame, files, folder: str) -> None:
        keys = table.select(*self.key).where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in self.key)))
        # The exchange splits a bucket that is large and joins small ones.
        placed = keys.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        placed.sortWithinPartitions("bucket", *self.key).write.mode("append").partitionBy("bucket").parquet(f"{folder}/keys")
        bits = keys.select(self.bucket().alias("bucket"), self._block().alias("block"),
                           F.explode(F.array(*self._bits())).alias("bit"))
        # Like the keys: a file per bucket, not one for each task and bucket; a look-up opens them all.
        blocks = bits.groupBy("bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        (blocks.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{folder}/bloom"))
        # Last: from here on these files count as covered. A file's own number of keys is not needed.
        each = -(-table.count() // max(1, len(files)))
        self.spark.createDataFrame([(f, each, self.buckets, self.blocks) for f in files], COVERED).coalesce(1).write.mode(
            "append").parquet(f"{folder}/covered")

    # ------------------------------------------------------------------------------------- look-up
    def _at(self, part: str, schema: str, buckets: list[int]) -> DataFrame:
        """A part's rows of these buckets; the other partitions are pruned when the scan is planned."""
        rows = self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.folder}/{part}")
        return rows.where(F.col("bucket").isin(buckets))

    def stored_keys(self, buckets: list[int]) -> DataFrame:
        table = self.spark.read.parquet(self.table_path)
        schema = ", ".join(f"`{k}` {table.schema[k].dataType.simpleString()}" for k in self.key)
        return self._at("keys", schema, buckets)

    @staticmethod
    def _touched(rows: DataFrame) -> list[int]:
        return sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # at most ``buckets`` rows

    def doubtful(self, batch: DataFrame) -> DataFrame:
        """(key, bucket) of the batch's keys that the blocks of their buckets may know."""
        placed = batch.select(*self.key, self.bucket().alias("bucket"), self._block().alias("block"),
                              *[b.alias(f"bit{i}") for i, b in enumerate(self._bits())])
        known = (self._at("bloom", "block int, bits binary", self._touched(placed))
                 .groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits")))
        hit = None
        for i in range(HASHES):
            byte = F.conv(F.hex(F.expr(f"substring(bits, bit{i} div 8 + 1, 1)")), 16, 10).cast("int")
            one = F.expr(f"shiftleft(1, bit{i} % 8)")
            hit = byte.bitwiseAND(one) != 0 if hit is None else hit & (byte.bitwiseAND(one) != 0)
        return placed.join(known, ["bucket", "block"]).where(hit).select(*self.key, "bucket")

    def present(self, batch: DataFrame) -> DataFrame:
        """The distinct keys of ``batch`` that the table holds. ``batch`` is read twice: store it first."""
        if self.folder is None:
            return batch.select(*self.key).limit(0)
        doubtful = stored(self.spark, self.doubtful(batch.select(*self.key).distinct()), "doubtful-keys")
        # The stored keys are on the streamed side: where the keys in doubt are few, the index is not exchanged.
        known = self.stored_keys(self._touched(doubtful))
        return known.join(doubtful, [*self.key, "bucket"], "left_semi").select(*self.key).distinct()

