"""Incremental, restartable landing of arriving JSON files (Structured Streaming).

New files in ``in_dir`` are picked up at most ``files_per_trigger`` at a time; each
micro-batch is parsed with the batch reader's rules, bad rows go to a quarantine
table, and good rows are appended to the target with insert-or-ignore on the key.

Exactly-once in effect: the file source and the checkpoint make each file belong to
one batch id; if a batch is re-run after a failure, the anti-join against the
target drops the rows that already landed, so a retry never duplicates.  Dedup is
against the target table, not against streaming state, so state does not grow; the
key index beside the target spares reading its keys per batch.

Run one landing stream per target: the anti-join is not a lock, so two concurrent
writers to the same target could both insert a key that neither saw yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..sources import readers, registry
from ..sources.ingest import insert_ignore
from ..sources.keyindex import KeyIndex

KINDS = {
    "reviews": (S.REVIEW_JSON, readers.parse_reviews, "review_id"),
    "users": (S.USER_JSON, readers.parse_users, "user_id"),
}


def _target_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The landed table; empty only if it is not there yet (any other failure is an error)."""
    return spark.read.schema(like.schema).parquet(path) if registry.exists(spark, path) else like.limit(0)


def land_batch(batch: DataFrame, batch_id: int, kind: str, target: str, quarantine: str,
               load_ts=None) -> None:
    """Land one micro-batch: parse, quarantine bad rows, append new keys only.

    Safe to re-run for the same batch: rows already in the target are skipped.
    """
    _, parse, key = KINDS[kind]
    # The micro-batch feeds two writes (landed rows and quarantine): read and parse its files once.
    batch = readers.with_arrival(batch) if "_metadata" in batch.columns else batch
    parsed = []
    good, rejected = parse(batch, keep=lambda rows: parsed.append(rows.persist()) or parsed[0])
    ts = F.lit(str(load_ts)).cast("timestamp_ntz") if load_ts is not None else F.localtimestamp()
    good = good.withColumn("loaded_at", ts)
    # What is appended must have the target's columns; an unreadable target is an error.
    present = _target_or_empty(batch.sparkSession, target, good.drop(readers.ARRIVAL))
    index = KeyIndex(batch.sparkSession, target, key).refresh()
    # The first occurrence of a key by file and place in it wins, as in a row-by-row insert.
    new_rows = insert_ignore(good, None, key, readers.ARRIVAL, index).select(*present.columns)
    new_rows.write.mode("append").parquet(target)
    # Quarantine rows are keyed by batch id; a re-run replaces its own batch's rows.
    (rejected.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}"))
    parsed[0].unpersist()


def stream_ingest(spark: SparkSession, in_dir: str, kind: str, target: str, quarantine: str,
                  checkpoint: str, bytes_per_trigger: int = 64 << 30, available_now: bool = True,
                  load_ts=None, files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing stream; returns the running query (``awaitTermination`` it).

    Every trigger tests its keys against the target's key index; triggers are sized by bytes: few and large.
    """
    schema, _, _ = KINDS[kind]
    size = ("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else ("maxBytesPerTrigger", bytes_per_trigger)
    source = (spark.readStream
              .schema(readers._with_corrupt(schema))
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", readers.CORRUPT)
              .option(*size)
              .json(in_dir)
              .select("*", "_metadata"))

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, kind, target, quarantine, load_ts)

    writer = source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
