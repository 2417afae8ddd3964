"""Landing operators: quarantine, first-wins insert-or-ignore, bounded ingest, table sync,
ingest report and surrogate ids.

All of them are set-based DataFrame operations, so a batch of any size is one job:

* first-wins dedup is ``min(struct(arrival, ...))`` per key -- a partial aggregate,
  so a key repeated millions of times is collapsed on the map side (no hot task);
* "ignore rows whose key already exists" is a ``left_anti`` join on the key; AQE
  chooses broadcast (only when the measured key side is small) or a shuffle join and
  splits skewed partitions.  With a ``KeyIndex`` of the target, as the commands use, the
  batch is joined only with those of its keys that the target holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _all_not_null(cols) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond


def quarantine_split(df: DataFrame, required, corrupt: Column | None = None,
                     reason_col: str = "_reject_reason", keep=None) -> tuple[DataFrame, DataFrame]:
    """Split into (good, rejected): a row is rejected when a required column is null or
    ``corrupt`` (a boolean column) is true.  Rejected rows carry the reason.

    ``keep``, a function of the rows with their reason, may store them for both sides (persist, say)."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in _cols(required)]
    if corrupt is not None:
        reasons.append(F.when(corrupt, F.lit("unparsable value")))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    tagged = df.withColumn(reason_col, reason)
    tagged = keep(tagged) if keep else tagged
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return good, rejected


def first_arrivals(batch: DataFrame, key, arrival: str) -> DataFrame:
    """One row per key: the earliest ``arrival`` (ties broken by the row's values).

    ``arrival`` is any orderable column, for example the readers' ``_arrival`` struct.

    Implemented as ``min(struct(arrival, cols...))`` grouped by key, which Spark
    aggregates partially before the shuffle.
    """
    keys = _cols(key)
    others = [c for c in batch.columns if c not in keys and c != arrival]
    order = [arrival, *others]
    packed = F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    firsts = batch.groupBy(*keys).agg(packed)
    return firsts.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order]).select(*batch.columns)


def insert_ignore(batch: DataFrame, target: DataFrame | None, key, arrival: str, index=None) -> DataFrame:
    """Rows of ``batch`` to append so that the target behaves like
    ``INSERT ... ON CONFLICT (key) DO NOTHING`` applied in arrival order.

    Null keys are not insertable (a key is NOT NULL) and are dropped here; use
    ``quarantine_split`` / ``ingest_report`` to see them.

    With a refreshed ``index`` (``sources.keyindex.KeyIndex``) in place of the target, the batch's first rows are
    stored, so that the look-ups read their keys alone, and only the target's keys in doubt are read.
    """
    keys = _cols(key)
    clean = batch.where(_all_not_null(keys))
    firsts = first_arrivals(clean, keys, arrival)
    if index is not None:
        firsts = stored(batch.sparkSession, firsts, "first-arrivals")
        existing = index.present(firsts)
    else:
        existing = target.select(*keys)
    out = firsts.join(existing, keys, "left_anti")
    return out.drop(arrival)


def ingest_report(batch: DataFrame, target: DataFrame, key, required=()) -> DataFrame:
    """Outcome counts of loading ``batch`` into ``target``: inserted / duplicate / rejected.

    rejected  = rows with a null key or a null required column
    inserted  = distinct new keys (first arrival wins)
    duplicate = every other good row (repeats inside the batch or keys already present)

    One grouped pass over the batch (partial aggregation per key), one left join with
    the target's distinct keys (its exchange already partitions by key).
    """
    keys = _cols(key)
    need = keys + [c for c in _cols(required) if c not in keys]
    bad = ~_all_not_null(need)
    per_key = batch.groupBy(*keys, bad.alias("_bad")).agg(F.count(F.lit(1)).alias("n"))
    present = target.select(*keys).distinct().withColumn("_present", F.lit(True))
    marked = per_key.join(present, keys, "left")
    good = ~F.col("_bad")
    totals = marked.agg(
        F.sum(F.when(good & F.col("_present").isNull(), 1).otherwise(0)).cast("long").alias("ins"),
        F.sum(F.when(good, F.col("n")).otherwise(0)).cast("long").alias("good"),
        F.sum(F.when(F.col("_bad"), F.col("n")).otherwise(0)).cast("long").alias("rej"))
    return totals.select(F.inline(F.array(
        F.struct(F.lit("inserted").alias("outcome"), F.col("ins").alias("rows")),
        F.struct(F.lit("duplicate").alias("outcome"), (F.col("good") - F.col("ins")).alias("rows")),
        F.struct(F.lit("rejected").alias("outcome"), F.col("rej").alias("rows")),
    )))


def bounded_ingest(df: DataFrame, key, max_rows: int | None = None) -> DataFrame:
    """All rows, or the first ``max_rows`` in key order if a caller asks for a limit (a
    top-k; meant for samples and trials, not as a default)."""
    if max_rows is None:
        return df
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in _cols(key)]).limit(max_rows)


def sync_table(source: DataFrame, target: DataFrame | None, columns, key, index=None) -> DataFrame:
    """Rows to append when copying ``columns`` of ``source`` into ``target`` with
    insert-or-ignore on ``key``.  Audit columns are not copied (the target generates its
    own); of rows repeating a key, the one with the smallest values is copied."""
    picked = source.select(*_cols(columns)).withColumn("_arrival", F.lit(0))
    return insert_ignore(picked, target, key, "_arrival", index)


def land_with_audit(df: DataFrame, key, id_col: str | None = "id", ts_col: str | None = "loaded_at",
                    load_ts=None, start_id: int = 1, digits: int = 3) -> DataFrame:
    """Add a dense surrogate id (start_id, start_id+1, ...) and a load timestamp.

    Ids follow the order of (the first 2 x ``digits`` hex digits of the md5 of the natural key, key), so they depend
    on the rows alone: a recomputed task gives the same ids and nothing has to be checkpointed.  Rows are
    counted per range (all 2 x ``digits`` digits: 16.7 million ranges); a range's offset is the sum of the groups
    (first ``digits``: at most 4,096 rows in one task) before its own and of the ranges (at most 4,096 per task)
    before it in its group.  A row's place in its range comes from a window over that range, which at 10^10 rows
    holds some 600 rows.  Both sides of the join are partitioned by range, nothing is broadcast.
    """
    out = df
    if ts_col:
        ts = F.lit(str(load_ts)).cast("timestamp_ntz") if load_ts is not None else F.localtimestamp()
        out = out.withColumn(ts_col, ts)
    if not id_col:
        return out
    keys = _cols(key)
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    tagged = out.withColumn("_range", F.conv(F.substring(digest, 1, 2 * digits), 16, 10).cast("long"))
    group = F.floor(F.col("_range") / 16 ** digits)
    counts = tagged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", "_n", group.alias("_group"))
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_all"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("_group", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_start"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.select("_range", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
               .join(starts, "_group").select("_range", (F.col("_start") + F.col("_off")).alias("_off")))
    inside = Window.partitionBy("_range").orderBy(*keys, *[c for c in df.columns if c not in keys])
    placed = tagged.withColumn("_row", F.row_number().over(inside)).join(offsets, "_range")
    return (placed.withColumn(id_col, (F.lit(start_id - 1) + F.col("_off") + F.col("_row")).cast("long"))
            .select(id_col, *[c for c in out.columns if c != id_col]))
