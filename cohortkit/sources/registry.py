"""Named sources and sinks: raw tables by name, marts written as Parquet tables.

A source name resolves to a reader with a fixed schema, so model code never holds
paths.  The root is a parameter (a shared folder or bucket on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import checkpoint_dir
from .generations import Generation, Generations, tables_in

RAW_SCHEMAS = {
    "raw_reviews": S.RAW_REVIEWS,
    "raw_users": S.RAW_USERS,
    "raw_launches": S.RAW_LAUNCHES,
}


def exists(spark: SparkSession, path: str) -> bool:
    """Is there something at ``path`` (any Hadoop file system)?"""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def append_once(df: DataFrame, path: str) -> None:
    """Append rows that the table at ``path`` does not hold yet, by a hash of the whole row: landing
    the same input again adds nothing."""
    hashed = df.withColumn("_row_hash", F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256))
    if exists(df.sparkSession, path):
        checkpoint_dir(df.sparkSession)
        seen = df.sparkSession.read.schema(hashed.schema).parquet(path).select("_row_hash").distinct()
        # The result is appended to what it was compared with: the comparison ends before the append.
        hashed = hashed.join(seen, "_row_hash", "left_anti").select(*hashed.columns).checkpoint(eager=True)
    hashed.write.mode("append").parquet(path)


def raw_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/raw/{name}"


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Raw table ``name`` stored as Parquet under ``root/raw/name`` (schema enforced)."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(raw_path(root, name))


def append_raw(df: DataFrame, root: str, name: str) -> None:
    """Append rows to a raw table (the raw layer is append-only)."""
    df.select(*RAW_SCHEMAS[name].fieldNames()).write.mode("append").parquet(raw_path(root, name))


def new_layer(spark: SparkSession, root: str, layer: str) -> Generation:
    """A new generation of ``root/layer``: tables written to it show, all at once, when it is committed."""
    return Generations(spark, f"{root.rstrip('/')}/{layer}").begin()


def materialize(tables: dict[str, DataFrame], root: str, layer: str = "marts",
                partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write the DataFrames as the Parquet tables of ``root/layer``; returns their paths.

    Each write is one Spark job; the written table cuts the lineage for later readers. All tables go
    into one new generation of the layer: a build that fails between two of them changes nothing.
    """
    spark = next(iter(tables.values())).sparkSession
    with new_layer(spark, root, layer) as written:
        return {name: written.write(name, df, (partition_by or {}).get(name)) for name, df in tables.items()}


def read_layer(spark: SparkSession, root: str, layer: str, names=None) -> dict[str, DataFrame]:
    """The tables of the layer's current generation, all of the same build."""
    folder = Generations(spark, f"{root.rstrip('/')}/{layer}").current()
    if folder is None:
        raise FileNotFoundError(f"nothing was built yet at {root}/{layer}")
    names = [n for n in tables_in(spark, folder)] if names is None else names
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as temporary views (the "view" materialisation)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                  mode: str = "append") -> None:
    """Store a raw table bucketed and sorted by its natural key.

    Later insert-or-ignore anti-joins against this table read it already partitioned
    by key: only the (small) incoming batch is shuffled, never the whole target.
    """
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 5000, mode: str = "append") -> None:
    """Copy rows to a relational database table (the cloud-copy target).

    Each task writes its partition in batches of ``batch_size`` rows over its own
    connection.  Pair with ``ingest.sync_table`` against the target's current keys
    to keep the copy insert-or-ignore.  Connection settings come from the caller.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.mode(mode).jdbc(url, table, properties=props)
