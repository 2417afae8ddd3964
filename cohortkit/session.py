"""SparkSession construction and the few session-level knobs the engine relies on.

Everything here is plain Spark configuration.  On a cluster the session is usually
created by the platform; ``configure`` then only fills in settings that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  They are applied only when the
# session does not define them already, so a cluster's own choices win.
DEFAULTS = {
    # Date arithmetic and month truncation must not depend on the host zone.
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions, and turn
    # a shuffle join into a broadcast join only after the build side's *measured*
    # size is known (runtime-checked broadcast).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only build sides measured below 32 MB at run time; estimates made before the
    # run (from compressed file sizes) decide nothing.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Input splits of 128 MB keep scan tasks well inside executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cohortkit") -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a cluster
    leave them ``None`` so the deployment decides.  Defaults never override a value the
    deployment configured (spark-defaults, ``--conf``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("COHORTKIT_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package defaults the deployment did not set.  Only runtime SQL settings are
    touched; a checkpoint folder is asked for only where something is checkpointed."""
    deployed = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not deployed.contains(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (on a cluster this names shared storage).
    Only when the session leaves it unset -- local tests -- a scratch folder is made.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not visible to other executors: refuse rather than guess.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows reads the rows, not their plan."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Target bytes per shuffle partition when sizing shuffles from the input size.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def plan_size_bytes(df) -> int:
    """Catalyst's size estimate of a DataFrame (from file metadata; runs no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_shuffles(spark: SparkSession, input_bytes: int, target: int = TARGET_PARTITION_BYTES) -> int:
    """Start shuffles with about one partition per ``target`` bytes of input; AQE then
    coalesces small ones (advisory size = ``target``) and splits skewed ones.

    Only raises the initial partition count, also above what an earlier, smaller input set; a
    value the cluster was started with wins.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = max(1, -(-int(input_bytes) // target))
    if not spark.sparkContext.getConf().contains(key):
        current = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
        if wanted > current:
            spark.conf.set(key, str(wanted))
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target))
    return wanted
