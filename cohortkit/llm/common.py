"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, configure

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


#: Rows of a batch that Python workers get at once: some texts are very long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get ``BATCH_ROWS`` rows at once, unless the deployment says otherwise."""
    if not spark.sparkContext.getConf().contains("spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def joined_words(text: Column) -> Column:
    """The words of a text joined by one space; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def word_count(joined: Column) -> Column:
    """Number of words of ``joined_words``."""
    return F.when(joined == "", F.lit(0)).otherwise(
        F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit(""))) + 1).cast("long")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that the frame does not have (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor
    costs no recomputation of what came before."""
    path = f"{checkpoint_dir(spark)}/cohortkit-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
