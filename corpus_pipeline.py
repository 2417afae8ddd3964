"""The corpus pipeline: quality rules, near-duplicate removal, secret redaction, mixing, tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``. A stage sees only what its predecessor kept:
rejected documents are gone, one document of each class is left, found secrets are masked in the text
(and ``n_chars`` counted again), documents are there as often as the mix draws them. The last stage gives
each row's doc_id, token ids, their number, and what they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bpe, mixing, order_minhash, quality_rules, secret_scan
from cohortkit.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    references = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.reject(docs, references=references)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.dedupe(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.output(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]

#: Near-duplicate classes, the seeded draws of the mix and the token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # Later stages read their input several times.
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
