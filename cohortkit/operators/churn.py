"""Churn classification on Spark ML.

Training set -> segment encoding -> feature vector -> hash split -> gradient-boosted
trees -> predictions, report, AUC and feature importances.  Training is Spark ML's
distributed GBT trainer (per-iteration jobs over the cached training set); nothing
is collected except the model and the label vocabulary (4 segment names).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..session import stored

FEATURES = ["total_reviews", "avg_stars", "avg_engagement_score", "user_segment_encoded"]
LABEL = "churned_early"
# The hold-out set: this share of the users, rounded up, those with the smallest md5(user_id).
TEST_PERCENT = 20
# Hex digits of the hash that one histogram tells apart.
DIGITS = 5
# Training rows that are worth a partition of their own.
PART_ROWS = 5000


def churn_training_set(survival: DataFrame, churn_days: int = P.CHURN_DAYS,
                       min_reviews: int = P.MIN_REVIEWS) -> DataFrame:
    """Analysed users with the classifier label: lifetime shorter than ``churn_days``."""
    return (survival
            .where((F.col("survival_days") >= 0) & (F.col("total_reviews") >= min_reviews))
            .select("user_id", "survival_days", "total_reviews", "avg_stars", "avg_engagement_score",
                    "user_segment",
                    F.when(F.col("survival_days") < churn_days, 1).otherwise(0).alias(LABEL)))


def segment_encoding(df: DataFrame, col: str = "user_segment", out: str = "user_segment_encoded") -> DataFrame:
    """Alphabetical label codes 0..k-1 over the distinct values; a null gets code k.

    Lazy: the vocabulary (one row per label) is ranked and joined inside the same plan.  The
    code is a plain number without nominal metadata, so trees treat it as ordinal, like the
    reference classifier does.
    """
    order = Window.orderBy("_label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    labels = df.select(F.col(col).alias("_label")).where(F.col(col).isNotNull()).distinct().select(
        "_label", (F.count("_label").over(order) - 1).cast("int").alias(out))
    size = labels.agg(F.count(F.lit(1)).cast("int").alias("_labels"))
    coded = df.join(labels, F.col(col) == F.col("_label"), "left")
    return coded.join(F.broadcast(size)).select(
        *df.columns, F.coalesce(F.col(out), F.col("_labels")).alias(out))


def kth_smallest_hash(hashes: DataFrame, k) -> Column:
    """The ``k``-th smallest of the hex texts in column ``h``, as a scalar (null if there are fewer).

    ``k`` is a column, or a function from the number of rows to one.  A histogram of the first digits (at most
    16 ** ``DIGITS`` rows, summed before it is shuffled) tells which prefix holds it and how many lie before; then
    only that prefix is looked at: of 10^10 rows some 10,000.
    """
    digits = F.substring("h", 1, DIGITS)
    histogram = hashes.groupBy(digits.alias("p")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = histogram.select("p", "n", F.sum("n").over(upto).alias("upto"), (k(total) if callable(k) else k).alias("k"))
    found = counted.where("upto >= k").agg(F.min(F.struct("p", F.expr("k - upto + n").alias("left"))).alias("f")).scalar()
    within = hashes.where(digits == found["p"]).groupBy("h").agg(F.count("*").alias("n"))
    upto = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = within.select("h", F.sum("n").over(upto).alias("upto"))
    return placed.where(F.col("upto") >= found["left"]).agg(F.min("h")).scalar()


def churn_split(df: DataFrame, key: str = "user_id", test_percent: int = TEST_PERCENT) -> DataFrame:
    """Stable split by a hash of the key: the same rows on any partitioning and in SQL.

    The test side has exactly ceil(``test_percent`` % of all rows) (more only if rows repeat the key at the border).
    """
    h = F.md5(F.col(key).cast("string"))
    border = kth_smallest_hash(df.select(h.alias("h")), lambda n: F.floor((n * test_percent + 99) / 100).cast("long"))
    return df.withColumn("split", F.when(F.coalesce(h <= border, F.lit(False)), "test").otherwise("train"))


def split_sizes(split: DataFrame) -> DataFrame:
    """Users per side of the hold-out split."""
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("users"))


# A missing feature gets a value below every real one (all features are counts, stars or sums of
# them, so not negative): a tree can send missing values their own way, and every user is scored.
MISSING = -1.0


def assemble(df: DataFrame) -> DataFrame:
    filled = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(f"_{c}") for c in FEATURES])
    out = VectorAssembler(inputCols=[f"_{c}" for c in FEATURES], outputCol="features").transform(filled)
    return out.drop(*[f"_{c}" for c in FEATURES])


def fit_churn(train: DataFrame, trees: int = P.GBT_TREES, depth: int = P.GBT_DEPTH,
              step: float = P.GBT_STEP, seed: int = P.SEED) -> GBTClassificationModel:
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=trees, maxDepth=depth,
                        stepSize=step, seed=seed, lossType="logistic")
    return gbt.fit(train)


def score(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    """Label, prediction and the probability as it is (metrics rank these; round for display)."""
    scored = model.transform(df)
    return scored.select("user_id", F.col(LABEL).alias("label"), F.col("prediction").cast("int").alias("prediction"),
                         vector_to_array("probability")[1].alias("score"))


def displayed(scored: DataFrame) -> DataFrame:
    return scored.withColumn("score", F.round("score", 6))


def prepared(survival: DataFrame, churn_days: int = P.CHURN_DAYS, min_reviews: int = P.MIN_REVIEWS) -> DataFrame:
    """Training set with encoded segment, split column and feature vector.

    The encoding and the split read the training set several times: it is stored once before."""
    training = stored(survival.sparkSession, churn_training_set(survival, churn_days, min_reviews), "churn-training")
    return assemble(churn_split(segment_encoding(training)))


def train_and_score(survival: DataFrame, churn_days: int = P.CHURN_DAYS,
                    min_reviews: int = P.MIN_REVIEWS) -> tuple[GBTClassificationModel, DataFrame]:
    """Fit on the training side and score every user of the hold-out side.

    The prepared set is stored once in the shared folder; the fit and the scoring read it there.
    The trainer runs several small jobs per tree over the same rows, so its partitions follow the cluster's
    cores; where the stored files are fewer, the rows are dealt evenly (``PART_ROWS`` or more to a partition).
    """
    spark = survival.sparkSession
    data = stored(spark, prepared(survival, churn_days, min_reviews), "churn-prepared")
    cores = spark.sparkContext.defaultParallelism
    train = data.where(F.col("split") == "train").coalesce(cores)
    wanted = min(cores, train.count() // PART_ROWS)
    if train.select(LABEL).rdd.getNumPartitions() < wanted:
        train = train.repartition(wanted)
    train = train.persist()
    model = fit_churn(train)
    train.unpersist()
    return model, score(model, data.where(F.col("split") == "test"))


def feature_importance(model: GBTClassificationModel, spark) -> DataFrame:
    """(feature, importance, rank) -- rank 1 is the top predictor."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(FEATURES, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.select("feature", F.round("importance", 6).alias("importance"),
                     F.rank().over(Window.orderBy(F.col("importance").desc())).alias("rank"))


def top_feature(importance: DataFrame) -> DataFrame:
    """The strongest predictor (arg-max of importance)."""
    return importance.agg(F.max_by("feature", "importance").alias("top_feature"),
                          F.max("importance").alias("importance"))


def rule_score(training: DataFrame) -> DataFrame:
    """A transparent baseline scorer: fewer reviews -> higher churn score.

    score = 1 / total_reviews, predicted churn when score >= 0.5 (at most 2 reviews).
    Used to check the metric operators exactly against SQL.
    """
    s = F.round(1.0 / F.col("total_reviews"), 6)
    return training.select("user_id", F.col(LABEL).alias("label"), s.alias("score"),
                           F.when(s >= 0.5, 1).otherwise(0).alias("prediction"))


def label_distribution(training: DataFrame) -> DataFrame:
    return training.groupBy(LABEL).agg(F.count(F.lit(1)).alias("users"))


def segment_survival_means(training: DataFrame) -> DataFrame:
    """Mean lifetime overall and for the Power and New segments."""
    days, seg = F.col("survival_days"), F.col("user_segment")
    return training.agg(
        F.round(F.avg(days), 6).alias("avg_survival_days"),
        F.round(F.avg(F.when(seg == "Power User", days)), 6).alias("power_avg_survival_days"),
        F.round(F.avg(F.when(seg == "New User", days)), 6).alias("new_avg_survival_days"),
    )

