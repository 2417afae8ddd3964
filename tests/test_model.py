"""The churn model scores every hold-out user, follows its parameters and ranks raw scores."""

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import churn, metrics
from cohortkit.plans import queries_analysis
from cohortkit.plans.models import Models

from .conftest import SF001


@pytest.fixture(scope="module")
def survival(spark):
    surv = Models.from_fixtures(spark, SF001).survival_inputs
    # Some users lack a feature.
    return surv.withColumn("avg_engagement_score", F.when(F.crc32("user_id") % 5 > 0, F.col("avg_engagement_score"))) \
        .withColumn("user_segment", F.when(F.crc32("user_id") % 7 > 0, F.col("user_segment"))).cache()


def test_every_holdout_user_is_scored(spark, survival):
    model, scored = churn.train_and_score(survival, churn_days=90)
    training = churn.churn_training_set(survival, 90)
    held = churn.churn_split(training).where("split = 'test'")
    want = sorted((r.user_id, r.churned_early) for r in held.collect())
    assert sorted((r.user_id, r.label) for r in scored.collect()) == want
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    importance = churn.feature_importance(model, spark).collect()
    assert len(importance) == 4 and abs(sum(r.importance for r in importance) - 1) < 1e-4
    support = {r["class"]: r.support for r in metrics.classification_report(scored).collect()}
    assert support["macro avg"] == len(want) and support["1"] == sum(y for _, y in want)


def test_parameters_reach_the_prepared_set(spark, survival):
    assert churn.prepared(survival, 90).agg(F.sum("churned_early")).first()[0] == \
        churn.churn_training_set(survival, 90).agg(F.sum("churned_early")).first()[0]
    assert churn.prepared(survival, min_reviews=5).where("total_reviews < 5").count() == 0


def test_segment_codes_are_lazy_and_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "user_segment string")
    got = sorted(((r.user_segment or "~"), r.user_segment_encoded) for r in churn.segment_encoding(df).collect())
    assert got == [("a", 0), ("a", 0), ("b", 1), ("c", 2), ("~", 3)]


def test_auc_keeps_close_scores_apart(spark):
    rows = [(1, 0.1 + 1e-9), (0, 0.1), (1, 0.1 + 3e-9), (0, 0.1 + 2e-9), (1, 1.0), (0, -2.0), (1, 7.0)]
    df = spark.createDataFrame(rows, "label int, score double")
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert metrics.roc_auc(df).first().auc == round(want, 6)


def test_the_trainer_gets_even_partitions_on_every_core(spark, survival, monkeypatch):
    sizes, fit = [], churn.fit_churn

    def looked_at(train):
        sizes.extend(r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect())
        return fit(train, trees=1)

    monkeypatch.setattr(churn, "fit_churn", looked_at)
    monkeypatch.setattr(churn, "PART_ROWS", 10, raising=False)
    churn.train_and_score(survival.coalesce(1))  # few rows lie in one file
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= len(sizes)


@pytest.mark.parametrize("model", ["_trained", "_boosted"])
def test_models_read_the_survival_inputs_once(spark, survival, monkeypatch, model):
    fit, rows = churn.fit_churn, spark.sparkContext.accumulator(0)
    monkeypatch.setattr(churn, "fit_churn", lambda train: fit(train, trees=1))

    def read(user_id):
        rows.add(1)
        return user_id

    m = Models.from_fixtures(spark, SF001)
    m.source = "counted"
    m.__dict__["survival_inputs"] = survival.withColumn("user_id", F.udf(read, "string")("user_id"))
    assert getattr(queries_analysis, model)(m)[1].count() > 0
    assert rows.value == survival.count()
