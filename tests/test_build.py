"""Model build with the quality gate, and display helpers."""

import pytest

from cohortkit.functions import columns as C
from cohortkit.operators.quality import QualityGateError
from cohortkit.plans.build import run_build
from cohortkit.plans.models import Models

from .conftest import SF001


def test_gate_stops_build_on_failing_checks(spark, tmp_path):
    models = Models.from_fixtures(spark, SF001)
    with pytest.raises(QualityGateError):
        run_build(spark, models, str(tmp_path / "wh"))
    assert not (tmp_path / "wh").exists()


def test_build_writes_marts_without_gate(spark, tmp_path):
    models = Models.from_fixtures(spark, SF001)
    report, paths = run_build(spark, models, str(tmp_path / "wh"), gate=False)
    assert report.count() == 35
    assert set(paths) == {"fct_launch_performance", "fct_category_performance", "fct_retention_cohorts",
                          "fct_survival_inputs"}
    assert spark.read.parquet(paths["fct_retention_cohorts"]).count() == models.retention_cohorts.count()
    assert spark.table("stg_reviews").count() == models.stg_reviews.count()


def test_display_number(spark):
    df = spark.createDataFrame([(12345.0,), (52.345,)], "x double")
    assert [r[0] for r in df.select(C.display_number("x", 0)).collect()] == ["12,345", "52"]
    assert [r[0] for r in df.select(C.display_number("x", 1)).collect()] == ["12,345.0", "52.3"]


def test_models_from_stored_raw_tables(spark, tmp_path):
    from cohortkit.sources import registry
    from cohortkit.params import FIXTURE_PARAMS
    fx = Models.from_fixtures(spark, SF001)
    root = str(tmp_path / "wh")
    for name in ("raw_reviews", "raw_users", "raw_launches"):
        registry.append_raw(fx.raw[name], root, name)
    stored = Models.from_tables(spark, root, FIXTURE_PARAMS)
    a = sorted(tuple(r) for r in fx.retention_cohorts.collect())
    b = sorted(tuple(r) for r in stored.retention_cohorts.collect())
    assert a == b


def test_size_shuffles_only_raises(spark):
    from cohortkit.session import size_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert size_shuffles(spark, 10) == 1
    assert spark.conf.get(key, None) is None
    try:
        size_shuffles(spark, 100 << 27)
        assert spark.conf.get(key) == "100"
        size_shuffles(spark, 20 << 27)
        assert spark.conf.get(key) == "100"
        size_shuffles(spark, 10_000 << 27)
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_gated_build_succeeds_over_a_million_reviews(spark, tmp_path):
    from pyspark.sql import functions as F

    from cohortkit.params import FIXTURE_PARAMS, Params
    fx = Models.from_fixtures(spark, SF001)
    n = 1_000_001 // fx.raw_reviews.count() + 1
    copies = fx.raw_reviews.crossJoin(spark.range(n)).withColumn(
        "review_id", F.concat_ws("-", "review_id", "id")).drop("id")
    assert copies.count() > 1_000_000
    raw = {**fx.raw, "raw_reviews": copies,
           "raw_users": fx.raw_users.where("average_stars >= 1 AND yelping_since IS NOT NULL"),
           "raw_launches": fx.raw_launches.where("upvotes IS NOT NULL")}
    big = Models(raw, Params(as_of=FIXTURE_PARAMS.as_of))
    report, paths = run_build(spark, big, str(tmp_path / "wh"))
    assert report.where("NOT passed").count() == 0
    assert spark.read.parquet(paths["fct_retention_cohorts"]).count() > 0


def test_build_reads_reviews_once_through_the_profile(spark, tmp_path):
    from cohortkit.params import FIXTURE_PARAMS
    from cohortkit.sources import registry
    fx = Models.from_fixtures(spark, SF001)
    root = str(tmp_path / "wh")
    for name in ("raw_reviews", "raw_users", "raw_launches"):
        registry.append_raw(fx.raw[name], root, name)
    models = Models.from_tables(spark, root, FIXTURE_PARAMS)
    expected = sorted(tuple(r) for r in models.survival_inputs.collect())
    run_build(spark, models, root, gate=False)
    for df in (models.survival_inputs, models.retention_cohorts):
        files = df.inputFiles()
        assert any("/intermediate/" in f and "/user_review_profile/" in f for f in files)
        assert not any("/raw/raw_reviews/" in f for f in files)
    assert sorted(tuple(r) for r in models.survival_inputs.collect()) == expected
