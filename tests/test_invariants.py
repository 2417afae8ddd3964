"""Invariants and published profile figures on the driver's test tables."""

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import survival
from cohortkit.plans import catalog
from cohortkit.plans.models import Models
from cohortkit.sources import ingest

from .conftest import SF001, SF01


@pytest.fixture(scope="module")
def m001(spark):
    return Models.from_fixtures(spark, SF001)


def test_month0_is_100(m001):
    rates = m001.retention_cohorts.where("months_since_joining = 0").select("retention_rate").distinct().collect()
    assert [r[0] for r in rates] == [100.0]


def test_survival_monotone_in_unit_interval(m001):
    curve = survival.km_curve(survival.km_event_table(survival.km_input(m001.survival_inputs),
                                                      by="user_segment"), by="user_segment")
    rows = curve.orderBy("user_segment", "t").collect()
    prev = {}
    for r in rows:
        assert 0.0 <= r.survival_raw <= 1.0
        assert r.survival_raw <= prev.get(r.user_segment, 1.0) + 1e-12
        prev[r.user_segment] = r.survival_raw


def test_km_without_censoring_is_empirical(spark):
    days = [1, 2, 2, 3, 5, 8, 8, 8, 13]
    df = spark.createDataFrame([(d, True) for d in days], "survival_days int, churned boolean")
    curve = {r.t: r.survival for r in survival.km_curve(survival.km_event_table(df)).collect()}
    for t, s in curve.items():
        assert s == round(sum(1 for d in days if d > t) / len(days), 6)


def test_segment_counts_add_up(m001):
    km_in = survival.km_input(m001.survival_inputs)
    total = km_in.count()
    by_seg = survival.km_event_table(km_in, by="user_segment").where("t = 0").agg(F.sum("at_risk")).first()[0]
    assert by_seg == total


def test_new_segment_absent_below_min_group(m001):
    segs = {r.user_segment for r in survival.km_by_segment(survival.km_input(m001.survival_inputs))
            .select("user_segment").distinct().collect()}
    assert "New User" not in segs and len(segs) == 3


def test_result_unchanged_under_repartition(spark, m001):
    a = sorted(tuple(r) for r in m001.retention_cohorts.collect())
    users = m001.stg_users.repartition(3)
    reviews = m001.stg_reviews.repartition(11, "review_id")
    from cohortkit.operators import marts
    b = sorted(tuple(r) for r in marts.retention_cohorts(users, reviews).collect())
    assert a == b


def test_insert_ignore_idempotent(spark, m001):
    raw = m001.raw_reviews
    target = raw.where(F.substring("review_id", 2, 20).cast("long") % 2 == 0)
    arrived = raw.withColumn("arrival", F.lit(0))
    once = ingest.insert_ignore(arrived, target, "review_id", "arrival")
    twice = ingest.insert_ignore(arrived, target.unionByName(once), "review_id", "arrival")
    assert once.count() > 0 and twice.count() == 0


def test_profile_sf001(spark):
    q = catalog.QUERIES
    catalog.load_all()
    assert q["km_median"](spark, SF001).first().median_days == 270
    at = {r.days: r.survival for r in q["km_milestones"](spark, SF001).collect()}
    assert at == {30: 0.938574, 90: 0.910346, 180: 0.670837, 365: 0.394262}


def test_profile_sf01(spark):
    catalog.load_all()
    q = catalog.QUERIES
    assert q["km_median"](spark, SF01).first().median_days == 253
    at = {r.days: r.survival for r in q["km_milestones"](spark, SF01).collect()}
    assert at == {30: 0.950909, 90: 0.906293, 180: 0.628168, 365: 0.400658}
    seg = {r.user_segment: (r.users) for r in q["segment_table"](spark, SF01).collect()}
    assert seg == {"Power User": 471, "Regular User": 805, "Casual User": 161, "New User": 31}
