"""Hand-checkable mini tables (FIXTURES.md §B)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import marts, metrics, staging, survival
from cohortkit.sources import ingest

D = dt.date


def _users(spark, rows):
    raw = spark.createDataFrame(
        [(u, None, 10, 0, 3.0, since, None) for u, since in rows],
        "user_id string, name string, review_count int, fans int, average_stars double, "
        "yelping_since date, loaded_at timestamp_ntz")
    return staging.stg_users(raw)


def _reviews(spark, rows):
    raw = spark.createDataFrame(
        [(f"r{i}", u, "b", 4.0, 0, 0, 0, d, None) for i, (u, d) in enumerate(rows)],
        "review_id string, user_id string, business_id string, stars double, useful int, funny int, "
        "cool int, review_date date, loaded_at timestamp_ntz")
    return staging.stg_reviews(raw)


def test_b1_cohort_retention(spark):
    users = _users(spark, [("A", D(2020, 1, 15)), ("B", D(2020, 1, 31)), ("C", D(2020, 2, 1)),
                           ("D", None), ("E", D(2020, 3, 10))])
    reviews = _reviews(spark, [("A", D(2020, 1, 20)), ("A", D(2020, 2, 2)), ("A", D(2020, 2, 28)), ("A", None),
                               ("B", D(2019, 12, 31)), ("B", D(2020, 2, 10)), ("C", D(2020, 2, 5)),
                               ("C", D(2020, 4, 1)), ("D", D(2020, 1, 5)), ("E", D(2020, 4, 2)),
                               ("Z", D(2020, 1, 1))])
    got = [tuple(r) for r in marts.retention_cohorts(users, reviews).collect()]
    assert got == [
        (D(2020, 1, 1), 0, 1, 1, 100.0),
        (D(2020, 1, 1), 1, 2, 1, 200.0),
        (D(2020, 2, 1), 0, 1, 1, 100.0),
        (D(2020, 2, 1), 2, 1, 1, 100.0),
    ]


def _km_df(spark, pairs):
    return spark.createDataFrame(pairs, "survival_days int, churned boolean")


def test_b2_survival_curve_median_lookup(spark):
    df = _km_df(spark, [(0, True), (10, True), (10, False), (25, True), (40, False), (60, True)])
    curve = survival.km_curve(survival.km_event_table(df))
    got = [(r.t, r.at_risk, r.observed, r.survival) for r in curve.orderBy("t").collect()]
    assert got == [(0, 6, 1, 0.833333), (10, 5, 1, 0.666667), (25, 3, 1, 0.444444),
                   (40, 2, 0, 0.444444), (60, 1, 1, 0.0)]
    assert survival.km_median(curve).first().median_days == 25
    at = {r.days: r.survival for r in survival.km_at(curve, [9, 30, 100]).collect()}
    assert at == {9: 0.833333, 30: 0.444444, 100: 0.0}


def test_b2_no_events(spark):
    df = _km_df(spark, [(5, False), (7, False)])
    curve = survival.km_curve(survival.km_event_table(df))
    assert {r.survival for r in curve.collect()} == {1.0}
    assert survival.km_median(curve).first().median_days is None


def test_b2_curve_starts_at_zero(spark):
    df = _km_df(spark, [(3, True), (5, False)])
    rows = survival.km_curve(survival.km_event_table(df)).orderBy("t").collect()
    assert (rows[0].t, rows[0].at_risk, rows[0].survival) == (0, 2, 1.0)


def test_b3_launch_scoring(spark):
    raw = spark.createDataFrame(
        [(1, "A", None, None, None), (2, "B", None, 499, " AI "), (3, "C", None, 500, ""),
         (4, "D", None, 700, "Dev"), (5, "E", None, 1205, "Dev")],
        "id long, name string, tagline string, upvotes int, category string")
    raw = (raw.withColumn("pricing_type", F.lit("Free")).withColumn("launch_date", F.lit(D(2024, 1, 1)))
           .withColumn("product_url", F.concat(F.lit("u"), F.col("id").cast("string")))
           .withColumn("scraped_at", F.lit(None).cast("timestamp_ntz")))
    perf = marts.launch_performance(staging.stg_launches(raw), D(2024, 2, 1))
    got = [(r.traction_tier, r.success_score, r.is_top_performer, r.category)
           for r in perf.orderBy("id").collect()]
    assert got == [("Low Traction", 100.0, False, "Uncategorized"), ("Low Traction", 49.9, False, "AI"),
                   ("Medium Traction", 50.0, False, ""), ("High Traction", 70.0, True, "Dev"),
                   ("High Traction", 100.0, True, "Dev")]


@pytest.mark.parametrize("as_of,last,churned", [
    (D(2020, 3, 31), D(2019, 3, 31), False), (D(2020, 3, 31), D(2019, 3, 30), True),
    (D(2020, 2, 29), D(2019, 2, 28), False), (D(2020, 2, 29), D(2019, 2, 27), True)])
def test_b4_churn_flag_boundaries(spark, as_of, last, churned):
    users = _users(spark, [("A", D(2018, 1, 1))])
    reviews = _reviews(spark, [("A", D(2018, 1, 2)), ("A", last)])
    assert marts.survival_inputs(users, reviews, as_of).first().churned is churned


def test_b4_tier_edges(spark):
    from cohortkit.functions import columns as C
    df = spark.createDataFrame([(v,) for v in [None, 4, 5, 19, 20, 99, 100]], "x int")
    assert [r[0] for r in df.select(C.user_segment("x")).collect()] == [
        "New User", "New User", "Casual User", "Casual User", "Regular User", "Regular User", "Power User"]
    df = spark.createDataFrame([(v,) for v in [None, 9, 10, 99, 100]], "x int")
    assert [r[0] for r in df.select(C.influence_tier("x")).collect()] == [
        "Standard", "Standard", "Active", "Active", "Influencer"]
    df = spark.createDataFrame([(v,) for v in [None, 2.0, 3.0, 3.5, 4.0]], "x double")
    assert [r[0] for r in df.select(C.sentiment("x")).collect()] == [
        "Negative", "Negative", "Neutral", "Negative", "Positive"]


def test_b5_insert_ignore_and_report(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b", 1), (2, "c", 2), (2, "d", 3), (None, "e", 4)],
                                  "k int, v string, arrival int")
    new = ingest.insert_ignore(batch, target, "k", "arrival")
    assert sorted(tuple(r) for r in new.collect()) == [(2, "c")]
    report = {r.outcome: r.rows for r in ingest.ingest_report(batch, target, "k").collect()}
    assert report == {"inserted": 1, "duplicate": 2, "rejected": 1}
    after = target.unionByName(new)
    again = ingest.insert_ignore(batch, after, "k", "arrival")
    assert again.count() == 0


def test_b8_auc_and_report(spark):
    scored = spark.createDataFrame([(1, .9), (1, .5), (0, .5), (0, .1)], "label int, score double")
    assert metrics.roc_auc(scored).first().auc == 0.875
    pred = scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    rep = {r["class"]: r for r in metrics.classification_report(pred).collect()}
    assert (rep["1"].precision, rep["1"].recall, rep["1"].f1) == (0.666667, 1.0, 0.8)
    assert (rep["0"].precision, rep["0"].recall, rep["0"].f1) == (1.0, 0.5, 0.666667)
    assert rep["accuracy"].f1 == 0.75 and rep["accuracy"].support == 4


def test_auc_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(3000)]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(pairs, "label int, score double").repartition(5)
    assert metrics.roc_auc(df, ranges=8).first().auc == round(brute, 6)


def test_default_cohorts_edges(spark):
    from cohortkit.operators import datasets

    def ret(n):
        rows = [(D(2016, 1 + i, 1), 0, 100.0) for i in range(n)]
        return spark.createDataFrame(rows, "cohort_month date, months_since_joining int, retention_rate double")
    lo, hi = D(2015, 1, 1), D(2020, 1, 1)
    assert [r.position for r in datasets.default_cohorts(ret(6), lo, hi).collect()] == [0]
    assert sorted(r.position for r in datasets.default_cohorts(ret(7), lo, hi).collect()) == [0, 6]
    assert datasets.default_cohorts(ret(0), lo, hi).count() == 0
    curves = datasets.retention_curves(ret(9), lo, hi)
    assert sorted({r.cohort_month for r in curves.collect()}) == [D(2016, 1, 1), D(2016, 7, 1)]


def test_assemble_features_and_split(spark):
    from cohortkit.operators import churn
    df = spark.createDataFrame(
        [("u1", 3, 4.0, 7.0, 2), ("u2", 5, None, 9.0, 1), ("u3", 2, 3.0, 5.0, 0)],
        "user_id string, total_reviews long, avg_stars double, avg_engagement_score double, "
        "user_segment_encoded int")
    out = churn.assemble(df).collect()
    assert [r.user_id for r in out] == ["u1", "u2", "u3"]
    assert out[0].features.toArray().tolist() == [3.0, 4.0, 7.0, 2.0]
    assert out[1].features.toArray().tolist() == [5.0, churn.MISSING, 9.0, 1.0]  # a missing feature has its own value
    split = {r.user_id: r.split for r in churn.churn_split(df).collect()}
    import hashlib
    assert split == {u: ("test" if hashlib.md5(u.encode()).hexdigest()[:2] < "33" else "train") for u in split}


def test_exact_pct_rounds_once(spark):
    from cohortkit.functions import columns as C
    # 14998 * 100 / 29999 = 49.99499983...: HALF_UP to 2 places is 49.99, never 50.00.
    df = spark.createDataFrame([(14998, 29999), (45, 32), (1, 8)], "a long, b long")
    assert [r[0] for r in df.select(C.exact_pct("a", "b", 2)).collect()] == [49.99, 140.63, 12.5]
    assert [r[0] for r in df.select(C.exact_pct("a", "b", 0)).collect()] == [50.0, 141.0, 13.0]


def test_round_avg_rounds_once(spark):
    from cohortkit.functions import columns as C
    # mean = 1,000,001 / 2,000,004 = 0.4999995000...: rounds to 0, not (via 0.500000) to 1.
    n = 2_000_004
    df = spark.range(n).select(F.when(F.col("id") < 1_000_001, 1).otherwise(0).alias("x"))
    assert df.agg(C.round_avg("x", 0)).first()[0] == 0.0
    halves = spark.createDataFrame([(1,), (2,)], "x int")
    assert halves.agg(C.round_avg("x", 0)).first()[0] == 2.0


def test_km_band_alpha_matches_z(spark):
    from cohortkit.params import Z_95
    df = _km_df(spark, [(0, True), (10, True), (10, False), (25, True), (40, False), (60, True)])
    ev = survival.km_event_table(df)
    a = [(r.t, r.ci_lower, r.ci_upper) for r in survival.km_curve(ev, alpha=0.05).orderBy("t").collect()]
    b = [(r.t, r.ci_lower, r.ci_upper) for r in survival.km_curve(ev, z=Z_95).orderBy("t").collect()]
    assert a == b and any(lo is not None for _, lo, _ in a)
