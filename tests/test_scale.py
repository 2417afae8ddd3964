"""Scale properties: hot keys give exact results; plans prune, push down and pre-aggregate."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest

from cohortkit.operators import marts, staging
from cohortkit.params import FIXTURE_PARAMS
from cohortkit.plans.models import Models
from cohortkit.sources import ingest, registry

from .conftest import SF001


@pytest.fixture(scope="module")
def hot(spark):
    """1,000 users; user u0 writes a third of all reviews."""
    rnd = random.Random(3)
    users = [(f"u{i}", dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))) for i in range(1000)]
    reviews = []
    for j in range(30_000):
        u = "u0" if j % 3 == 0 else f"u{rnd.randint(1, 999)}"
        reviews.append((f"r{j}", u, dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 900))))
    u_df = spark.createDataFrame(
        [(u, None, 50, 5, 3.0, d, None) for u, d in users],
        "user_id string, name string, review_count int, fans int, average_stars double, yelping_since date, "
        "loaded_at timestamp_ntz").repartition(4)
    r_df = spark.createDataFrame(
        [(r, u, "b", 4.0, 1, 0, 0, d, None) for r, u, d in reviews],
        "review_id string, user_id string, business_id string, stars double, useful int, funny int, cool int, "
        "review_date date, loaded_at timestamp_ntz").repartition(6)
    return users, reviews, staging.stg_users(u_df), staging.stg_reviews(r_df)


def _month(d):
    return dt.date(d.year, d.month, 1)


def test_hot_user_retention_exact(hot):
    users, reviews, stg_u, stg_r = hot
    cohort = {u: _month(d) for u, d in users}
    pairs = {(u, _month(d)) for _, u, d in reviews}
    act = {}
    for u, m in pairs:
        c = cohort[u]
        k = (m.year - c.year) * 12 + m.month - c.month
        if k >= 0:
            act.setdefault((c, k), set()).add(u)
    counts = {key: len(v) for key, v in act.items()}

    def pct(a, b):  # exact HALF_UP, as NUMERIC rounding does
        q = (Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        return float(q)
    want = sorted((c, k, n, counts[(c, 0)], pct(n, counts[(c, 0)]))
                  for (c, k), n in counts.items() if (c, 0) in counts)
    got = sorted(tuple(r) for r in marts.retention_cohorts(stg_u, stg_r).collect())
    assert got == want


def test_hot_user_survival_exact(hot):
    users, reviews, stg_u, stg_r = hot
    df = pd.DataFrame(reviews, columns=["review_id", "user_id", "d"])
    agg = df.groupby("user_id")["d"].agg(["min", "max", "count"])
    got = {r.user_id: (r.first_review_date, r.last_review_date, r.total_reviews)
           for r in marts.survival_inputs(stg_u, stg_r, dt.date(2022, 1, 1)).collect()}
    assert got["u0"] == (agg.loc["u0", "min"], agg.loc["u0", "max"], 10_000)
    assert len(got) == len(agg)


def test_hot_key_dedup(spark):
    batch = spark.range(0, 60_000, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id AS arrival", "id AS v")
    target = spark.createDataFrame([("k1", 0, 0)], "k string, arrival long, v long")
    out = {r.k: r.v for r in ingest.insert_ignore(batch, target, "k", "arrival").collect()}
    assert out["hot"] == 0 and "k1" not in out and len(out) == 40_000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    fx = Models.from_fixtures(spark, SF001)
    for name in ("raw_reviews", "raw_users", "raw_launches"):
        registry.append_raw(fx.raw[name], root, name)
    return Models.from_tables(spark, root, FIXTURE_PARAMS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_staging_filter_pushed_to_scan(stored):
    text = _formatted(stored.stg_reviews)
    assert "PushedFilters: [IsNotNull(review_date)]" in text


def test_retention_reads_two_review_columns_and_preaggregates(stored):
    text = _formatted(stored.retention_cohorts)
    assert "ReadSchema: struct<user_id:string,review_date:date>" in text
    assert "partial_bit_or" in text and "ObjectHashAggregate" not in text


def test_first_wins_dedup_is_partial_aggregate(stored):
    raw = stored.raw_reviews
    text = _formatted(ingest.insert_ignore(raw.selectExpr("*", "0 as arrival"), raw.limit(0), "review_id", "arrival"))
    assert "partial_min" in text and "Window" not in text


def test_top_launches_is_bounded_topk(stored):
    from cohortkit.operators import datasets
    assert "TakeOrderedAndProject" in _plan(datasets.top_launches(stored.launch_performance))


def test_survival_windows_run_on_event_table(stored):
    from cohortkit.operators import survival
    text = _formatted(survival.km_by_segment(survival.km_input(stored.survival_inputs)))
    # Every Window sits above the (user_segment, t) aggregate, never over per-user rows.
    body = text.split("\n\n")[0]
    first_window = body.index("Window")
    assert "HashAggregate" in body[first_window:]


def test_bucketed_reviews_and_users_need_no_user_shuffle(spark, tmp_path):
    fx = Models.from_fixtures(spark, SF001)
    names = {"raw_reviews": "bk_reviews", "raw_users": "bk_users", "raw_launches": "bk_launches"}
    try:
        registry.save_bucketed(fx.raw_reviews, "bk_reviews", "user_id", 8, path=str(tmp_path / "r"), mode="overwrite")
        registry.save_bucketed(fx.raw_users, "bk_users", "user_id", 8, path=str(tmp_path / "u"), mode="overwrite")
        registry.save_bucketed(fx.raw_launches, "bk_launches", "product_url", 8, path=str(tmp_path / "l"),
                               mode="overwrite")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        m = Models.from_catalog(spark, FIXTURE_PARAMS, names)
        for df in (m.survival_inputs, m.retention_cohorts):
            plan = _plan(df)
            assert "Exchange hashpartitioning(user_id" not in plan
        assert sorted(tuple(r) for r in m.survival_inputs.collect()) == \
            sorted(tuple(r) for r in fx.survival_inputs.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        for t in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_hot_users_reviews_are_split_in_the_row_level_join(spark):
    """``user_activity`` under a shuffle join: the partition of a user with a third of all reviews is
    read by several tasks, each with its own copy of the narrow user row."""
    import datetime as dt

    from cohortkit.operators import marts
    users = spark.range(3000).selectExpr("concat('u', id) AS user_id", "DATE '2019-01-01' AS cohort_month")
    reviews = spark.range(0, 300_000, numPartitions=16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'u7' ELSE concat('u', id % 3000) END AS user_id",
        "add_months(DATE '2019-01-01', CAST(id * 7919 % 60 AS INT)) AS review_month", "sha2(CAST(id AS STRING), 256) AS pad")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = marts.user_activity(users, reviews)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in plan and "skew=true" in plan
        assert len(rows) == 300_000 and sum(r.user_id == "u7" for r in rows) > 100_000
        assert {r.cohort_month for r in rows} == {dt.date(2019, 1, 1)}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
