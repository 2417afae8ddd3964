"""Dense ids, balanced AUC ranges, the exact hold-out side, month bitmaps, unique checks in one exchange."""

import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from cohortkit.operators import churn, marts, metrics
from cohortkit.operators import quality as Q
from cohortkit.sources import ingest


def test_ids_do_not_depend_on_partitions(spark):
    rows = [(f"k{i % 900}", i) for i in range(1000)] + [(None, 5), (None, 5)]
    got = []
    for parts in (1, 7, 40):
        df = spark.createDataFrame(rows, "k string, v long").repartition(parts)
        got.append(sorted(map(str, ingest.land_with_audit(df, "k", "id", None).collect())))
    assert got[0] == got[1] == got[2]
    ids = sorted(r.id for r in ingest.land_with_audit(df, "k", "id", None, start_id=5, digits=1).collect())
    assert ids == list(range(5, 5 + len(rows)))
    assert ingest.land_with_audit(df.limit(0), "k").count() == 0


def test_no_task_of_the_ids_has_more_than_its_share(spark):
    n, tasks = 10_000_000, 64
    df = spark.range(0, n, 1, 8).select(F.concat(F.lit("k"), "id").alias("k"))
    held = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per = (ingest.land_with_audit(df, "k", "id", None).groupBy(F.spark_partition_id().alias("p"))
               .agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("id").alias("s")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held[0])
        spark.conf.set("spark.sql.adaptive.enabled", held[1])
    assert len(per) == tasks and max(r.n for r in per) < 1.1 * n / tasks
    assert min(r.lo for r in per) == 1 and max(r.hi for r in per) == n and sum(r.s for r in per) == n * (n + 1) // 2


def _auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return round(sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)), 6)


def test_crowded_and_outlying_scores_are_spread(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(2), 0.001 + rng.random() / 10_000) for _ in range(600)]
    rows += [(rng.randrange(2), rng.choice([-3.5, -1e300, 0.0, 7.25, 1e300, 0.00105])) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    by_score = df.groupBy(F.col("score").alias("s")).agg(F.sum("label").alias("pos"))
    ranged = metrics.score_ranges(by_score, groups=8)
    inside = ranged.where("s >= 0.001 and s <= 0.0011").groupBy("r").count().collect()
    assert len(inside) >= 32 and max(r["count"] for r in inside) <= 4 * by_score.count() / len(inside)
    # In order: no range holds a score below one of an earlier range.
    span = ranged.groupBy("r").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("r").collect()
    assert all(a.hi < b.lo for a, b in zip(span, span[1:], strict=False))
    for ranges in (1, 4, 60, 1024):
        assert metrics.roc_auc(df, ranges=ranges).first().auc == _auc(rows)
    assert metrics.roc_auc(df.limit(0)).first().auc is None
    assert metrics.roc_auc(spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")).first().auc == 0.5


def test_the_hold_out_side_has_exactly_a_fifth(spark):
    for n in (0, 1, 4, 5, 6, 101, 1234):
        users = [f"u{i}" for i in range(n)]
        df = spark.createDataFrame([(u,) for u in users], "user_id string").repartition(3)
        held = {r.user_id for r in churn.churn_split(df).where("split = 'test'").collect()}
        k = -(-n * 20 // 100)
        assert held == set(sorted(users, key=lambda u: hashlib.md5(u.encode()).hexdigest())[:k])
    none = spark.createDataFrame([(None,), ("a",), ("b",)], "user_id string")
    assert churn.churn_split(none).where("split = 'train'").count() >= 1


def test_the_kth_hash_where_prefixes_are_shared(spark):
    hashes = [f"{'ab' * 10}{i:012x}" for i in range(50)] + [f"{'ab' * 3}{i:026x}" for i in range(9)] + ["0" * 32] * 3
    df = spark.createDataFrame([(h,) for h in hashes], "h string")
    for k in (1, 3, 4, 12, 13, 62):
        got = spark.range(1).select(churn.kth_smallest_hash(df, F.lit(k)).alias("x")).first().x
        assert got == sorted(hashes)[k - 1]
    assert spark.range(1).select(churn.kth_smallest_hash(df, F.lit(63)).alias("x")).first().x is None


def test_any_month_has_its_bit(spark):
    days = [dt.date(1, 1, 5), dt.date(1600, 2, 29), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2004, 10, 1), dt.date(2004, 10, 30),
            dt.date(2009, 5, 5), dt.date(2015, 4, 30), dt.date(9999, 12, 1)]
    rng = random.Random(1)
    reviews = [(f"u{rng.randrange(12)}", rng.choice(days)) for _ in range(300)]
    users = [(f"u{i}", dt.date(1, 1, 1) if i % 3 else dt.date(2004, 10, 1)) for i in range(11)]
    rdf = spark.createDataFrame([(u, d, d.replace(day=1), 1.0, 1.0) for u, d in reviews],
                                "user_id string, review_date date, review_month date, stars double, engagement_score double")
    udf = spark.createDataFrame(users, "user_id string, cohort_month date")
    want = {}
    for u, cohort in users:
        for m in {d.replace(day=1) for w, d in reviews if w == u}:
            if m >= cohort:
                at = (cohort, (m.year - cohort.year) * 12 + m.month - cohort.month)
                want[at] = want.get(at, 0) + 1
    got = {(r.cohort_month, r.months_since_joining): r.active_users for r in marts.cohort_activity(udf, rdf).collect()}
    assert got == want
    months = {r.user_id: r.active_months for r in marts.review_activity_from_profile(marts.user_review_profile(rdf)).collect()}
    assert months == {u: len({(d.year, d.month) for w, d in reviews if w == u}) for u in {u for u, _ in reviews}}
    assert marts.cohort_activity(udf, rdf.limit(0)).count() == 0


def test_unique_checks_of_all_models_share_one_exchange(spark):
    a = spark.createDataFrame([(1, "x", "p"), (1, "x", "q"), (2, None, "q"), (3, None, "z"), (3, "y", None)], "k int, s string, c string")
    b = spark.createDataFrame([("x",), ("x",), ("y",)], "s string")
    suite = [Q.Check("a", "unique", "k"), Q.Check("a", "unique", "s"), Q.Check("a", "accepted_values", "c", values=("p", "q")),
             Q.Check("b", "unique", "s"), Q.Check("b", "accepted_values", "s", values=("none",))]
    report = Q.dq_report({"a": a, "b": b}, suite)
    assert {r.check_id: r.failing_rows for r in report.collect()} == {
        "a.k.unique": 2, "a.s.unique": 1, "a.c.accepted_values": 1, "b.s.unique": 1, "b.s.accepted_values": 2}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [check") == 1
    report.explain("formatted")
    empty = Q.dq_report({"a": a.limit(0), "b": b.limit(0)}, suite)
    assert [r.failing_rows for r in empty.collect()] == [0] * 5
