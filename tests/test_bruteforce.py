"""Randomised fixtures checked against plain-Python brute force (one Spark job per test)."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from cohortkit.functions import columns as C
from cohortkit.operators import metrics, survival
from cohortkit.params import Z_95
from cohortkit.sources import ingest


def _half_up(x: Decimal, places: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def _r6(x: float) -> float:
    """Round a double as Spark and DuckDB do: its shortest decimal form, HALF_UP."""
    return _half_up(Decimal(repr(x)), 6)


def test_exact_pct_random(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 10**7), rnd.randint(1, 10**7)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", C.exact_pct("a", "b", 2).alias("p")).collect()
    for r in got:
        assert r.p == _half_up(Decimal(r.a) * 100 / Decimal(r.b), 2), (r.a, r.b)


def test_round_avg_random_groups(spark):
    rnd = random.Random(12)
    rows = [(g, rnd.randint(0, 999) / 100) for g in range(200) for _ in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(C.round_avg("x", 1).alias("m")).collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(Decimal(str(x)))
    for g, xs in groups.items():
        assert got[g] == _half_up(sum(xs) / len(xs), 1), g


def _km_python(pairs):
    """Product-limit estimate, Greenwood variance, median and band, by hand."""
    times = sorted({t for t, _ in pairs} | {0})
    s, var, out, exhausted = 1.0, 0.0, {}, False
    for t in times:
        n = sum(1 for d, _ in pairs if d >= t)
        d = sum(1 for x, e in pairs if x == t and e)
        if n:
            s *= 1.0 - d / n
            if d == n:
                exhausted = True
            elif d:
                var += d / (n * (n - d))
        out[t] = (n, d, s, None if exhausted else var)
    return out


def test_kaplan_meier_random_groups(spark):
    rnd = random.Random(13)
    data = {g: [(rnd.randint(0, 60), rnd.random() < 0.6) for _ in range(rnd.randint(1, 40))] for g in range(60)}
    rows = [(g, t, e) for g, ps in data.items() for t, e in ps]
    df = spark.createDataFrame(rows, "g int, survival_days int, churned boolean")
    curve = survival.km_curve(survival.km_event_table(df, by="g"), by="g", z=Z_95).collect()
    medians = {r.g: r.median_days for r in survival.km_median(
        survival.km_curve(survival.km_event_table(df, by="g"), by="g"), by="g").collect()}
    reads = {(r.g, r.days): r.survival for r in survival.km_at(
        survival.km_curve(survival.km_event_table(df, by="g"), by="g"), [5, 30, 61], by="g").collect()}
    seen = set()
    for r in curve:
        exp = _km_python(data[r.g])[r.t]
        assert (r.at_risk, r.observed) == exp[:2]
        assert abs(r.survival_raw - exp[2]) < 1e-12
        s, v = exp[2], exp[3]
        if 0 < s < 1 and v is not None:
            lo = s ** math.exp(-Z_95 * math.sqrt(v) / math.log(s))
            assert r.ci_lower is not None and abs(r.ci_lower - round(lo, 6)) <= 1e-6
        else:
            assert r.ci_lower is None
        seen.add((r.g, r.t))
    for g, ps in data.items():
        km = _km_python(ps)
        assert {t for gg, t in seen if gg == g} == set(km)
        below = [t for t, v in sorted(km.items()) if v[2] <= 0.5]
        assert medians[g] == (below[0] if below else None)
        for x in (5, 30, 61):
            before = [v[2] for t, v in sorted(km.items()) if t <= x]
            assert reads[(g, x)] == _r6(before[-1])


def test_insert_ignore_and_report_random(spark):
    rnd = random.Random(14)
    target_keys = set(rnd.sample(range(300), 120))
    batch = [(rnd.choice([None] + list(range(300))), rnd.randint(0, 10**6), i) for i in range(1500)]
    tdf = spark.createDataFrame([(k, -1, -1) for k in target_keys], "k int, v int, arrival int")
    bdf = spark.createDataFrame(batch, "k int, v int, arrival int").repartition(7)
    got = {r.k: r.v for r in ingest.insert_ignore(bdf, tdf, "k", "arrival").collect()}
    want = {}
    for k, v, _ in batch:  # rows in arrival order, first one wins, existing keys ignored
        if k is not None and k not in target_keys and k not in want:
            want[k] = v
    assert got == want
    report = {r.outcome: r.rows for r in ingest.ingest_report(bdf, tdf, "k").collect()}
    good = sum(1 for k, _, _ in batch if k is not None)
    assert report == {"inserted": len(want), "duplicate": good - len(want), "rejected": len(batch) - good}


def test_classification_report_random(spark):
    rnd = random.Random(15)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 1)) for _ in range(777)]
    rep = {r["class"]: r for r in metrics.classification_report(
        spark.createDataFrame(rows, "label int, prediction int")).collect()}
    tp = sum(1 for y, p in rows if y == 1 and p == 1)
    fp = sum(1 for y, p in rows if y == 0 and p == 1)
    tn = sum(1 for y, p in rows if y == 0 and p == 0)
    fn = sum(1 for y, p in rows if y == 1 and p == 0)
    p1, r1 = tp / (tp + fp), tp / (tp + fn)
    assert rep["1"].precision == _r6(p1) and rep["1"].recall == _r6(r1)
    assert rep["1"].f1 == _r6(2 * p1 * r1 / (p1 + r1))
    assert rep["accuracy"].f1 == _r6((tp + tn) / len(rows)) and rep["0"].support == tn + fp
    df = spark.createDataFrame([(y, float(p)) for y, p in rows], "label int, score double")
    assert metrics.roc_auc(df).first().auc == _r6(
        sum((a > b) + 0.5 * (a == b) for y1, a in rows if y1 == 1 for y0, b in rows if y0 == 0)
        / (sum(1 for y, _ in rows if y == 1) * sum(1 for y, _ in rows if y == 0)))


def test_column_functions_random(spark):
    import datetime as dt

    rnd = random.Random(16)
    base = dt.date(1990, 1, 1)
    rows = []
    for _ in range(4000):
        a = base + dt.timedelta(days=rnd.randint(0, 15000))
        b = base + dt.timedelta(days=rnd.randint(0, 15000))
        n = rnd.choice([None] + list(range(-5, 200)))
        stars = rnd.choice([None, 1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0])
        text = rnd.choice([a.isoformat() + "T10:11:12Z", a.isoformat(), "2024-13-40", "junk", None,
                           a.isoformat() + " 22:09:11"])
        rows.append((a, b, n, stars, text))
    df = spark.createDataFrame(rows, "a date, b date, n int, stars double, text string")
    out = df.select(
        C.months_between_starts(C.month_start("a"), C.month_start("b")).alias("m"),
        C.days_between("a", "b").alias("d"),
        C.user_segment("n").alias("seg"), C.influence_tier("n").alias("inf"), C.traction_tier("n").alias("tr"),
        C.sentiment("stars").alias("sent"), C.iso_date_prefix("text").alias("parsed")).collect()

    def tier(v, table, default):
        return next((label for lo, label in table if v is not None and v >= lo), default)

    for (a, b, n, stars, text), r in zip(rows, out):
        assert r.m == (a.year - b.year) * 12 + a.month - b.month
        assert r.d == (a - b).days
        assert r.seg == tier(n, [(100, "Power User"), (20, "Regular User"), (5, "Casual User")], "New User")
        assert r.inf == tier(n, [(100, "Influencer"), (10, "Active")], "Standard")
        assert r.tr == tier(n, [(700, "High Traction"), (500, "Medium Traction")], "Low Traction")
        assert r.sent == ("Positive" if stars is not None and stars >= 4 else
                          "Neutral" if stars == 3 else "Negative")
        try:
            want = dt.date.fromisoformat(text[:10]) if text else None
        except ValueError:
            want = None
        assert r.parsed == want, text
