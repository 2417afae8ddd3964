"""The second-order booster against its SQL and a plain recount, with missing values, ties and odd inputs."""

import math
import random
from dataclasses import replace
from types import SimpleNamespace

import duckdb

from cohortkit import params as P
from cohortkit.operators import boosting as B
from cohortkit.plans import catalog
from cohortkit.plans import queries_analysis as Q

BORDERS = {"a": [1.0, 2.0, 3.0], "b": [0.5], "c": []}


def _rows(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.choice([None, 0.0, 1.0, 2.5, 7.0]), rng.choice([0.0, 1.0, None])
        y = int((a is None) != (rng.random() < 0.2)) if b == 1.0 else int(rng.random() < 0.5)
        out.append((f"u{i}", a, b, 1.0, y, "train" if i % 5 else "test"))
    return out


SCHEMA = "user_id string, a double, b double, c double, y int, split string"


def test_trees_scores_and_missing_sides_equal_sql(spark):
    settings = B.Settings(trees=3, depth=3, step=0.3)
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = B.fit(df.where("split = 'train'"), "y", BORDERS, settings)
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("data", pdf)
    views = B.boosting_sql("data", "y", BORDERS, settings)
    want = con.sql(f"WITH {views} SELECT tree, node, feature, bin, missing_left, gain FROM splits").fetchall()
    got = [tuple(r)[:6] for r in model.splits(spark).collect()]
    assert sorted(got) == sorted(want) and len(got) > 6
    assert {r[4] for r in got} == {True, False}   # missing values go both ways
    want = dict(con.sql(f"WITH {views} SELECT user_id, 1 / (1 + exp(-margin)) FROM margins").fetchall())
    for r in model.score(df).collect():
        assert math.isclose(r.score, want[r.user_id], abs_tol=1e-9)
    # Gains can be recounted for the root of the first tree: all hessians are a quarter.
    train = [r for r in rows if r[5] == "train"]
    best = model.trees[0].splits[1]
    f, cut, left = best[0], best[1], best[2]

    def side(r):
        v = r[1 + f]
        return left if v is None else sum(b <= v for b in list(BORDERS.values())[f]) <= cut
    worth = [sum(0.5 - r[4] for r in part) ** 2 / (len(part) / 4 + 1) for part in (
        [r for r in train if side(r)], [r for r in train if not side(r)], train)]
    assert math.isclose(best[3], worth[0] + worth[1] - worth[2], abs_tol=1e-5)


def test_storing_margins_changes_nothing(spark):
    df = spark.createDataFrame(_rows(150, 8), SCHEMA)
    a, b = (B.fit(df, "y", BORDERS, B.Settings(trees=3, depth=2, store_every=n)) for n in (1, 9))
    assert a.splits(spark).collect() == b.splits(spark).collect()


def test_odd_inputs(spark):
    df = spark.createDataFrame(_rows(60), SCHEMA)
    one = B.fit(df.selectExpr("*", "1 AS z"), "z", BORDERS, B.Settings(trees=2))
    assert one.splits(spark).count() == 0 and one.importance(spark).count() == 3
    scores = {round(r.score, 9) for r in one.score(df).collect()}
    assert len(scores) == 1 and min(scores) > 0.5
    empty = B.fit(df.limit(0), "y", BORDERS, B.Settings(trees=2))
    assert {r.score for r in empty.score(df).collect()} == {0.5}
    no_label = B.fit(df.selectExpr("*", "CAST(NULL AS INT) AS z"), "z", BORDERS, B.Settings(trees=1))
    assert {r.score for r in no_label.score(df).collect()} == {0.5}
    assert B.quantile_borders(df, ["a", "c"], 4)["c"] == [1.0]
    assert B.quantile_borders(df.limit(0), ["a"], 4) == {"a": []}


def test_rounds_in_sql_equal_the_unrolled_sql_and_the_model(spark):
    """Beyond a store of the margins, with keys that repeat or are null and rows of equal bins."""
    settings = B.Settings(trees=11, depth=2, step=0.3)
    rows = [(None if i % 50 == 0 else f"u{i % 90}", *r[1:]) for i, r in enumerate(_rows(300, 5))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    con = duckdb.connect()
    con.register("data", df.toPandas())
    con.register("own", spark.createDataFrame(_rows(), SCHEMA).toPandas())
    one, two = (con.sql(f"WITH {f('own', 'y', BORDERS, B.Settings(trees=3))} SELECT user_id, round(margin, 9) FROM margins ORDER BY 1").fetchall()
                for f in (B.boosting_sql, B.boosting_rounds_sql))
    assert one == two and len(one) == 400
    want = con.sql(f"WITH {B.boosting_rounds_sql('data', 'y', BORDERS, settings)} "
                   "SELECT coalesce(user_id, ''), label, round(1 / (1 + exp(-margin)), 9) FROM margins").fetchall()
    model = B.fit(df.where("split = 'train'"), "y", BORDERS, settings)
    got = [(r.user_id or "", r.y, round(r.score, 9)) for r in model.score(df).collect()]
    assert len(model.trees) == 11 and sorted(got) == sorted(want) and len(got) == 300


def test_scores_are_those_of_all_trees(spark, monkeypatch):
    """F1 of round 4: the query grew 2 of the 100 trees, in code and SQL."""
    users = [(f"u{i}", i % 300, 2 + i % 30, 1 + i % 5, float(i % 17), "New User" if i % 3 else "Power User") for i in range(200)]
    schema = "user_id string, survival_days int, total_reviews long, avg_stars double, avg_engagement_score double, user_segment string"
    users = spark.createDataFrame([(a, b, c, float(d), e, f) for a, b, c, d, e, f in users], schema)
    models = SimpleNamespace(spark=spark, source="own rows", params=P.FIXTURE_PARAMS, survival_inputs=users)
    asked, fit = [], B.fit

    def short(df, label, borders, settings):
        asked.append(settings)
        return fit(df, label, borders, replace(settings, trees=1))   # all trees take minutes; they are the same loop
    monkeypatch.setattr(B, "fit", short)
    assert catalog.MODEL_QUERIES["boosting_scores"](models).count() == 40
    assert [(s.trees, s.depth, s.step) for s in asked] == [(100, 4, 0.1)]
    held = catalog.ORACLE["boosting_scores"]
    assert B.boosting_rounds_sql("held", "churned_early", Q.BORDERS, asked[0]) in held
