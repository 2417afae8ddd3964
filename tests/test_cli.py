"""End to end: land JSON files and pages, build marts, write every analysis dataset."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cohortkit import cli
from cohortkit.params import FIXTURE_PARAMS
from cohortkit.plans.models import Models
from cohortkit.sources import registry

from .conftest import SF001


def _export_json(spark, tmp_path):
    fx = Models.from_fixtures(spark, SF001)
    reviews = str(tmp_path / "in_reviews")
    users = str(tmp_path / "in_users")
    (fx.raw_reviews.select("review_id", "user_id", "business_id", "stars",
                           F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("date"),
                           "useful", "funny", "cool")
     .write.json(reviews))
    (fx.raw_users.where(F.col("yelping_since").isNotNull())
     .select("user_id", "name", "review_count", F.date_format("yelping_since", "yyyy-MM-dd").alias("yelping_since"),
             "fans", "average_stars")
     .write.json(users))
    return fx, reviews, users


def test_land_build_analyze(spark, tmp_path):
    fx, reviews, users = _export_json(spark, tmp_path)
    root = str(tmp_path / "wh")
    rep = cli.land(spark, "reviews", reviews, root, load_ts="2001-08-01 00:00:00")
    n_dated = fx.raw_reviews.where("review_date IS NOT NULL").count()
    assert rep == {"inserted": n_dated, "duplicate": 0, "rejected": fx.raw_reviews.count() - n_dated}
    cli.land(spark, "users", users, root, load_ts="2001-08-01 00:00:00")
    again = cli.land(spark, "reviews", reviews, root, load_ts="2001-08-01 00:00:00")
    assert again["inserted"] == 0 and again["duplicate"] == n_dated
    assert registry.read_raw(spark, root, "raw_reviews").count() == n_dated

    # Landed rows equal the fixture rows (nothing lost or altered on the way through JSON).
    a = sorted(tuple(r) for r in registry.read_raw(spark, root, "raw_reviews").drop("loaded_at").collect())
    b = sorted(tuple(r) for r in fx.raw_reviews.where("review_date IS NOT NULL").drop("loaded_at").collect())
    assert a == b

    registry.append_raw(fx.raw_launches, root, "raw_launches")
    paths = cli.build(spark, root, FIXTURE_PARAMS.as_of, gate=False)
    ret = spark.read.parquet(paths["fct_retention_cohorts"])
    assert sorted(tuple(r) for r in ret.collect()) == sorted(tuple(r) for r in fx.retention_cohorts.collect())

    out = cli.analyze(spark, root, FIXTURE_PARAMS, with_model=False)
    med = spark.read.parquet(out["km_median"]).first()
    assert med.median_days == 270
    assert spark.read.parquet(out["top_launches"]).count() == 10
    # Datasets derived from the stored event tables equal the registered queries.
    from cohortkit.plans import catalog
    catalog.load_all()
    for key in ("km_by_segment", "segment_table", "km_milestones", "km_confidence", "km_median_by_segment"):
        got = sorted(map(tuple, spark.read.parquet(out[key]).collect()))
        want = sorted(map(tuple, catalog.QUERIES[key](spark, SF001).collect()))
        assert got == want, key


def _page(no, nodes, has_next):
    return {"page_no": no, "data": {"posts": {"pageInfo": {"hasNextPage": has_next, "endCursor": "c"},
                                              "edges": [{"node": n} for n in nodes]}}}


def test_land_launches_twice(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    nodes1 = [{"name": f"tool{i}", "votesCount": i * 10, "createdAt": "2024-01-0%dT00:00:00Z" % (1 + i % 9),
               "website": f"https://t{i}.test", "topics": {"edges": [{"node": {"name": "AI"}}]}} for i in range(5)]
    with open(pages / "p1.json", "w") as f:
        json.dump(_page(1, nodes1, False), f)
    root = str(tmp_path / "wh")
    assert cli.land_launches(spark, str(pages), root, load_ts="2024-02-01 00:00:00") == 5
    nodes2 = nodes1 + [{"name": "new", "votesCount": 800, "website": "https://new.test"}]
    with open(pages / "p1.json", "w") as f:
        json.dump(_page(1, nodes2, False), f)
    assert cli.land_launches(spark, str(pages), root, load_ts="2024-02-02 00:00:00") == 1
    raw = registry.read_raw(spark, root, "raw_launches")
    assert sorted(r.id for r in raw.collect()) == [1, 2, 3, 4, 5, 6]
    assert raw.where("name = 'new'").first().id == 6
    assert raw.where("name = 'new'").first().launch_date is None
    assert os.path.isdir(os.path.join(root, "quarantine", "raw_launches"))
    assert dt.date(2024, 1, 1) in {r.launch_date for r in raw.collect()}


def test_land_with_row_cap(spark, tmp_path):
    fx, reviews, _ = _export_json(spark, tmp_path)
    root = str(tmp_path / "wh")
    rep = cli.land(spark, "reviews", reviews, root, max_rows=100, load_ts="2001-08-01 00:00:00")
    assert rep["inserted"] == 100
    landed = sorted(r.review_id for r in registry.read_raw(spark, root, "raw_reviews").collect())
    first = sorted(r.review_id for r in fx.raw_reviews.where("review_date IS NOT NULL").collect())[:100]
    assert landed == first


def test_main_build_and_analyze_commands(spark, tmp_path, capsys):
    fx = Models.from_fixtures(spark, SF001)
    root = str(tmp_path / "wh")
    for name in ("raw_reviews", "raw_users", "raw_launches"):
        registry.append_raw(fx.raw[name], root, name)
    cli.main(["build", "--root", root, "--as-of", "2001-08-01", "--no-gate", "--min-group", "20"])
    built = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(built) == {"fct_launch_performance", "fct_category_performance", "fct_retention_cohorts",
                          "fct_survival_inputs"}
    cli.main(["analyze", "--root", root, "--as-of", "2001-08-01", "--no-model", "--min-group", "20",
              "--cohort-from", "1996-01-01", "--cohort-to", "2000-01-01"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    segs = {r.user_segment for r in spark.read.parquet(out["segment_table"]).collect()}
    assert segs == {"Power User", "Regular User"}  # Casual has 15 users and New 9, below 20
    assert spark.read.parquet(out["retention_curves"]).count() > 0


def test_land_removes_its_scratch_copy(spark, tmp_path):
    import glob as _glob
    from cohortkit.session import checkpoint_dir
    _, reviews, _ = _export_json(spark, tmp_path)
    base = checkpoint_dir(spark).replace("file:", "").rstrip("/")
    before = set(_glob.glob(f"{base}/land-raw_reviews-*"))
    cli.land(spark, "reviews", reviews, str(tmp_path / "wh"), load_ts="2001-08-01 00:00:00")
    assert set(_glob.glob(f"{base}/land-raw_reviews-*")) == before


def test_stream_command_lands_into_raw_table(spark, tmp_path):
    _, reviews, _ = _export_json(spark, tmp_path)
    root, ckpt = str(tmp_path / "wh"), str(tmp_path / "ckpt")
    cli.stream(spark, "reviews", reviews, root, ckpt, bytes_per_trigger=1 << 20)
    landed = registry.read_raw(spark, root, "raw_reviews")
    n = landed.count()
    assert n > 0 and landed.select("review_id").distinct().count() == n
    cli.stream(spark, "reviews", reviews, root, ckpt)  # restart: nothing new, nothing duplicated
    assert registry.read_raw(spark, root, "raw_reviews").count() == n
