"""Readers (JSON lines, launch pages), landing ids and the streaming ingest (FIXTURES.md B6, B7)."""

import datetime as dt
import json
import os

from cohortkit.sources import ingest, readers, registry
from cohortkit.streaming.ingest_stream import land_batch, stream_ingest

D = dt.date


def _write_lines(path, objs):
    with open(path, "w") as f:
        for o in objs:
            f.write((o if isinstance(o, str) else json.dumps(o)) + "\n")


def test_b7_review_lines(spark, tmp_path):
    p = tmp_path / "reviews.json"
    _write_lines(p, [
        {"review_id": "r1", "user_id": "u1", "business_id": "b", "stars": 4.0, "date": "2018-07-07 22:09:11",
         "funny": 2, "cool": 1},
        {"review_id": "r2", "user_id": "u1", "business_id": "b", "stars": "x", "date": "2018-07-07"},
        {"review_id": "r3", "business_id": "b", "stars": 3, "date": "2018-07-07"},
        "{not json",
    ])
    good, rejected = readers.read_reviews(spark, str(p))
    rows = good.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.review_id, r.stars, r.useful, r.funny, r.cool, r.review_date) == ("r1", 4.0, 0, 2, 1, D(2018, 7, 7))
    assert rejected.count() == 3


def test_b7_user_defaults(spark, tmp_path):
    p = tmp_path / "users.json"
    _write_lines(p, [{"user_id": "u1"}, {"user_id": "u2", "review_count": "many"}])
    good, rejected = readers.read_users(spark, str(p))
    r = good.first()
    assert (r.user_id, r.name, r.review_count, r.fans, r.average_stars, r.yelping_since) == (
        "u1", None, 0, 0, 0.0, D(2004, 1, 1))
    assert [x.user_id for x in rejected.collect()] == ["u2"]


def _page(no, nodes=(), has_next=True, errors=None):
    page = {"page_no": no, "data": {"posts": {"pageInfo": {"hasNextPage": has_next, "endCursor": f"c{no}"},
                                              "edges": [{"node": n} for n in nodes]}}}
    if errors:
        page = {"page_no": no, "errors": [{"message": "rate limited"}]}
    return page


def _write_pages(folder, pages):
    os.makedirs(folder, exist_ok=True)
    for p in pages:
        with open(os.path.join(folder, f"page_{p['page_no']:03d}.json"), "w") as f:
            json.dump(p, f, indent=2)


def test_b6_page_chain(spark, tmp_path):
    a = str(tmp_path / "a")
    _write_pages(a, [_page(1), _page(2), _page(3, errors=True), _page(4)])
    assert sorted(r.page_no for r in readers.valid_pages(readers.read_launch_pages(spark, a)).collect()) == [1, 2]
    b = str(tmp_path / "b")
    _write_pages(b, [_page(1), _page(2, has_next=False), _page(3)])
    assert sorted(r.page_no for r in readers.valid_pages(readers.read_launch_pages(spark, b)).collect()) == [1, 2]
    c = str(tmp_path / "c")
    _write_pages(c, [_page(i) for i in range(1, 13)])
    assert readers.valid_pages(readers.read_launch_pages(spark, c)).count() == 12
    assert readers.valid_pages(readers.read_launch_pages(spark, c), max_pages=10).count() == 10


def test_page_chain_stops_at_a_gap_and_keeps_unreadable_pages(spark, tmp_path):
    node = [{"name": "N", "website": "https://n.test"}]
    gap = str(tmp_path / "gap")
    _write_pages(gap, [_page(i, node) for i in (1, 2, 4)])
    assert sorted(r.page_no for r in readers.valid_pages(readers.read_launch_pages(spark, gap)).collect()) == [1, 2]
    late = str(tmp_path / "late")
    _write_pages(late, [_page(i, node) for i in (2, 3)])
    assert readers.valid_pages(readers.read_launch_pages(spark, late)).count() == 0
    broken = str(tmp_path / "broken")
    _write_pages(broken, [_page(1, node), _page(3, [{"name": "Z", "website": "https://z.test"}])])
    with open(os.path.join(broken, "page_002.json"), "w") as f:
        f.write('{"page_no": 2, "data": ')
    good, rejected = readers.parse_launch_pages(readers.read_launch_pages(spark, broken))
    assert [r.name for r in good.collect()] == ["N"]
    bad = rejected.collect()
    assert [r._reject_reason for r in bad] == ["unreadable page"] and '"data"' in bad[0]._corrupt_record


def test_whole_numbers_with_a_fraction_are_read(spark, tmp_path):
    p = tmp_path / "r.json"
    _write_lines(p, [{"review_id": "r1", "user_id": "u", "business_id": "b", "stars": 3, "date": "2020-01-01",
                      "useful": 3.0, "funny": "2.0", "cool": 1}])
    good, rejected = readers.read_reviews(spark, str(p))
    r = good.first()
    assert (r.useful, r.funny, r.cool) == (3, 2, 1) and rejected.count() == 0


def test_first_arrival_by_file_time_and_line(spark, tmp_path):
    from cohortkit import cli
    inbox = tmp_path / "in"
    inbox.mkdir()
    rec = lambda k, b, stars: {"review_id": k, "user_id": "u", "business_id": b, "stars": stars,
                               "date": "2020-01-01"}
    _write_lines(inbox / "z_old.json", [rec("r1", "zzz", 5.0), rec("r1", "aaa", 1.0), rec("r2", "zz", 5.0)])
    _write_lines(inbox / "a_new.json", [rec("r2", "aa", 1.0), rec("r3", "zz", 4.0), rec("r3", "aa", 2.0)]
                 + [rec(f"x{i}", "b" * 50, 3.0) for i in range(3000)])
    os.utime(inbox / "z_old.json", (1_600_000_000, 1_600_000_000))
    os.utime(inbox / "a_new.json", (1_600_000_500, 1_600_000_500))
    want = {"r1": ("zzz", 5.0), "r2": ("zz", 5.0), "r3": ("zz", 4.0)}
    root = str(tmp_path / "wh")
    cli.land(spark, "reviews", str(inbox), root)
    stream_ingest(spark, str(inbox), "reviews", str(tmp_path / "t"), str(tmp_path / "q"), str(tmp_path / "c")) \
        .awaitTermination(120)
    for table in (registry.read_raw(spark, root, "raw_reviews"), spark.read.parquet(str(tmp_path / "t"))):
        got = {r.review_id: (r.business_id, r.stars) for r in table.where("review_id like 'r%'").collect()}
        assert got == want and table.count() == 3003


def test_launches_keep_the_first_page_and_quarantine_once(spark, tmp_path):
    from cohortkit import cli
    pages = str(tmp_path / "p")
    dup = lambda name: {"name": name, "website": "https://same.test"}
    _write_pages(pages, [_page(1, [dup("first")]), _page(2, [{"name": "bad", "website": "w", "createdAt": ""}]),
                         _page(3, [dup("a-second")], has_next=False)])
    root = str(tmp_path / "wh")
    assert cli.land_launches(spark, pages, root) == 1 and cli.land_launches(spark, pages, root) == 0
    assert [r.name for r in registry.read_raw(spark, root, "raw_launches").collect()] == ["first"]
    assert spark.read.parquet(f"{root}/quarantine/raw_launches").count() == 1


def test_quarantine_of_a_relanded_file_stays(spark, tmp_path):
    from cohortkit import cli
    p = tmp_path / "u.json"
    _write_lines(p, [{"user_id": "a"}, {"user_id": "b", "fans": "x"}, "{broken"])
    root = str(tmp_path / "wh")
    for _ in range(2):
        assert cli.land(spark, "users", str(p), root)["rejected"] == 2
    assert spark.read.parquet(f"{root}/quarantine/raw_users").count() == 2


def test_unreadable_target_is_an_error(spark, tmp_path):
    import pytest
    from cohortkit.streaming.ingest_stream import _target_or_empty
    like = spark.range(1)
    assert _target_or_empty(spark, str(tmp_path / "none"), like).count() == 0
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|not a"):
        _target_or_empty(spark, str(tmp_path / "junk"), like).collect()


def test_sync_copies_all_tables_once(spark, tmp_path):
    from cohortkit import cli
    from cohortkit.plans.models import Models
    from .conftest import SF001
    fx = Models.from_fixtures(spark, SF001)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for name in cli.SYNCED:
        registry.append_raw(fx.raw[name], a, name)
    registry.append_raw(fx.raw_users.limit(10), b, "raw_users")
    added = cli.sync(spark, a, b)
    assert added == {"raw_launches": fx.raw_launches.count(), "raw_users": fx.raw_users.count() - 10,
                     "raw_reviews": fx.raw_reviews.count()}
    assert set(cli.sync(spark, a, b).values()) == {0}
    cols = cli.SYNCED["raw_reviews"][0]
    assert sorted(map(str, registry.read_raw(spark, b, "raw_reviews").select(*cols).collect())) == sorted(
        map(str, fx.raw_reviews.select(*cols).collect()))


def test_b6_node_cases(spark, tmp_path):
    nodes = [
        {"name": "A", "tagline": "t", "votesCount": 5, "topics": {"edges": []}, "thumbnail": {"type": "FreeImage"},
         "createdAt": "2024-01-05T08:01:00Z", "website": None},
        {"name": "B", "votesCount": 7, "topics": {"edges": [{"node": {"name": "AI"}}, {"node": {"name": "X"}}]},
         "thumbnail": None, "createdAt": "2024-13-40", "website": ""},
        {"name": "C", "votesCount": 1, "createdAt": None, "website": "https://c.test"},
        {"votesCount": 1, "website": None},
    ]
    folder = str(tmp_path / "p")
    _write_pages(folder, [_page(1, nodes, has_next=False)])
    good, rejected = readers.parse_launch_pages(readers.read_launch_pages(spark, folder), "https://x.test/posts/")
    got = {r.name: r for r in good.collect()}
    assert got["A"].category is None and got["A"].pricing_type == "Free"
    assert got["A"].launch_date == D(2024, 1, 5) and got["A"].product_url == "https://x.test/posts/A"
    assert got["C"].launch_date is None and got["C"].product_url == "https://c.test"
    bad = {r.name: r for r in rejected.collect()}
    assert set(bad) == {"B", None} and bad["B"]._reject_reason == "unparsable value"
    assert bad["B"].category == "AI" and bad["B"].product_url == "https://x.test/posts/B"


def test_land_with_audit_dense_ids(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("concat('k', id) AS product_url")
    landed = ingest.land_with_audit(df, "product_url", "id", "scraped_at", load_ts="2024-01-01 00:00:00", start_id=101)
    ids = sorted(r.id for r in landed.collect())
    assert ids == list(range(101, 1101))


def test_materialize_and_read_raw(spark, tmp_path):
    root = str(tmp_path / "wh")
    df = spark.createDataFrame(
        [("r1", "u1", "b", 4.0, 0, 0, 0, D(2020, 1, 1), None)],
        "review_id string, user_id string, business_id string, stars double, useful int, funny int, cool int, "
        "review_date date, loaded_at timestamp_ntz")
    registry.append_raw(df, root, "raw_reviews")
    registry.append_raw(df, root, "raw_reviews")
    assert registry.read_raw(spark, root, "raw_reviews").count() == 2
    paths = registry.materialize({"t": df}, root)
    assert spark.read.parquet(paths["t"]).count() == 1


def test_stream_ingest_once_and_restart(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    rec = lambda i, stars=4.0: {"review_id": f"r{i}", "user_id": "u1", "business_id": "b", "stars": stars,
                                "date": "2020-01-01"}
    _write_lines(inbox / "f1.json", [rec(1), rec(2), rec(2, 1.0)])
    _write_lines(inbox / "f2.json", [rec(2, 2.0), rec(3), {"review_id": "r9", "stars": 1}])
    target, quarantine, ckpt = (str(tmp_path / n) for n in ("target", "quarantine", "ckpt"))
    q = stream_ingest(spark, str(inbox), "reviews", target, quarantine, ckpt, files_per_trigger=1,
                      load_ts="2024-01-01 00:00:00")
    q.awaitTermination(120)
    rows = {r.review_id: r.stars for r in spark.read.parquet(target).collect()}
    assert rows == {"r1": 4.0, "r2": 4.0, "r3": 4.0}
    assert spark.read.parquet(quarantine).drop("batch_id").count() == 1
    # Restart with the same checkpoint and an overlapping new file: nothing is duplicated.
    _write_lines(inbox / "f3.json", [rec(3, 5.0), rec(4)])
    q = stream_ingest(spark, str(inbox), "reviews", target, quarantine, ckpt, load_ts="2024-01-01 00:00:00")
    q.awaitTermination(120)
    rows = sorted(r.review_id for r in spark.read.parquet(target).collect())
    assert rows == ["r1", "r2", "r3", "r4"]


def test_bounded_ingest_large_cap_is_exact(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 120_000, numPartitions=9).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    got = ingest.bounded_ingest(df, "k", 25_000)
    want = sorted(r.k for r in df.select("k").collect())[:25_000]
    assert sorted(r.k for r in got.select("k").collect()) == want


def test_anti_join_against_bucketed_target_shuffles_only_the_batch(spark, tmp_path):
    from pyspark.sql import functions as F
    target = spark.range(0, 5000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("review_id"),
                                         F.lit(1.0).alias("stars"))
    registry.save_bucketed(target, "bucketed_target_t", "review_id", 8, path=str(tmp_path / "bt"), mode="overwrite")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(4990, 5010).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("review_id"),
                                               F.lit(2.0).alias("stars"), F.lit(0).alias("arrival"))
        out = ingest.insert_ignore(batch, spark.table("bucketed_target_t"), "review_id", "arrival")
        assert sorted(r.review_id for r in out.collect()) == [f"r{i}" for i in range(5000, 5010)]
        plan = out._jdf.queryExecution().executedPlan().toString()
        scan_side = plan.split("FileScan parquet spark_catalog.default.bucketed_target_t")[0].splitlines()[-1]
        assert "Exchange" not in scan_side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.sql("DROP TABLE IF EXISTS bucketed_target_t")


def test_land_batch_retry_is_idempotent(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    _write_lines(inbox / "f.json", [{"review_id": f"r{i}", "user_id": "u", "business_id": "b", "stars": 3,
                                     "date": "2021-02-03"} for i in range(50)] + ["{broken"])
    batch = readers._json(spark, str(inbox), readers.S.REVIEW_JSON)
    target, quarantine = str(tmp_path / "t"), str(tmp_path / "q")
    for _ in range(3):  # the same batch delivered again after a failure
        land_batch(batch, 7, "reviews", target, quarantine, load_ts="2024-01-01 00:00:00")
    assert spark.read.parquet(target).count() == 50
    assert spark.read.parquet(quarantine).count() == 1


def test_land_batch_parses_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    parsed, number = spark.sparkContext.accumulator(0), readers._num

    def add(value):
        parsed.add(1)
        return value

    def counted(raw, kind, default=None):
        value, bad = number(raw, kind, default)
        return (F.udf(add, "double")(value), bad) if raw == "stars" else (value, bad)

    monkeypatch.setattr(readers, "_num", counted)
    rows = spark.createDataFrame([(f"r{i}", "u", "b", "3" if i else "x", "2021-02-03", "1", "1", "1", None, i) for i in range(9)],
                                 "review_id string, user_id string, business_id string, stars string, date string, "
                                 "useful string, funny string, cool string, _corrupt_record string, _arrival int")
    land_batch(rows, 1, "reviews", str(tmp_path / "t"), str(tmp_path / "q"), load_ts="2024-01-01 00:00:00")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8 and spark.read.parquet(str(tmp_path / "q")).count() == 1
    assert parsed.value == 9


def test_stream_users_defaults(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    _write_lines(inbox / "u.json", [{"user_id": "a", "review_count": 3}, {"user_id": "b", "fans": "x"},
                                    {"user_id": "a", "review_count": 9}])
    target, quarantine, ckpt = (str(tmp_path / n) for n in ("t", "q", "c"))
    stream_ingest(spark, str(inbox), "users", target, quarantine, ckpt, load_ts="2024-01-01 00:00:00") \
        .awaitTermination(120)
    rows = spark.read.parquet(target).collect()
    assert [(r.user_id, r.review_count, r.yelping_since) for r in rows] == [("a", 3, D(2004, 1, 1))]
    assert [r.user_id for r in spark.read.parquet(quarantine).collect()] == ["b"]


def test_cli_help_runs():
    import subprocess
    import sys
    out = subprocess.run([sys.executable, "-m", "cohortkit", "--help"], capture_output=True, text=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
    assert out.returncode == 0 and "land-launches" in out.stdout


def test_one_bad_value_rejects_one_post(spark, tmp_path):
    from cohortkit import cli
    folder, root = str(tmp_path / "p"), str(tmp_path / "wh")
    n = lambda i, **kw: {"name": f"n{i}", "website": f"https://n{i}.test", **kw}
    _write_pages(folder, [_page(1, [n(10, votesCount=1)]), _page(2, [n(20, votesCount=3), n(21, votesCount="many")]),
                          _page(3, [n(30)], has_next=False)])
    # The same whether a branch reads the votes or not, the frame is cached or not.
    for pages in (readers.read_launch_pages(spark, folder), readers.read_launch_pages(spark, folder).cache()):
        good, rejected = readers.parse_launch_pages(pages)
        assert sorted(r.name for r in good.select("name").collect()) == ["n10", "n20", "n30"]
        assert sorted((r.name, r.upvotes) for r in good.collect()) == [("n10", 1), ("n20", 3), ("n30", None)]
        bad = rejected.collect()
        assert [(r.name, r.page_no, r._reject_reason) for r in bad] == [("n21", 2, "unparsable value")]
        assert json.loads(bad[0]._corrupt_record)["node"]["votesCount"] == "many"
        assert rejected.count() == 1
    assert cli.land_launches(spark, folder, root) == 3
    assert spark.read.parquet(f"{root}/quarantine/raw_launches").count() == 1


def test_odd_posts_and_pages_are_all_accounted_for(spark, tmp_path):
    n = lambda i, **kw: {"name": f"n{i}", "website": f"https://n{i}.test", **kw}
    fine = [n(1, votesCount="7"), n(2, votesCount=3.0), n(3, votesCount=2.5), n(4, votesCount=None), n(5, topics=None),
            n(6, topics={"edges": None}), n(7, topics={"edges": [{"node": {"name": None}}]}), n(8, thumbnail=None),
            n(9, createdAt="2020-02-29 and more"), n(10, extra={"a": [1]}), n(11, tagline=5), {"name": 12, "website": 0}]
    bad = [n(21, votesCount=True), n(22, votesCount=[1]), n(23, votesCount="3.5"), n(24, votesCount=2 ** 40), n(25, topics="x"),
           n(26, topics={"edges": "x"}), n(27, topics={"edges": ["x"]}), n(28, topics={"edges": [{"node": 1}]}),
           n(29, topics={"edges": [{"node": {"name": ["x"]}}]}), n(30, thumbnail="t"), n(31, thumbnail={"type": 1}),
           n(32, createdAt=20200101), n(33, createdAt="soon"), n(34, website={"u": 1}), {"name": ["x"]}, n(36, tagline={})]
    page = _page(1, [*fine, *bad])
    page["data"]["posts"]["edges"] += [{"node": None}, {}, None, "x", 5]
    docs = [json.dumps(page), "[" + json.dumps(_page(2, [n(40)])) + ", 7]", '{"page_no": 3, "data": {"posts": {}}}', '{"page_no": "x"}',
            "{", "null", "", "  ", '{"a": 1, "a": 2}', json.dumps(_page(4, [n(50)]))]
    pages = readers.launch_pages(spark.createDataFrame([(d,) for d in docs], "value string"))
    good, rejected = readers.parse_launch_pages(pages, "https://x.test/")
    got = {r.name: r for r in good.collect()}
    assert set(got) == {*(f"n{i}" for i in range(1, 12)), "12", "n40"}
    assert [got[f"n{i}"].upvotes for i in (1, 2, 3, 4)] == [7, 3, 3, None]
    assert got["n9"].launch_date == D(2020, 2, 29) and got["n11"].tagline == "5"
    assert got["12"].product_url == "0"
    reasons = [r._reject_reason for r in rejected.collect()]
    # Page 3 lists no posts: it is unreadable, and page 4 lies behind it.
    assert reasons.count("unreadable page") == 6
    assert len(reasons) - 6 == len(bad) + 5
    assert all(r._corrupt_record for r in rejected.collect())
