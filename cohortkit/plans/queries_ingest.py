"""Data-quality and ingest queries with their oracle SQL.

Ingest keys follow FIXTURES.md: the target holds the raw reviews with an even order
key; the batch is every raw review (arrival 1) plus the reviews whose order key is a
multiple of 3 again (arrival 2, stars replaced by 0).  The parity rule only decides
which keys already exist in the target; the batch is always the whole table (and
more), so the work of every ingest key grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..cli import SYNCED
from ..operators import quality
from ..params import FIXTURE_PARAMS, LAUNCH_URL_PREFIX
from ..sources import ingest
from .catalog import register
from .oracle import with_models

REVIEW_COLS = ["review_id", "user_id", "business_id", "stars", "useful", "funny", "cool",
               "review_date", "loaded_at"]
USER_SYNC_COLS = ["user_id", "name", "review_count", "yelping_since", "fans", "average_stars"]


# ----------------------------------------------------------------- quality
def _staging(m):
    return m.staging_views()


SUITE = quality.suite(FIXTURE_PARAMS)

for _kind in ("not_null", "unique", "accepted_values", "row_count", "between"):
    register(f"dq_{_kind}", with_models(quality.suite_sql(SUITE, kinds=[_kind])))(
        (lambda k: lambda m: quality.dq_report(_staging(m), SUITE, kinds=[k]))(_kind))

# Referential integrity (a supported check kind, not part of the declared suite):
# every review's user must exist among the staged users.
RELATIONSHIPS = [quality.Check("stg_reviews", "relationships", "user_id", ref_model="stg_users",
                               ref_column="user_id")]
register("dq_relationships", with_models(quality.suite_sql(RELATIONSHIPS)))(
    lambda m: quality.dq_report(_staging(m), RELATIONSHIPS))

register("dq_report", with_models(quality.suite_sql(SUITE)))(
    lambda m: quality.dq_report(_staging(m), SUITE))


# ------------------------------------------------------------------ ingest
def _order_key(c="review_id"):
    return F.substring(F.col(c), 2, 20).cast("long")


def _target(m):
    raw = m.raw_reviews
    return raw.where(_order_key() % 2 == 0)


def _batch(m):
    raw = m.raw_reviews
    first = raw.withColumn("arrival", F.lit(1))
    again = (raw.where(_order_key() % 3 == 0)
             .withColumn("stars", F.lit(0.0)).withColumn("arrival", F.lit(2)))
    return first.unionByName(again)


BATCH_CTES = """
ig_batch AS (
  SELECT *, 1 AS arrival FROM raw_reviews
  UNION ALL
  SELECT review_id, user_id, business_id, 0.0 AS stars, useful, funny, cool, review_date, loaded_at, 2 AS arrival
  FROM raw_reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 3 = 0
),
ig_target AS (
  SELECT * FROM raw_reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 2 = 0
)"""

register("insert_ignore", with_models("""
SELECT review_id, user_id, business_id, stars, useful, funny, cool, review_date, loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY arrival) AS rn FROM ig_batch) b
WHERE rn = 1 AND review_id NOT IN (SELECT review_id FROM ig_target)""", BATCH_CTES))(
    lambda m: ingest.insert_ignore(_batch(m), _target(m), "review_id", "arrival"))

register("ingest_report", with_models("""
SELECT 'inserted' AS outcome, CAST(ins AS BIGINT) AS rows FROM r
UNION ALL SELECT 'duplicate', CAST(good - ins AS BIGINT) FROM r
UNION ALL SELECT 'rejected', CAST(rej AS BIGINT) FROM r""", BATCH_CTES + """,
r AS (
  SELECT (SELECT COUNT(DISTINCT review_id) FROM ig_batch
          WHERE review_id IS NOT NULL AND review_date IS NOT NULL
            AND review_id NOT IN (SELECT review_id FROM ig_target)) AS ins,
         (SELECT COUNT(*) FROM ig_batch WHERE review_id IS NOT NULL AND review_date IS NOT NULL) AS good,
         (SELECT COUNT(*) FROM ig_batch WHERE review_id IS NULL OR review_date IS NULL) AS rej
)"""))(
    lambda m: ingest.ingest_report(_batch(m), _target(m), "review_id", required=["review_date"]))

register("bounded_ingest", with_models("SELECT * FROM raw_reviews"))(
    lambda m: ingest.bounded_ingest(m.raw_reviews, "review_id"))

# Every other user is in the target already: the copy adds all the others.
_SYNC_SQL = ", ".join(USER_SYNC_COLS)
register("sync_table", with_models(f"""
SELECT {_SYNC_SQL} FROM raw_users
WHERE user_id NOT IN (SELECT user_id FROM raw_users WHERE CAST(substr(user_id, 2) AS BIGINT) % 2 = 0)"""))(
    lambda m: ingest.sync_table(m.raw_users, m.raw_users.where(_order_key("user_id") % 2 == 0),
                                USER_SYNC_COLS, "user_id"))

register("quarantine_rejects", with_models("""
SELECT *, 'missing review_date' AS _reject_reason FROM raw_reviews
WHERE review_id IS NOT NULL AND user_id IS NOT NULL AND business_id IS NOT NULL AND stars IS NOT NULL
  AND review_date IS NULL"""))(
    lambda m: ingest.quarantine_split(
        m.raw_reviews, ["review_id", "user_id", "business_id", "stars", "review_date"])[1])


@register("land_with_audit", with_models("""
SELECT row_number() OVER (ORDER BY left(md5(product_url), 6), product_url) AS id,
       TIMESTAMP '2001-08-01 00:00:00' AS scraped_at, product_url, name
FROM raw_launches"""))
def _land(m):
    """Every launch with its id: by the first digits of the key's md5, then by key."""
    raw = m.raw_launches.drop("id", "scraped_at")
    landed = ingest.land_with_audit(raw, "product_url", "id", "scraped_at", load_ts="2001-08-01 00:00:00")
    return landed.select("id", "scraped_at", "product_url", "name")


@register("stream_ingest", with_models("SELECT * FROM raw_reviews WHERE review_date IS NOT NULL"))
def _stream_ingest(m):
    """Whole-table round trip through the streaming landing path: the raw reviews are
    written as JSON-line files (the input format) into a fresh folder under the shared
    checkpoint folder, landed by the availableNow stream in several triggers, and the
    landed table is returned."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources.fixtures import LOAD_TS
    from ..streaming.ingest_stream import stream_ingest

    spark = m.spark
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-ingest-{uuid.uuid4().hex}"
    raw = m.raw_reviews
    (raw.select("review_id", "user_id", "business_id", "stars",
                F.date_format("review_date", "yyyy-MM-dd").alias("date"), "useful", "funny", "cool")
     .write.json(f"{base}/in"))
    q = stream_ingest(spark, f"{base}/in", "reviews", f"{base}/target", f"{base}/quarantine",
                      f"{base}/checkpoint", bytes_per_trigger=256 << 20, load_ts=LOAD_TS)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/target")


PAGE_SIZE = 50


def _as_read(docs, schema):
    """What reading ``docs`` as stored JSON lines with ``schema`` gives, in the same plan."""
    from ..sources.readers import CORRUPT, _with_corrupt
    text = F.to_json(F.struct(*docs.columns))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return docs.select(F.from_json(text, _with_corrupt(schema), options).alias("d")).select("d.*")


def _node(spoiled=None, with_website=True):
    """A raw launch as the JSON text of an API post; ``spoiled`` names a field that gets an unusable value."""
    website = F.col("product_url") if with_website else F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.lit(None))
    topic = F.array(F.struct(F.struct(F.col("category").alias("name")).alias("node")))
    fields = {
        "name": F.col("name"), "tagline": F.col("tagline"), "votesCount": F.col("upvotes"),
        "topics": F.struct(F.when(F.col("category").isNull(), F.array()).otherwise(topic).alias("edges")),
        "thumbnail": F.struct(F.when(F.col("pricing_type") == "Free", F.lit("FreeImage")).otherwise(F.lit("Image"))
                              .alias("type")),
        "createdAt": F.concat(F.date_format("launch_date", "yyyy-MM-dd"), F.lit("T00:00:00Z")),
        "website": website.cast("string")}
    if spoiled:
        fields[spoiled] = F.lit("soon")
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _page_texts(m, node=None):
    """Every raw launch as a post of an API page, in pages of 50 (a bounded group per page): (page_no, value)."""
    raw = m.raw_launches
    posts = raw.select((F.floor((F.col("id") - 1) / PAGE_SIZE) + 1).cast("int").alias("page_no"), "id",
                       F.concat(F.lit('{"node":'), _node() if node is None else node, F.lit("}")).alias("edge"))
    pages = posts.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("id", "edge")))["edge"].alias("edges"))
    more = (F.col("page_no") < posts.select(F.max("page_no")).scalar()).cast("string")
    return pages.select("page_no", F.concat(
        F.lit('{"page_no":'), "page_no", F.lit(',"data":{"posts":{"pageInfo":{"hasNextPage":'), more,
        F.lit(',"endCursor":"'), "page_no", F.lit('"},"edges":['), F.array_join("edges", ","), F.lit("]}}}")).alias("value"))


LAUNCH_SQL = "name, tagline, upvotes, category, pricing_type, launch_date, product_url"


@register("launch_pages", with_models(f"SELECT {LAUNCH_SQL} FROM raw_launches"))
def _launch_pages(m):
    """The whole table through page files: written as pages below the shared folder, read back with the
    page-chain rules."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources import readers

    folder = f"{checkpoint_dir(m.spark).rstrip('/')}/launch-pages-{uuid.uuid4().hex}"
    _page_texts(m).select("value").write.text(folder)
    good, _ = readers.parse_launch_pages(readers.read_launch_pages(m.spark, folder, multi_line=False))
    return good.drop("page_no", readers.ARRIVAL)


@register("launch_pages_fallback_url", with_models(
    f"SELECT name, '{LAUNCH_URL_PREFIX}' || name AS product_url FROM raw_launches"))
def _launch_pages_fallback(m):
    """Launches whose website is empty or missing get a URL from the prefix and their name."""
    from ..sources import readers

    good, _ = readers.parse_launch_pages(readers.launch_pages(_page_texts(m, _node(with_website=False))))
    return good.select("name", "product_url")


# A post with an unusable value on every tenth page, the field by the page; the other posts are as ever.
SPOILED = {0: "votesCount", 1: "createdAt", 2: "topics"}


def _spoiled_posts(m):
    from ..sources import readers
    page = F.floor((F.col("id") - 1) / PAGE_SIZE) + 1
    hit = (page % 10 == 1) & ((F.col("id") - 1) % PAGE_SIZE == page % 7)
    node = F.coalesce(*[F.when(hit & (F.floor(page / 10) % len(SPOILED) == i), _node(f)) for i, f in SPOILED.items()], _node())
    return readers.parse_launch_pages(readers.launch_pages(_page_texts(m, node)))


SPOILED_SQL = f"""
paged AS (SELECT *, (id - 1) // {PAGE_SIZE} + 1 AS page_no, (id - 1) % {PAGE_SIZE} AS place FROM raw_launches),
spoiled AS (SELECT * FROM paged WHERE page_no % 10 = 1 AND place = page_no % 7)"""

register("page_posts", with_models(
    f"SELECT {LAUNCH_SQL} FROM paged WHERE id NOT IN (SELECT id FROM spoiled)", SPOILED_SQL))(
    lambda m: _spoiled_posts(m)[0].drop("page_no", "_arrival"))

register("page_posts_rejected", with_models("""
SELECT CAST(page_no AS INTEGER) AS page_no, name, product_url, 'unparsable value' AS _reject_reason,
       CASE WHEN page_no // 10 % 3 <> 0 THEN upvotes END AS upvotes,
       CASE WHEN page_no // 10 % 3 <> 1 THEN launch_date END AS launch_date,
       CASE WHEN page_no // 10 % 3 <> 2 THEN category END AS category FROM spoiled""", SPOILED_SQL))(
    lambda m: _spoiled_posts(m)[1].select("page_no", "name", "product_url", "_reject_reason", "upvotes", "launch_date",
                                          "category"))


def _bad_chain(m):
    """The pages with one missing and, before it, one that is unreadable, by the number of pages."""
    from ..sources import readers
    texts = _page_texts(m)
    n = m.raw_launches.select(F.max(F.floor((F.col("id") - 1) / PAGE_SIZE) + 1)).scalar()
    broken = F.col("page_no") == F.floor(n * 2 / 3)
    texts = texts.where(F.col("page_no") != F.floor(n * 3 / 4))
    return readers.launch_pages(texts.select(F.when(broken, F.lit("{broken")).otherwise(F.col("value")).alias("value")))


_LAST = f"CAST(floor(ceil(max(id) OVER () / {PAGE_SIZE}.0) * 2 / 3) AS BIGINT) - 1"

register("valid_pages", with_models(f"""
SELECT name, product_url FROM (SELECT *, {_LAST} AS last_page FROM raw_launches) p
WHERE (id - 1) // {PAGE_SIZE} + 1 <= last_page"""))(
    lambda m: _good_of_bad_chain(m))


def _good_of_bad_chain(m):
    """The chain ends before the unreadable page; the pages behind it are not used."""
    from ..sources import readers
    good, _ = readers.parse_launch_pages(_bad_chain(m))
    return good.select("name", "product_url")


register("rejected_pages", with_models(
    "SELECT '{broken' AS _corrupt_record, 'unreadable page' AS _reject_reason FROM raw_launches LIMIT 1"))(
    lambda m: _rejected_of_bad_chain(m))


def _rejected_of_bad_chain(m):
    from ..sources import readers
    _, rejected = readers.parse_launch_pages(_bad_chain(m))
    return rejected.select(readers.CORRUPT, "_reject_reason")


@register("read_users_json", with_models("""
SELECT user_id, name, review_count, fans, average_stars,
       COALESCE(yelping_since, DATE '2004-01-01') AS yelping_since
FROM raw_users"""))
def _read_users_json(m):
    """The whole table through the user JSON-lines reader: missing join dates get the default
    date, whole numbers written with a fraction are read, every other field comes back as landed."""
    from .. import schemas as S
    from ..sources import readers

    lines = m.raw_users.select(
        "user_id", "name", F.col("review_count").cast("double").alias("review_count"),
        F.date_format("yelping_since", "yyyy-MM-dd").alias("yelping_since"), "fans", "average_stars")
    good, _ = readers.parse_users(_as_read(lines, S.USER_JSON))
    return good


register("first_arrival", with_models("""
SELECT review_id, CAST(9 AS DOUBLE) AS stars, loaded_at FROM raw_reviews"""))(lambda m: _first_arrival(m))


def _first_arrival(m):
    """Every review arrives twice, first with the larger values: the first one stays."""
    raw = m.raw_reviews.select("review_id", F.lit(9.0).alias("stars"), "loaded_at")
    early = raw.withColumn("_arrival", F.struct(F.lit(1).alias("file"), F.lit(7).alias("row")))
    late = raw.withColumn("stars", F.lit(1.0)).withColumn(
        "_arrival", F.struct(F.lit(2).alias("file"), F.lit(0).alias("row")))
    return ingest.insert_ignore(late.unionByName(early), raw.limit(0), "review_id", "_arrival")


# The copies as the command makes them, over the whole of the other two tables into an empty target.
def _sync_all(name):
    columns, key = SYNCED[name]
    register(f"sync_{name[4:]}", with_models(f"SELECT {', '.join(columns)} FROM {name}"))(
        lambda m: ingest.sync_table(getattr(m, name), getattr(m, name).limit(0), columns, key))


for _name in ("raw_reviews", "raw_launches"):
    _sync_all(_name)


# ------------------------------------------------- limits, files and names, over the whole given tables
# The limit is the feature here: the first rows by key.
LIMIT = 1000
register("limited_ingest", with_models(f"SELECT * FROM raw_reviews ORDER BY review_id LIMIT {LIMIT}"))(
    lambda m: ingest.bounded_ingest(m.raw_reviews, "review_id", LIMIT))


def _fresh(m, name):
    import uuid

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(m.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("read_reviews_files", with_models("""
SELECT review_id, user_id, business_id, stars, useful, funny, cool, review_date FROM raw_reviews
WHERE review_date IS NOT NULL"""))
def _read_reviews_files(m):
    """The whole table as JSON-line files below the shared folder, through the file scan of the reader."""
    from ..sources import readers
    folder = _fresh(m, "review-files")
    m.raw_reviews.select("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool",
                         F.date_format("review_date", "yyyy-MM-dd").alias("date")).write.json(folder)
    return readers.read_reviews(m.spark, folder)[0].drop(readers.ARRIVAL)


@register("read_users_files", with_models("""
SELECT user_id, name, review_count, fans, average_stars, COALESCE(yelping_since, DATE '2004-01-01') AS yelping_since
FROM raw_users"""))
def _read_users_files(m):
    from ..sources import readers
    folder = _fresh(m, "user-files")
    m.raw_users.select("user_id", "name", "review_count", "fans", "average_stars",
                       F.date_format("yelping_since", "yyyy-MM-dd").alias("yelping_since")).write.json(folder)
    return readers.read_users(m.spark, folder)[0].drop(readers.ARRIVAL)


@register("raw_by_name", with_models("SELECT * FROM raw_launches"))
def _raw_by_name(m):
    """A raw table appended under its name and read back by it."""
    from ..sources import registry
    root = _fresh(m, "by-name")
    registry.append_raw(m.raw_launches, root, "raw_launches")
    return registry.read_raw(m.spark, root, "raw_launches")


@register("display_numbers", with_models("""
SELECT id, format('{:,}', id * 1000) AS whole, format('{:,}', id * 1000) || '.5' AS tenth FROM raw_launches"""))
def _display_numbers(m):
    from ..functions.columns import display_number
    return m.raw_launches.select("id", display_number(F.col("id") * 1000).alias("whole"),
                                 display_number(F.col("id") * 1000 + 0.5, 1).alias("tenth"))


@register("land_indexed", with_models("""
SELECT review_id, user_id, business_id, stars, useful, funny, cool, review_date, loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY arrival) AS rn FROM ig_batch) b
WHERE rn = 1 AND review_id NOT IN (SELECT review_id FROM ig_target)""", BATCH_CTES))
def _land_indexed(m):
    """What ``insert_ignore`` gives, against the key index of a stored target."""
    from ..sources import registry
    from ..sources.keyindex import KeyIndex
    root = _fresh(m, "indexed")
    registry.append_raw(_target(m), root, "raw_reviews")
    index = KeyIndex(m.spark, registry.raw_path(root, "raw_reviews"), "review_id").refresh()
    return ingest.insert_ignore(_batch(m), None, "review_id", "arrival", index)
