"""Readers for the raw inputs: newline-JSON reviews and users, stored launch API pages.

Every reader applies an explicit schema (no inference) and returns ``(good, rejected)``:
values are read as text (pages as semi-structured values) and converted with ``try_*``
functions, so one bad value quarantines its row instead of failing the load.  File reads split across tasks like
any other Spark scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions.columns import iso_date_prefix
from .ingest import quarantine_split

CORRUPT = "_corrupt_record"


def _with_corrupt(schema):
    from pyspark.sql import types as T
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


# When a row arrived: files by modification time and path, rows by their place in the file.
ARRIVAL = "_arrival"


def with_arrival(rows: DataFrame) -> DataFrame:
    """Add ``_arrival`` to rows of a file scan: (file time, file, start of the split, place in it).

    Splits are packed into tasks by size, so the task number says nothing; within one split the
    increasing id follows the lines.
    """
    return rows.select("*", F.struct(
        F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias(ARRIVAL))


def _json(spark: SparkSession, path, schema) -> DataFrame:
    return with_arrival(spark.read.schema(_with_corrupt(schema))
                        .option("mode", "PERMISSIVE")
                        .option("columnNameOfCorruptRecord", CORRUPT)
                        .json(path))


def _carried(raw: DataFrame) -> list[str]:
    return [ARRIVAL] if ARRIVAL in raw.columns else []


def _num(raw: str, kind: str, default=None) -> tuple[Column, Column]:
    """(converted value, is-bad flag): missing -> default, present but unparsable -> bad.

    A whole number may be written with a fraction (3.0): it is cut, as a number conversion does.
    """
    value = F.expr(f"try_cast({raw} AS {kind})")
    if kind == "int":
        value = F.coalesce(value, F.expr(f"try_cast(try_cast({raw} AS double) AS int)"))
    bad = F.col(raw).isNotNull() & value.isNull()
    if default is not None:
        value = F.coalesce(value, F.lit(default).cast(kind))
    return value, bad


def parse_reviews(raw: DataFrame, keep=None) -> tuple[DataFrame, DataFrame]:
    stars, bad_stars = _num("stars", "double")
    counts = {c: _num(c, "int", 0) for c in ("useful", "funny", "cool")}
    review_date = iso_date_prefix("date")
    bad = (F.col(CORRUPT).isNotNull() | bad_stars
           | (F.col("date").isNotNull() & review_date.isNull())
           | counts["useful"][1] | counts["funny"][1] | counts["cool"][1])
    typed = raw.select(
        "review_id", "user_id", "business_id",
        stars.alias("stars"),
        *[counts[c][0].alias(c) for c in ("useful", "funny", "cool")],
        review_date.alias("review_date"),
        bad.alias("_bad"), CORRUPT, *_carried(raw))
    good, rejected = quarantine_split(typed, ["review_id", "user_id", "business_id", "stars", "review_date"],
                                      corrupt=F.col("_bad"), keep=keep)
    return good.drop("_bad", CORRUPT), rejected.drop("_bad", ARRIVAL)


def parse_users(raw: DataFrame, keep=None) -> tuple[DataFrame, DataFrame]:
    review_count, bad_rc = _num("review_count", "int", 0)
    fans, bad_fans = _num("fans", "int", 0)
    avg, bad_avg = _num("average_stars", "double", 0.0)
    since = F.coalesce(iso_date_prefix("yelping_since"),
                       F.when(F.col("yelping_since").isNull(), F.lit(P.DEFAULT_YELPING_SINCE)))
    bad = (F.col(CORRUPT).isNotNull() | bad_rc | bad_fans | bad_avg
           | (F.col("yelping_since").isNotNull() & iso_date_prefix("yelping_since").isNull()))
    typed = raw.select(
        "user_id", "name", review_count.alias("review_count"), fans.alias("fans"),
        avg.alias("average_stars"), since.cast("date").alias("yelping_since"),
        bad.alias("_bad"), CORRUPT, *_carried(raw))
    good, rejected = quarantine_split(typed, ["user_id"], corrupt=F.col("_bad"), keep=keep)
    return good.drop("_bad", CORRUPT), rejected.drop("_bad", ARRIVAL)


def read_reviews(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Review JSON lines -> (typed rows, quarantined rows)."""
    return parse_reviews(_json(spark, path, S.REVIEW_JSON))


def read_users(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """User JSON lines -> (typed rows with defaults for missing fields, quarantined rows)."""
    return parse_users(_json(spark, path, S.USER_JSON))


# A launch page is kept as a semi-structured value; each post in it is typed by itself, so what is wrong with one
# post rejects that post and nothing else, whichever columns a branch of the plan reads.
PAGE = "page"


def launch_pages(texts: DataFrame) -> DataFrame:
    """Stored API pages as (page_no, page, ``_corrupt_record``) from their JSON texts in ``value``: one page, or
    an array of pages, per text.

    A text that is no JSON, or a page without a number or, unless it reports errors, without a list of posts is
    unreadable: its value is null and its text is kept in the corrupt-record column.
    """
    parsed = texts.where(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    listed = parsed.select("value", F.explode_outer(F.coalesce(
        F.try_variant_get("v", "$", "array<variant>"), F.array("v"))).alias(PAGE))
    typed = listed.select(
        F.try_variant_get(PAGE, "$.page_no", "int").alias("page_no"), PAGE, "value",
        F.try_variant_get(PAGE, "$.errors", "variant").isNotNull().alias("failed"),
        F.try_variant_get(PAGE, "$.data.posts.edges", "array<variant>").isNotNull().alias("listed"))
    sound = F.col("page_no").isNotNull() & (F.col("failed") | F.col("listed"))
    return typed.select("page_no", F.when(sound, F.col(PAGE)).alias(PAGE), F.when(~sound, F.coalesce(
        F.to_json(PAGE), F.col("value"))).alias(CORRUPT))


def read_launch_pages(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Stored API pages: one JSON document per file (``multi_line``), or one page per line."""
    return launch_pages(spark.read.text(path, wholetext=multi_line))


def _readable(pages: DataFrame) -> DataFrame:
    return pages.where(F.col(CORRUPT).isNull())


def valid_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages a paginated fetch would have used: from page 1 on without a gap (an unreadable
    page is one), stop before the first page carrying errors, stop after the first page
    without a next page; never beyond ``max_pages`` if that is given.

    The cut-off is one scalar aggregate over the pages, evaluated as a scalar subquery.
    """
    pages = _readable(pages)
    has_err = F.try_variant_get(PAGE, "$.errors", "variant").isNotNull()
    last = F.coalesce(~F.try_variant_get(PAGE, "$.data.posts.pageInfo.hasNextPage", "boolean"), F.lit(True))
    numbers = pages.select("page_no").distinct()
    # The chain holds up to the first page whose successor is missing, if it begins at 1.
    ahead = numbers.select((F.col("page_no") - 1).alias("page_no"))
    held = numbers.where("page_no >= 1").join(ahead, "page_no", "left_anti").select(F.min("page_no")).scalar()
    begun = pages.select(F.min(F.when(F.col("page_no") == 1, F.lit(1)))).scalar()
    bound = pages.select(F.least(
        F.min(F.when(has_err, F.col("page_no"))) - 1,
        F.min(F.when(~has_err & last, F.col("page_no"))),
        F.lit(max_pages).cast("int"))).scalar()
    return pages.where((F.col("page_no") >= 1) & begun.isNotNull() & (F.col("page_no") <= held)
                       & F.coalesce(F.col("page_no") <= bound, F.lit(True)))


def _field(value: str, path: str) -> tuple[Column, Column]:
    """A field of a semi-structured value (null if it is missing or JSON null) and its kind of value."""
    raw = F.try_variant_get(value, path, "variant")
    there = F.when(~F.is_variant_null(raw), raw)
    return there, F.regexp_extract(F.schema_of_variant(there), "^[A-Z]+", 0)


def _scalar(value: str, path: str) -> tuple[Column, Column]:
    """(text of a field, is it there but an object or a list)."""
    there, kind = _field(value, path)
    return F.when(~kind.isin("OBJECT", "ARRAY"), F.try_variant_get(value, path, "string")), F.coalesce(
        kind.isin("OBJECT", "ARRAY"), F.lit(False))


def _text(value: str, path: str) -> tuple[Column, Column]:
    """(text of a field, is it there but no text)."""
    there, kind = _field(value, path)
    return F.when(kind == "STRING", F.try_variant_get(value, path, "string")), F.coalesce(kind != "STRING", F.lit(False))


def _whole(value: str, path: str) -> tuple[Column, Column]:
    """(whole number of a field, is it there but none). Digits in a text count, a fraction is rounded as a
    number conversion in the landing database does, true and false are no numbers."""
    there, kind = _field(value, path)
    text = F.try_variant_get(value, path, "string").try_cast("int")
    number = F.round(F.try_variant_get(value, path, "double")).try_cast("int")
    whole = F.when(kind == "STRING", text).when(~kind.isin("BOOLEAN", "OBJECT", "ARRAY"), number)
    return whole, there.isNotNull() & whole.isNull()


def _is(value: str, path: str, kind: str) -> Column:
    """Is the field missing, null or of this kind?"""
    return F.coalesce(_field(value, path)[1] == kind, F.lit(True))


def parse_launch_pages(pages: DataFrame, fallback_prefix: str = P.LAUNCH_URL_PREFIX,
                       max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One launch row per post of the valid pages -> (good, rejected).

    Good rows carry ``_arrival`` (page number, place in the page).  Rejected, with their text, are entries
    without a post, posts without a name or with a value that is there but unusable, and unreadable pages.
    Every post of a valid page is in one of the two.
    """
    posts = (valid_pages(pages, max_pages)
             .select("page_no", F.posexplode(F.try_variant_get(PAGE, "$.data.posts.edges", "array<variant>"))
                     .alias("_pos", "edge"))
             .select("page_no", "_pos", "edge", F.try_variant_get("edge", "$.node", "variant").alias("node")))
    name, bad_name = _scalar("node", "$.name")
    tagline, bad_tagline = _scalar("node", "$.tagline")
    votes, bad_votes = _whole("node", "$.votesCount")
    created, bad_created = _text("node", "$.createdAt")
    website, bad_website = _scalar("node", "$.website")
    category, bad_category = _scalar("node", "$.topics.edges[0].node.name")
    thumb, bad_thumb = _text("node", "$.thumbnail.type")
    shapes = [("node", "$", "OBJECT"), ("node", "$.topics", "OBJECT"), ("node", "$.topics.edges", "ARRAY"),
              ("node", "$.topics.edges[0]", "OBJECT"), ("node", "$.topics.edges[0].node", "OBJECT"),
              ("node", "$.thumbnail", "OBJECT")]
    bad = bad_name | bad_tagline | bad_votes | bad_created | bad_website | bad_category | bad_thumb
    for value, path, kind in shapes:
        bad = bad | ~_is(value, path, kind)
    typed = posts.select(
        name.alias("name"), tagline.alias("tagline"), votes.alias("upvotes"), category.alias("category"),
        F.when(F.lower(F.coalesce(thumb, F.lit(""))).contains("free"), F.lit("Free")).otherwise(F.lit("Unknown"))
        .alias("pricing_type"),
        created.alias("created"), website.alias("website"), "page_no", F.to_json("edge").alias(CORRUPT),
        bad.alias("_bad"), F.struct("page_no", "_pos").alias(ARRIVAL))
    day = iso_date_prefix("created")
    url = F.when(F.col("website").isNull() | (F.col("website") == ""),
                 F.concat(F.lit(fallback_prefix), F.col("name"))).otherwise(F.col("website"))
    rows = typed.select(
        "name", "tagline", "upvotes", "category", "pricing_type", day.alias("launch_date"), url.alias("product_url"),
        "page_no", CORRUPT, (F.col("_bad") | (F.col("created").isNotNull() & day.isNull())).alias("_bad"), ARRIVAL)
    good, rejected = quarantine_split(rows, ["name", "product_url"], corrupt=F.col("_bad"))
    rejected = rejected.drop("_bad", ARRIVAL)
    unread = pages.where(F.col(CORRUPT).isNotNull()).select(*[
        F.col(c) if c in (CORRUPT, "page_no") else F.lit("unreadable page").alias(c) if c == "_reject_reason"
        else F.lit(None).cast(kind).alias(c) for c, kind in rejected.dtypes])
    return good.drop("_bad", CORRUPT), rejected.unionByName(unread)
