"""Adapter views: present the driver's generic test tables as the three raw tables.

``orders`` becomes review events, ``customer`` becomes users, ``part`` becomes
product launches.  The rules are fixed by FIXTURES.md; the DuckDB form of the same
views (``ADAPTER_SQL``) is used by the oracle queries, so both engines start from
identical rows.

The adapter is written the way the raw layer would be landed: per-customer spans are
aggregated (map-side partial aggregation, skew-safe) and joined back; AQE picks a
broadcast or shuffle join from the measured size of the span table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (FIXTURES.md §A).
# Load timestamp as text: a string cast to timestamp_ntz does not depend on any time zone.
LOAD_TS = "2001-08-01 00:00:00"
NULL_REVIEW_DATE_MOD, NULL_REVIEW_DATE_REM = 200, 199
ZERO_SPAN_MOD = 13
ZERO_SPAN_DIVISOR = 1_000_000
SPAN_DIVISOR_MOD = 20
BUSINESS_MOD = 97
NULL_JOIN_MOD, NULL_JOIN_REM = 50, 49
EARLY_JOIN_MOD, EARLY_JOIN_DAYS = 4, 40
LAUNCH_BASE_DATE = dt.date(2000, 6, 1)
LAUNCH_URL_BASE = "https://example.test/p/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.to_date("o_orderdate").alias("od"))


def _span_divisor(ck):
    return F.when(ck % ZERO_SPAN_MOD == 0, F.lit(ZERO_SPAN_DIVISOR)).otherwise(1 + ck % SPAN_DIVISOR_MOD)


def _squeezed(ck, od):
    """Review date of an order dated ``od``: squeezed towards the customer's first (even
    customers) or last (odd customers) order date.  Non-decreasing in ``od``."""
    dv = _span_divisor(ck)
    return (F.when(ck % 2 == 0, F.date_add("f", F.floor(F.datediff(od, "f") / dv).cast("int")))
            .otherwise(F.date_sub("l", F.floor(F.datediff("l", od) / dv).cast("int"))))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    span = (orders.groupBy("o_custkey")
            .agg(F.min("od").alias("f"), F.max("od").alias("l")))
    dated = orders.join(span, "o_custkey")
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    price = F.floor("o_totalprice").cast("int")
    review_date = (
        F.when(ok % NULL_REVIEW_DATE_MOD == NULL_REVIEW_DATE_REM, F.lit(None).cast("date"))
        .otherwise(_squeezed(ck, F.col("od"))))
    return dated.select(
        F.concat(F.lit("r"), ok.cast("string")).alias("review_id"),
        F.concat(F.lit("u"), ck.cast("string")).alias("user_id"),
        F.concat(F.lit("b"), (ok % BUSINESS_MOD).cast("string")).alias("business_id"),
        (6 - F.substring("o_orderpriority", 1, 1).cast("int")).cast("double").alias("stars"),
        (price % 7).alias("useful"),
        (price % 3).alias("funny"),
        (price % 5).alias("cool"),
        review_date.alias("review_date"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("loaded_at"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A user's first review date is the squeezed date of their earliest order that has a
    # review date: the squeeze is non-decreasing in the order date, so one aggregate over
    # orders gives it (no second pass over the review rows).
    ok = F.col("o_orderkey")
    valid = ok % NULL_REVIEW_DATE_MOD != NULL_REVIEW_DATE_REM
    firsts = (_orders(spark, sf_dir).groupBy("o_custkey")
              .agg(F.min("od").alias("f"), F.max("od").alias("l"),
                   F.min(F.when(valid, F.col("od"))).alias("first_od")))
    first = firsts.select(F.col("o_custkey").alias("c_custkey"),
                          _squeezed(F.col("o_custkey"), F.col("first_od")).alias("first_review"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    ck = F.col("c_custkey")
    joined = cust.join(first, "c_custkey", "left")
    yelping = (F.when(ck % NULL_JOIN_MOD == NULL_JOIN_REM, F.lit(None).cast("date"))
               .when(ck % EARLY_JOIN_MOD == 0, F.date_sub("first_review", EARLY_JOIN_DAYS))
               .otherwise(F.col("first_review")))
    return joined.select(
        F.concat(F.lit("u"), ck.cast("string")).alias("user_id"),
        F.col("c_name").alias("name"),
        (F.floor(F.abs("c_acctbal")).cast("int") % 150).alias("review_count"),
        ((ck * 7) % 130).cast("int").alias("fans"),
        (1 + (ck % 41) / F.lit(10.0)).cast("double").alias("average_stars"),
        yelping.alias("yelping_since"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("loaded_at"),
    )


def raw_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return part.select(
        (pk + 1).alias("id"),
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")).alias("tagline"),
        F.when(pk % 101 == 0, F.lit(None).cast("int"))
         .otherwise(((pk * 37) % 1200).cast("int")).alias("upvotes"),
        F.when(pk % 23 == 0, F.lit(None).cast("string"))
         .when(pk % 7 == 0, F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")))
         .otherwise(F.col("p_type")).alias("category"),
        F.when(pk % 2 == 0, F.lit("Free")).otherwise(F.lit("Unknown")).alias("pricing_type"),
        F.date_add(F.lit(LAUNCH_BASE_DATE), (pk % 400).cast("int")).alias("launch_date"),
        F.concat(F.lit(LAUNCH_URL_BASE), pk.cast("string")).alias("product_url"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("scraped_at"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "raw_reviews": raw_reviews(spark, sf_dir),
        "raw_users": raw_users(spark, sf_dir),
        "raw_launches": raw_launches(spark, sf_dir),
    }


# The same views for DuckDB (oracle side).  FIXTURES.md §A with the DuckDB tokens.
ADAPTER_SQL = """
fx_span AS (
  SELECT o_custkey AS k, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l
  FROM orders GROUP BY o_custkey
),
fx_dated AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderpriority, s.f, s.l,
         CAST(o.o_orderdate AS DATE) AS od,
         CASE WHEN o.o_custkey % 13 = 0 THEN 1000000 ELSE 1 + o.o_custkey % 20 END AS dv
  FROM orders o JOIN fx_span s ON o.o_custkey = s.k
),
raw_reviews AS (
  SELECT 'r' || CAST(o_orderkey AS VARCHAR(20)) AS review_id,
         'u' || CAST(o_custkey AS VARCHAR(20)) AS user_id,
         'b' || CAST(o_orderkey % 97 AS VARCHAR(20)) AS business_id,
         CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INT) AS DOUBLE) AS stars,
         CAST(floor(o_totalprice) AS INT) % 7 AS useful,
         CAST(floor(o_totalprice) AS INT) % 3 AS funny,
         CAST(floor(o_totalprice) AS INT) % 5 AS cool,
         CASE WHEN o_orderkey % 200 = 199 THEN NULL
              WHEN o_custkey % 2 = 0 THEN f + CAST(floor(date_diff('day', f, od) / dv) AS INT)
              ELSE l - CAST(floor(date_diff('day', od, l) / dv) AS INT) END AS review_date,
         timestamp '2001-08-01 00:00:00' AS loaded_at
  FROM fx_dated
),
fx_first AS (
  SELECT user_id, min(review_date) AS f FROM raw_reviews GROUP BY user_id
),
raw_users AS (
  SELECT 'u' || CAST(c.c_custkey AS VARCHAR(20)) AS user_id,
         c.c_name AS name,
         CAST(floor(abs(c.c_acctbal)) AS INT) % 150 AS review_count,
         CAST((c.c_custkey * 7) % 130 AS INT) AS fans,
         CAST(1 + (c.c_custkey % 41) / 10.0 AS DOUBLE) AS average_stars,
         CASE WHEN c.c_custkey % 50 = 49 THEN NULL
              WHEN c.c_custkey % 4 = 0 THEN f.f - 40
              ELSE f.f END AS yelping_since,
         timestamp '2001-08-01 00:00:00' AS loaded_at
  FROM customer c LEFT JOIN fx_first f ON f.user_id = 'u' || CAST(c.c_custkey AS VARCHAR(20))
),
raw_launches AS (
  SELECT p_partkey + 1 AS id,
         '  ' || upper(p_name) || ' ' AS name,
         ' ' || p_brand || ' ' AS tagline,
         CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 1200 AS INT) END AS upvotes,
         CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN ' ' || p_type || ' ' ELSE p_type END AS category,
         CASE WHEN p_partkey % 2 = 0 THEN 'Free' ELSE 'Unknown' END AS pricing_type,
         DATE '2000-06-01' + CAST(p_partkey % 400 AS INT) AS launch_date,
         'https://example.test/p/' || CAST(p_partkey AS VARCHAR(20)) AS product_url,
         timestamp '2001-08-01 00:00:00' AS scraped_at
  FROM part
)
"""
