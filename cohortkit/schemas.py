"""Explicit schemas.  No reader in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- raw layer
RAW_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("business_id", T.StringType(), True),
    T.StructField("stars", T.DoubleType(), True),
    T.StructField("useful", T.IntegerType(), True),
    T.StructField("funny", T.IntegerType(), True),
    T.StructField("cool", T.IntegerType(), True),
    T.StructField("review_date", T.DateType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
])

RAW_USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("review_count", T.IntegerType(), True),
    T.StructField("fans", T.IntegerType(), True),
    T.StructField("average_stars", T.DoubleType(), True),
    T.StructField("yelping_since", T.DateType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
])

RAW_LAUNCHES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("tagline", T.StringType(), True),
    T.StructField("upvotes", T.IntegerType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("pricing_type", T.StringType(), True),
    T.StructField("launch_date", T.DateType(), True),
    T.StructField("product_url", T.StringType(), False),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
])

# ------------------------------------------------------------- input files
# One review per JSON line.  Everything is read as text or number first; dates and
# casts happen in the reader so a bad value becomes a quarantined row, not an error.
REVIEW_JSON = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("useful", T.StringType()),
    T.StructField("funny", T.StringType()),
    T.StructField("cool", T.StringType()),
])

USER_JSON = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("review_count", T.StringType()),
    T.StructField("yelping_since", T.StringType()),
    T.StructField("fans", T.StringType()),
    T.StructField("average_stars", T.StringType()),
])

# ------------------------------------------------------- staging column order
# The declared order of the staging review columns.
STG_REVIEWS_COLUMNS = [
    "review_id", "user_id", "business_id", "stars", "useful", "funny", "cool",
    "engagement_score", "review_date", "review_month", "review_year", "sentiment", "loaded_at",
]
