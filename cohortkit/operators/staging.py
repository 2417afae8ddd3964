"""Staging views: typed, cleaned projections of the raw layer.

All three are narrow (map-only) transformations: no shuffle, filters are pushed to
the scan, and only referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C


def stg_launches(raw_launches: DataFrame) -> DataFrame:
    category = F.col("category")
    return raw_launches.select(
        "id",
        "product_url",
        F.trim(F.lower("name")).alias("name"),
        F.trim("tagline").alias("tagline"),
        "upvotes",
        F.when(category.isNull(), F.lit(P.UNCATEGORIZED)).otherwise(F.trim(category)).alias("category"),
        C.traction_tier("upvotes").alias("traction_tier"),
        "launch_date",
        "scraped_at",
    )


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    return (raw_reviews
            .where(F.col("review_date").isNotNull())
            .select(
                "review_id", "user_id", "business_id", "stars", "useful", "funny", "cool",
                (F.col("stars") + F.col("useful") + F.col("funny") + F.col("cool")).alias("engagement_score"),
                "review_date",
                C.month_start("review_date").alias("review_month"),
                C.year_start("review_date").alias("review_year"),
                C.sentiment("stars").alias("sentiment"),
                "loaded_at",
            ))


def stg_users(raw_users: DataFrame) -> DataFrame:
    return (raw_users
            .where(F.col("yelping_since").isNotNull())
            .select(
                "user_id", "name", "review_count", "fans", "average_stars", "yelping_since",
                C.month_start("yelping_since").alias("cohort_month"),
                C.year_start("yelping_since").alias("cohort_year"),
                C.user_segment("review_count").alias("user_segment"),
                C.influence_tier("fans").alias("influence_tier"),
                "loaded_at",
            ))
