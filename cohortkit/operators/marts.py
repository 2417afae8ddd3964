"""Mart tables: launch and category performance, cohort retention, survival inputs.

Shuffle plan at scale (reviews are the big table, users the second):

* ``cohort_activity`` / ``retention_cohorts`` first collapse reviews to bitmaps of the
  active months, one 64-bit word per user and run of 64 calendar months, with a partial
  (map-side) aggregate of fixed width inside code generation.  A user with millions of
  reviews ships at most a few words per map task, and any date has its word.  After the
  join with users the bits are counted per (cohort, month), again before the shuffle.
* ``survival_inputs`` aggregates reviews per user before the join (aggregate-then-join),
  again with partial aggregation, so skewed users cost nothing extra.
* Everything after the per-user stage is keyed by (cohort, month) and tiny.

A join-then-distinct plan cannot split a user that holds a third of all reviews: its distinct
step relies on the join's user partitioning, so one task would take a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C


# --------------------------------------------------------------- launches
def launch_scores(stg_launches: DataFrame, as_of) -> DataFrame:
    """Launch performance with ``success_score`` kept as an exact DECIMAL(7,2)."""
    upvotes = F.col("upvotes")
    score = F.round(F.least(upvotes.cast("decimal(12,0)") / P.SUCCESS_SCORE_DIVISOR,
                            F.lit(P.SUCCESS_SCORE_CAP).cast("decimal(12,0)")), 2).cast("decimal(7,2)")
    return stg_launches.select(
        "id", "name", "product_url", "category", "launch_date", "traction_tier", "upvotes",
        C.days_between(C.as_date(as_of), "launch_date").alias("days_since_launch"),
        score.alias("success_score"),
        F.coalesce(upvotes >= P.TOP_PERFORMER_UPVOTES, F.lit(False)).alias("is_top_performer"),
        F.date_format("launch_date", "yyyy-MM").alias("launch_month"),
    )


def launch_performance(stg_launches: DataFrame, as_of) -> DataFrame:
    return launch_scores(stg_launches, as_of).withColumn(
        "success_score", F.col("success_score").cast("double"))


def category_performance(launch_perf: DataFrame) -> DataFrame:
    """Per-category summary, best average success score first."""
    summary = launch_perf.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_launches"),
        C.round_avg("upvotes", 0).alias("avg_upvotes"),
        F.max("upvotes").alias("max_upvotes"),
        F.sum(F.when(F.col("is_top_performer"), 1).otherwise(0)).cast("long").alias("top_performer_count"),
        C.round_avg("success_score", 2).alias("avg_success_score"),
        C.round_avg("days_since_launch", 0).alias("avg_days_since_launch"),
    )
    return (summary
            .withColumn("top_performer_pct", C.exact_pct("top_performer_count", "total_launches", 0))
            .orderBy(F.col("avg_success_score").desc_nulls_first(), F.col("category").asc_nulls_last()))


# -------------------------------------------------------------- retention
def user_activity(stg_users: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """One row per (user, review): the user's cohort, the review month and the whole
    months between them.  Users without reviews and reviews without a user drop out."""
    users = stg_users.select("user_id", "cohort_month")
    reviews = stg_reviews.select("user_id", F.col("review_month").alias("activity_month"))
    # Reviews on the streamed (left) side of the sort-merge join: per key only the single
    # user row is buffered, so a user with millions of reviews is streamed, not buffered.
    return (reviews.join(users, "user_id")
            .select("user_id", "cohort_month", "activity_month",
                    C.months_between_starts("activity_month", "cohort_month").alias("months_since_joining")))


# Calendar months in a bitmap word.
WORD = 64


def user_review_profile(stg_reviews: DataFrame) -> DataFrame:
    """One row per reviewing user and word of 64 months: the bitmap of active months, first/last review date,
    review count and sums -- everything both user marts need from the review table.

    One partial (map-side) aggregate of fixed-width buffers: a user with millions of reviews ships a
    few small records per map task.  Each mart uses only its columns (Catalyst prunes the rest); a build
    that writes this table once reads and shuffles the reviews once for both marts.
    """
    month = F.year("review_month") * 12 + F.month("review_month") - 1
    return stg_reviews.groupBy("user_id", F.floor(month / WORD).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(month, F.lit(WORD)))).alias("months"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.sum("stars").alias("stars_sum"), F.count("stars").alias("stars_n"),
        F.sum("engagement_score").alias("engagement_sum"), F.count("engagement_score").alias("engagement_n"),
    )


def review_activity_from_profile(profile: DataFrame) -> DataFrame:
    """What ``review_activity`` gives, from the (much smaller) profile, with the number of active months."""
    return profile.groupBy("user_id").agg(
        F.sum(F.bit_count("months")).cast("long").alias("active_months"),
        F.min("first_review_date").alias("first_review_date"),
        F.max("last_review_date").alias("last_review_date"),
        F.sum("total_reviews").alias("total_reviews"),
        F.try_divide(F.sum("stars_sum"), F.sum("stars_n")).alias("avg_stars"),
        F.try_divide(F.sum("engagement_sum"), F.sum("engagement_n")).alias("avg_engagement_score"),
    )


def cohort_activity(stg_users: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """Distinct active users per (cohort_month, months_since_joining), months >= 0."""
    return cohort_activity_from_profile(stg_users, user_review_profile(stg_reviews))


def cohort_activity_from_profile(stg_users: DataFrame, profile: DataFrame) -> DataFrame:
    joined = stg_users.select("user_id", "cohort_month").join(profile.select("user_id", "word", "months"), "user_id")
    # A bit is one user active in one month; the bits of a row are counted per cohort before they are shuffled.
    active = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function(
        "shiftrightunsigned", F.col("months"), i).bitwiseAND(F.lit(1)) == 1)
    per_month = (joined.select("cohort_month", "word", F.explode(active).alias("bit"))
                 .groupBy("cohort_month", "word", "bit").agg(F.count(F.lit(1)).alias("active_users")))
    month = F.col("word") * WORD + F.col("bit")
    activity = per_month.select(
        "cohort_month", "active_users", F.make_date(F.floor(month / 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))
        .alias("activity_month"))
    return (activity.where(F.col("activity_month") >= F.col("cohort_month"))
            .select("cohort_month", C.months_between_starts("activity_month", "cohort_month").alias("months_since_joining"),
                    "active_users"))


def cohort_sizes(activity: DataFrame) -> DataFrame:
    """Month-0 active users per cohort (cohorts with no month-0 activity are absent)."""
    return (activity.where(F.col("months_since_joining") == 0)
            .select("cohort_month", F.col("active_users").alias("cohort_size")))


def retention_cohorts(stg_users: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    return retention_from_profile(stg_users, user_review_profile(stg_reviews))


def retention_from_profile(stg_users: DataFrame, profile: DataFrame) -> DataFrame:
    activity = cohort_activity_from_profile(stg_users, profile)
    # The month-0 base is attached with a window over the (small) cohort table instead of
    # a self-join; cohorts without a base vanish as in an inner join.
    base = F.max(F.when(F.col("months_since_joining") == 0, F.col("active_users"))) \
        .over(Window.partitionBy("cohort_month"))
    return (activity
            .withColumn("cohort_size", base)
            .where(F.col("cohort_size").isNotNull())
            .select("cohort_month", "months_since_joining", "active_users", "cohort_size",
                    C.exact_pct("active_users", "cohort_size", 2).alias("retention_rate"))
            .orderBy("cohort_month", "months_since_joining"))


# --------------------------------------------------------------- survival
def review_activity(stg_reviews: DataFrame) -> DataFrame:
    """Per-user first/last review, count and means (partial aggregation, skew-safe)."""
    return stg_reviews.groupBy("user_id").agg(
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("stars").alias("avg_stars"),
        F.avg("engagement_score").alias("avg_engagement_score"),
    )


def survival_inputs(stg_users: DataFrame, stg_reviews: DataFrame, as_of,
                    inactive_months: int = P.INACTIVE_MONTHS) -> DataFrame:
    return survival_from_profile(stg_users, review_activity(stg_reviews), as_of, inactive_months)


def survival_from_profile(stg_users: DataFrame, profile: DataFrame, as_of,
                          inactive_months: int = P.INACTIVE_MONTHS) -> DataFrame:
    """Survival inputs from per-user activity (``review_activity``, or ``review_activity_from_profile``)."""
    users = stg_users.select("user_id", "cohort_month", "user_segment")
    cutoff = F.add_months(C.as_date(as_of), -inactive_months)
    return (users.join(profile, "user_id")
            .select(
                "user_id", "cohort_month", "user_segment", "first_review_date", "last_review_date",
                C.days_between("last_review_date", "first_review_date").alias("survival_days"),
                "total_reviews", "avg_stars", "avg_engagement_score",
                F.coalesce(F.col("last_review_date") < cutoff, F.lit(False)).alias("churned"),
            ))
