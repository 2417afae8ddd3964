"""Dashboard datasets: the numbers behind each chart and KPI card, as DataFrames.

All inputs are marts.  Where a dataset needs an ordering over the whole input
(positional cohort picks, shares of a total) it runs on an already aggregated table
whose size is bounded by the calendar or the category vocabulary, not by row volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C


def overview_kpis(survival: DataFrame, launch_perf: DataFrame) -> DataFrame:
    """Users analysed, churn rate (%), mean lifetime (days), launches tracked: one row.

    Both inputs are scanned once in a single aggregate over their union (no join).
    """
    s = survival.select(F.lit(1).alias("is_user"), F.col("churned").cast("int").alias("churn"),
                        F.col("survival_days").alias("days"))
    l_ = launch_perf.select(F.lit(0).alias("is_user"), F.lit(None).cast("int").alias("churn"),
                            F.lit(None).cast("int").alias("days"))
    both = s.unionByName(l_)
    return both.agg(
        F.sum("is_user").cast("long").alias("users"),
        F.round(F.avg("churn") * 100, 6).alias("churn_rate_pct"),
        F.round(F.avg("days"), 6).alias("avg_survival_days"),
        F.sum(1 - F.col("is_user")).cast("long").alias("launches"),
    )


def _curve_window(retention: DataFrame, lo, hi, max_month: int) -> DataFrame:
    """Cohorts in [lo, hi); None: no bound."""
    out = retention.where(F.col("months_since_joining") <= max_month)
    out = out.where(F.col("cohort_month") >= C.as_date(lo)) if lo is not None else out
    return out.where(F.col("cohort_month") < C.as_date(hi)) if hi is not None else out


def cohort_list(retention: DataFrame, lo, hi, max_month: int = P.CURVE_MAX_MONTH) -> DataFrame:
    """Distinct cohorts in the dashboard window, sorted, with their 0-based position.

    The distinct list is bounded by the number of calendar months in the window, so
    the positional window runs on a few dozen rows.
    """
    cohorts = _curve_window(retention, lo, hi, max_month).select("cohort_month").distinct()
    return cohorts.withColumn("position", (F.row_number().over(Window.orderBy("cohort_month")) - 1).cast("int"))


def default_cohorts(retention: DataFrame, lo, hi, max_month: int = P.CURVE_MAX_MONTH) -> DataFrame:
    """Cohorts preselected on the dashboard: positions 0 and 6, or only 0 when there are <= 6."""
    listed = cohort_list(retention, lo, hi, max_month)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return (listed.withColumn("n", n)
            .where((F.col("position") == 0) | ((F.col("position") == 6) & (F.col("n") > 6)))
            .select("cohort_month", "position"))


def retention_curves(retention: DataFrame, lo, hi, max_month: int = P.CURVE_MAX_MONTH,
                     cohorts: DataFrame | None = None) -> DataFrame:
    """Retention rate by month for the chosen cohorts (default: ``default_cohorts``).

    The chosen cohorts are reduced to distinct dates before they are broadcast into a
    semi join, so the broadcast is bounded by the calendar (the default pick has at
    most 2 rows; any caller-supplied list at most one row per distinct date).
    """
    window = _curve_window(retention, lo, hi, max_month)
    chosen = cohorts if cohorts is not None else default_cohorts(retention, lo, hi, max_month)
    picked = chosen.select(F.col("cohort_month").cast("date").alias("cohort_month")).distinct()
    return (window.join(F.broadcast(picked), "cohort_month", "left_semi")
            .select("cohort_month", "months_since_joining", "retention_rate"))


def month1_by_year(retention: DataFrame) -> DataFrame:
    """Unweighted mean month-1 retention per cohort year, rounded to 1 place."""
    return (retention.where(F.col("months_since_joining") == 1)
            .groupBy(F.year("cohort_month").alias("cohort_year"))
            .agg(C.round_avg("retention_rate", 1).alias("avg_month1_retention"))
            .orderBy("cohort_year"))


def category_bars(category_perf: DataFrame) -> DataFrame:
    return (category_perf.select("category", "avg_success_score")
            .orderBy(F.col("avg_success_score").asc_nulls_last(), F.col("category").asc_nulls_last()))


def launch_scatter(launch_perf: DataFrame) -> DataFrame:
    return (launch_perf
            .select("name", "upvotes", "category", "traction_tier", "success_score",
                    "days_since_launch", "launch_month")
            .orderBy(F.col("upvotes").desc_nulls_first(), F.col("name").asc_nulls_last()))


def launch_share(category_perf: DataFrame) -> DataFrame:
    """Share of launches per category in percent.

    The total is a window over the (aggregated, vocabulary-sized) category table: one
    pass.  A scalar subquery would compute the category table a second time."""
    total = F.sum("total_launches").over(Window.partitionBy())
    return category_perf.select(
        "category", "total_launches",
        F.round(F.col("total_launches") * 100.0 / total, 6).alias("share_pct"))


def top_launches(launch_perf: DataFrame, n: int = P.TOP_LAUNCHES) -> DataFrame:
    """Top ``n`` launches by upvotes, descending with nulls first (the source database's
    DESC order), ties broken by product URL.  Planned as a bounded top-k."""
    return (launch_perf
            .orderBy(F.col("upvotes").desc_nulls_first(), F.col("product_url").asc())
            .limit(n)
            .select("name", "upvotes", "category", "traction_tier", "success_score"))


def segment_counts(df: DataFrame, by: str = "user_segment") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("users"))
