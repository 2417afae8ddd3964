"""DuckDB SQL for the correctness oracle.

Each oracle query is ``WITH <adapter views>, <model views> <final select>``: the same
fixture adapter and the same model rules, written independently as SQL.  Output
types are cast to what the Spark side returns (counts BIGINT, day/month counts INT,
rates DOUBLE, months DATE).
"""

from __future__ import annotations

from .. import params as P
from ..params import FIXTURE_PARAMS
from ..sources.fixtures import ADAPTER_SQL

AS_OF = FIXTURE_PARAMS.as_of.isoformat()


def _ladder(measure: str, steps, otherwise: str) -> str:
    """The label of the highest threshold a measure reaches, looked up in a list of steps."""
    listed = ", ".join(f"({bound}, '{label}')" for bound, label in steps)
    return (f"coalesce((SELECT arg_max(step.label, step.bound) FROM (VALUES {listed}) AS step(bound, label) "
            f"WHERE {measure} >= step.bound), '{otherwise}')")


def _start_of(unit: str, day: str) -> str:
    return f"CAST(date_trunc('{unit}', {day}) AS DATE)"


# What each model returns, said as properties of its output and not as the build steps: cohorts come from
# the sets of distinct active months, their base from a window, the churn flag is a comparison.
MODEL_SQL = f"""
stg_launches AS (
  SELECT l.* EXCLUDE (name, tagline, category, pricing_type, launch_date, scraped_at),
         lower(l.name).trim() AS name, trim(l.tagline) AS tagline,
         coalesce(trim(l.category), '{P.UNCATEGORIZED}') AS category,
         {_ladder("l.upvotes", P.TRACTION_TIERS, P.TRACTION_DEFAULT)} AS traction_tier,
         l.launch_date, l.scraped_at
  FROM raw_launches AS l
),
stg_reviews AS (
  SELECT rv.*, rv.stars + rv.useful + rv.funny + rv.cool AS engagement_score,
         {_start_of("month", "rv.review_date")} AS review_month, {_start_of("year", "rv.review_date")} AS review_year,
         list_extract(['{P.SENTIMENTS[2]}', '{P.SENTIMENTS[1]}', '{P.SENTIMENTS[0]}'],
                      1 + CAST(rv.stars = 3 AS INT) + 2 * CAST(rv.stars >= 4 AS INT)) AS sentiment
  FROM raw_reviews AS rv WHERE rv.review_date IS NOT NULL
),
stg_users AS (
  SELECT us.*, {_start_of("month", "us.yelping_since")} AS cohort_month,
         {_start_of("year", "us.yelping_since")} AS cohort_year,
         {_ladder("us.review_count", P.USER_SEGMENTS, P.USER_SEGMENT_DEFAULT)} AS user_segment,
         {_ladder("us.fans", P.INFLUENCE_TIERS, P.INFLUENCE_DEFAULT)} AS influence_tier
  FROM raw_users AS us WHERE us.yelping_since IS NOT NULL
),
launch_perf AS (
  SELECT id, name, product_url, category, launch_date, traction_tier, upvotes,
         CAST(DATE '{AS_OF}' - launch_date AS INT) AS days_since_launch,
         CAST(round(CAST(least(upvotes, {P.SUCCESS_SCORE_CAP * P.SUCCESS_SCORE_DIVISOR}) AS DECIMAL(12,2))
                    / {P.SUCCESS_SCORE_DIVISOR}, 2) AS DOUBLE) AS success_score,
         coalesce(upvotes >= {P.TOP_PERFORMER_UPVOTES}, FALSE) AS is_top_performer,
         left(CAST(launch_date AS VARCHAR), 7) AS launch_month
  FROM stg_launches
),
category_perf AS (
  SELECT category, n AS total_launches, CAST(round(mean_votes, 0) AS DOUBLE) AS avg_upvotes, best AS max_upvotes,
         tops AS top_performer_count, CAST(round(mean_score, 2) AS DOUBLE) AS avg_success_score,
         CAST(round(mean_age, 0) AS DOUBLE) AS avg_days_since_launch,
         CAST(round(100.0 * tops / n, 0) AS DOUBLE) AS top_performer_pct
  FROM (FROM launch_perf SELECT category, count(*) AS n, avg(upvotes) AS mean_votes, max(upvotes) AS best,
        count(*) FILTER (is_top_performer) AS tops, avg(success_score) AS mean_score, avg(days_since_launch) AS mean_age
        GROUP BY ALL)
),
user_activity AS (
  SELECT member.user_id, member.cohort_month, seen.review_month AS activity_month,
         CAST(date_diff('month', member.cohort_month, seen.review_month) AS INT) AS months_since_joining
  FROM stg_reviews AS seen INNER JOIN stg_users AS member USING (user_id)
),
member_months AS (
  SELECT DISTINCT user_id, cohort_month, months_since_joining FROM user_activity WHERE months_since_joining >= 0
),
cohort_activity AS (
  FROM member_months SELECT cohort_month, months_since_joining, count(*) AS active_users GROUP BY ALL
),
cohort_sizes AS (
  FROM member_months SELECT cohort_month, count(*) AS cohort_size WHERE months_since_joining = 0 GROUP BY ALL
),
retention AS (
  FROM (FROM cohort_activity SELECT *, max(active_users) FILTER (months_since_joining = 0)
                                       OVER (PARTITION BY cohort_month) AS cohort_size)
  SELECT *, CAST(round(CAST(active_users AS DECIMAL(30,0)) * 100 / cohort_size, 2) AS DOUBLE) AS retention_rate
  WHERE cohort_size IS NOT NULL
),
review_activity AS (
  FROM stg_reviews SELECT user_id, min(review_date) AS first_review_date, max(review_date) AS last_review_date,
       count(*) AS total_reviews, avg(stars) AS avg_stars, avg(engagement_score) AS avg_engagement_score GROUP BY user_id
),
survival AS (
  SELECT member.user_id, member.cohort_month, member.user_segment, act.* EXCLUDE (user_id),
         CAST(act.last_review_date - act.first_review_date AS INT) AS survival_days,
         act.last_review_date < DATE '{AS_OF}' - INTERVAL {P.INACTIVE_MONTHS} MONTH AS churned
  FROM review_activity AS act INNER JOIN stg_users AS member USING (user_id)
)
"""


def with_models(final_select: str, extra_ctes: str = "") -> str:
    """Full oracle statement: adapter views + model views (+ extra views) + final select."""
    ctes = ADAPTER_SQL.strip() + ",\n" + MODEL_SQL.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + final_select.strip()
