"""Registered queries, plus the oracle SQL.

Each query is defined once, as a function of the model graph (``Models``).  The driver
contract wraps it as ``(spark, sf_dir) -> DataFrame`` over the fixture adapter, so every
query reads the driver's test tables and its work grows with them; ``bench.py`` runs
the same functions over raw tables landed once as Parquet (the production layout).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..params import FIXTURE_PARAMS
from ..session import configure
from .models import Models
from .oracle import with_models

QueryFn = Callable[[SparkSession, str], DataFrame]
ModelQuery = Callable[[Models], DataFrame]

QUERIES: dict[str, QueryFn] = {}
MODEL_QUERIES: dict[str, ModelQuery] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(models) -> DataFrame`` under ``name`` (with its oracle SQL)."""
    def deco(fn: ModelQuery) -> ModelQuery:
        MODEL_QUERIES[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(models(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str) -> Models:
    configure(spark)
    return Models.from_fixtures(spark, sf_dir, FIXTURE_PARAMS)


# ------------------------------------------------------------------ staging
register("stg_launches", with_models("SELECT * FROM stg_launches"))(
    lambda m: m.stg_launches)
register("stg_reviews", with_models("SELECT * FROM stg_reviews"))(
    lambda m: m.stg_reviews)
register("stg_users", with_models("SELECT * FROM stg_users"))(
    lambda m: m.stg_users)

# -------------------------------------------------------------------- marts
register("launch_performance", with_models("SELECT * FROM launch_perf"))(
    lambda m: m.launch_performance)
register("category_performance",
         with_models("SELECT * FROM category_perf ORDER BY avg_success_score DESC NULLS FIRST, category"))(
    lambda m: m.category_performance)
register("retention_cohorts",
         with_models("SELECT * FROM retention ORDER BY cohort_month, months_since_joining"))(
    lambda m: m.retention_cohorts)
register("survival_inputs", with_models("SELECT * FROM survival"))(
    lambda m: m.survival_inputs)


@register("user_activity", with_models("SELECT * FROM user_activity"))
def _user_activity(m):
    from ..operators import marts
    return marts.user_activity(m.stg_users, m.stg_reviews)


@register("cohort_activity", with_models("SELECT * FROM cohort_activity"))
def _cohort_activity(m):
    from ..operators import marts
    return marts.cohort_activity(m.stg_users, m.stg_reviews)


@register("cohort_sizes", with_models("SELECT * FROM cohort_sizes"))
def _cohort_sizes(m):
    from ..operators import marts
    return marts.cohort_sizes(marts.cohort_activity(m.stg_users, m.stg_reviews))


@register("user_review_profile", with_models("""
SELECT user_id, COUNT(DISTINCT review_month) AS active_months, MIN(review_date) AS first_review_date,
       MAX(review_date) AS last_review_date, COUNT(*) AS total_reviews, AVG(stars) AS avg_stars,
       AVG(engagement_score) AS avg_engagement_score
FROM stg_reviews GROUP BY user_id"""))
def _user_review_profile(m):
    """The shared intermediate of the user marts, summed per user (months reported as their number)."""
    from ..operators import marts
    return marts.review_activity_from_profile(m.user_profile)


@register("review_activity", with_models("SELECT * FROM review_activity"))
def _review_activity(m):
    from ..operators import marts
    return marts.review_activity(m.stg_reviews)


def load_all() -> None:
    """Import the modules that register the remaining queries."""
    from . import queries_analysis, queries_ingest  # noqa: F401
