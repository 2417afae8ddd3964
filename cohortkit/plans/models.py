"""The model graph: raw -> staging -> marts, as lazily built DataFrames.

``Models`` is the DataFrame counterpart of the raw/staging/marts layers.  Each
attribute is built on first use from the ones it depends on; nothing runs until a
result is written or collected, so Catalyst sees (and prunes) the whole plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts, staging
from ..params import FIXTURE_PARAMS, Params
from ..sources import fixtures


class Models:
    def __init__(self, raw: dict[str, DataFrame], params: Params = FIXTURE_PARAMS, source: str = ""):
        self.raw = raw
        self.params = params
        self._stored_profile = False
        self.source = source  # where the raw tables come from (for memoising derived models)

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.raw.values())).sparkSession

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> "Models":
        return cls(fixtures.raw_tables(spark, sf_dir), params, source=f"fixtures:{sf_dir}")

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, params: Params) -> "Models":
        """Raw tables stored as Parquet under ``root/raw/<name>``."""
        from ..session import plan_size_bytes, size_shuffles
        from ..sources.registry import read_raw
        raw = {n: read_raw(spark, root, n) for n in ("raw_reviews", "raw_users", "raw_launches")}
        size_shuffles(spark, sum(plan_size_bytes(df) for df in raw.values()))
        return cls(raw, params, source=f"tables:{root}")

    @classmethod
    def from_catalog(cls, spark: SparkSession, params: Params, tables: dict[str, str] | None = None) -> "Models":
        """Raw tables registered in the catalog (e.g. written by ``registry.save_bucketed``).

        When reviews and users are both bucketed by ``user_id`` with the same bucket count,
        the per-user aggregates and the user joins of the marts read them co-located: no
        shuffle of the review table at all.
        """
        from ..session import plan_size_bytes, size_shuffles
        names = tables or {n: n for n in ("raw_reviews", "raw_users", "raw_launches")}
        raw = {n: spark.table(t) for n, t in names.items()}
        size_shuffles(spark, sum(plan_size_bytes(df) for df in raw.values()))
        return cls(raw, params, source="catalog:" + ",".join(sorted(names.values())))

    # raw
    @property
    def raw_reviews(self) -> DataFrame:
        return self.raw["raw_reviews"]

    @property
    def raw_users(self) -> DataFrame:
        return self.raw["raw_users"]

    @property
    def raw_launches(self) -> DataFrame:
        return self.raw["raw_launches"]

    # staging
    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw_reviews)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw_users)

    @cached_property
    def stg_launches(self) -> DataFrame:
        return staging.stg_launches(self.raw_launches)

    # shared per-user intermediate of the two user marts
    @cached_property
    def user_profile(self) -> DataFrame:
        return marts.user_review_profile(self.stg_reviews)

    def use_profile(self, profile: DataFrame) -> "Models":
        """Use a stored per-user profile (e.g. written once by a build) for the user marts."""
        self.__dict__["user_profile"] = profile
        self._stored_profile = True
        for name in ("retention_cohorts", "survival_inputs"):
            self.__dict__.pop(name, None)
        return self

    # marts
    @cached_property
    def launch_performance(self) -> DataFrame:
        return marts.launch_performance(self.stg_launches, self.params.as_of)

    @cached_property
    def category_performance(self) -> DataFrame:
        return marts.category_performance(marts.launch_scores(self.stg_launches, self.params.as_of))

    @cached_property
    def retention_cohorts(self) -> DataFrame:
        return marts.retention_from_profile(self.stg_users, self.user_profile)

    @cached_property
    def survival_inputs(self) -> DataFrame:
        # Once the profile is stored the activity comes from it; before that, straight from the reviews.
        activity = (marts.review_activity_from_profile(self.user_profile) if self._stored_profile
                    else marts.review_activity(self.stg_reviews))
        return marts.survival_from_profile(self.stg_users, activity, self.params.as_of, self.params.inactive_months)

    def staging_views(self) -> dict[str, DataFrame]:
        return {"stg_launches": self.stg_launches, "stg_reviews": self.stg_reviews,
                "stg_users": self.stg_users}

    def mart_tables(self) -> dict[str, DataFrame]:
        return {"fct_launch_performance": self.launch_performance,
                "fct_category_performance": self.category_performance,
                "fct_retention_cohorts": self.retention_cohorts,
                "fct_survival_inputs": self.survival_inputs}
