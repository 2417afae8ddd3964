"""One build of the model graph: staging views -> quality gate -> mart tables.

Mirrors a declarative model build: staging models are views (lazy DataFrames
registered by name), the declared checks run against them, and the marts are only
written when every check passes.  Each mart write is one Spark job; the written
tables cut the lineage for the analyses that read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..sources import registry
from .models import Models


def run_build(spark: SparkSession, models: Models, root: str, gate: bool = True,
              suite=None) -> tuple[DataFrame, dict[str, str]]:
    """Returns (quality report, written mart paths).  Raises ``QualityGateError`` when
    ``gate`` is set and a check fails; nothing is written then."""
    views = models.staging_views()
    registry.register_views(spark, views)
    report = quality.dq_report(views, suite or quality.suite(models.params)).cache()
    if gate:
        quality.gate(report)
    # Both user marts aggregate the reviews per user: that profile is written once and read by
    # both (the gate has its own passes: one fused scan per model, one grouped pass per unique check).
    inter = registry.materialize({"user_review_profile": models.user_profile}, root, layer="intermediate")
    models.use_profile(spark.read.parquet(inter["user_review_profile"]))
    paths = registry.materialize(models.mart_tables(), root, layer="marts")
    return report, paths
