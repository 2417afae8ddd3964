"""cohortkit: product-retention analytics as Spark DataFrame jobs.

Layers: ``sources`` (readers, fixture adapter, ingest, sinks), ``functions`` (column
expressions), ``operators`` (staging, marts, survival, quality, churn, datasets),
``plans`` (the model graph and the registered queries), ``streaming`` (incremental
ingest).

Typical use::

    from cohortkit import Models, Params, build_session
    spark = build_session()
    m = Models.from_tables(spark, "<warehouse>", Params(as_of=datetime.date(2024, 6, 1)))
    m.retention_cohorts.write.parquet("<warehouse>/marts/fct_retention_cohorts")
"""

from .params import Params
from .plans.models import Models
from .session import build_session, configure

__all__ = ["Models", "Params", "build_session", "configure"]
