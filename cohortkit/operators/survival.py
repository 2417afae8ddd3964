"""Kaplan-Meier survival analysis as grouped Spark jobs.

Scale plan: the per-user input (one row per user) is first reduced by a partial
aggregate to an *event table* keyed by (group, duration).  Durations are whole days,
so the event table holds at most a few thousand rows per group however many users
there are; all windows (reverse running sums, running products) run on that table.
No per-user data ever reaches one task or the driver, and any number of groups is
handled by one job (``by`` columns), not a loop.

Formulas: Kaplan & Meier (1958) product-limit estimate; Greenwood (1926) variance;
the pointwise band uses the log(-log S) transform (Kalbfleisch & Prentice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P

ROUND = 6


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def km_input(survival: DataFrame, min_reviews: int = P.MIN_REVIEWS) -> DataFrame:
    """Users the survival analysis uses: lifetime >= 0 days and >= ``min_reviews`` reviews."""
    return (survival
            .where((F.col("survival_days") >= 0) & (F.col("total_reviews") >= min_reviews))
            .select("user_id", "survival_days", "churned", "user_segment", "total_reviews",
                    "avg_engagement_score"))


def _event_table(df: DataFrame, duration: str, event: str, by: list[str]) -> DataFrame:
    """Event table with the group size (number of subjects) kept as ``group_size``."""
    contributions = F.array(
        F.struct(F.col(duration).cast("int").alias("t"), F.col(event).cast("int").alias("d"),
                 F.lit(1).alias("r")),
        F.struct(F.lit(0).alias("t"), F.lit(0).alias("d"), F.lit(0).alias("r")))
    table = (df.select(*by, F.inline(contributions))
             .groupBy(*by, "t")
             .agg(F.sum("d").cast("long").alias("observed"), F.sum("r").cast("long").alias("removed")))
    before = F.coalesce(F.sum("removed").over(
        Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("removed").over(Window.partitionBy(*by))
    return (table
            .withColumn("group_size", total)
            .withColumn("at_risk", F.col("group_size") - before)
            .withColumn("censored", F.col("removed") - F.col("observed")))


def km_events(df: DataFrame, by=None, duration: str = "survival_days", event: str = "churned") -> DataFrame:
    """Event table with ``group_size``: the small table every curve, median and read-out
    is derived from.  Writing it once lets any number of curves skip the per-user input."""
    return _event_table(df, duration, event, _by(by))


def km_event_table(df: DataFrame, duration: str = "survival_days", event: str = "churned",
                   by=None) -> DataFrame:
    """Per (group, t): observed events, censored, removed and at-risk counts.

    A t = 0 row is always present (the curve starts at 0 with everybody at risk): every
    input row also emits an empty (t=0) contribution, which the partial aggregate folds
    away on the map side.  at_risk(t) = group total - removed before t, so all windows
    share one ascending sort per group.
    """
    by = _by(by)
    return _event_table(df, duration, event, by).select(*by, "t", "at_risk", "observed", "censored", "removed")


def _running(by: list[str]) -> Window:
    return (Window.partitionBy(*by).orderBy("t")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def km_curve(events: DataFrame, by=None, z: float | None = None, alpha: float | None = None) -> DataFrame:
    """S(t) = prod(1 - d/n) over event times <= t, per group.

    With ``z`` (or ``alpha``: z is the 1 - alpha/2 normal quantile) set, adds a pointwise
    band (Greenwood variance, log(-log) transform); the band is null where S is 0 or 1.
    """
    if z is None and alpha is not None:
        from statistics import NormalDist
        z = NormalDist().inv_cdf(1 - alpha / 2)
    by = _by(by)
    w = _running(by)
    hazard = 1.0 - F.try_divide(F.col("observed"), F.col("at_risk"))
    out = events.withColumn("survival_raw", F.product(hazard).over(w))
    if z is not None:
        term = F.when(F.col("at_risk") > F.col("observed"),
                      F.col("observed") / (F.col("at_risk") * (F.col("at_risk") - F.col("observed"))))
        # Once d = n the variance is infinite; S is 0 from there on and the band is null.
        exhausted = F.max(F.when(F.col("at_risk") == F.col("observed"), 1).otherwise(0)).over(w)
        s = F.col("survival_raw")
        var = F.when(exhausted == 0, F.sum(F.coalesce(term, F.lit(0.0))).over(w))
        inner = (s > 0) & (s < 1) & var.isNotNull()
        log_s = F.log(s)
        spread = F.lit(z) * F.sqrt(var) / log_s
        out = (out
               .withColumn("variance", var)
               .withColumn("ci_lower", F.when(inner, F.round(F.pow(s, F.exp(-spread)), ROUND)))
               .withColumn("ci_upper", F.when(inner, F.round(F.pow(s, F.exp(spread)), ROUND))))
    return out.withColumn("survival", F.round("survival_raw", ROUND))


def km_overall(df: DataFrame) -> DataFrame:
    """Overall curve with survival in percent (dashboard form)."""
    curve = km_curve(km_event_table(df))
    return curve.select("t", "at_risk", "observed", "censored", "survival",
                        F.round(F.col("survival_raw") * 100, 4).alias("survival_pct"))


def km_confidence(df: DataFrame, z: float = P.Z_95) -> DataFrame:
    curve = km_curve(km_event_table(df), z=z)
    return curve.select("t", "survival", "ci_lower", "ci_upper")


def _large_groups(df: DataFrame, by: list[str], min_group: int) -> DataFrame:
    """Event tables of the groups with at least ``min_group`` subjects."""
    return _event_table(df, "survival_days", "churned", by).where(F.col("group_size") >= min_group)


def km_by_segment(df: DataFrame, by: str = "user_segment", min_group: int = P.MIN_GROUP) -> DataFrame:
    """One curve per segment with at least ``min_group`` users, in one job."""
    events = _large_groups(df, [by], min_group)
    curve = km_curve(events, by=by)
    return curve.select(by, "t", "at_risk", "observed", "censored", "survival")


def km_median(curve: DataFrame, by=None) -> DataFrame:
    """Least t with S(t) <= 0.5 (null when the curve never gets there), also in months."""
    by = _by(by)
    med = F.min(F.when(F.col("survival_raw") <= 0.5, F.col("t")))
    out = curve.groupBy(*by).agg(med.alias("median_days"))
    return out.withColumn("median_months", F.round(F.col("median_days") / F.lit(float(P.DAYS_PER_MONTH)), 1))


def km_at(curve: DataFrame, days: Sequence[int] = tuple(P.MILESTONE_DAYS), by=None) -> DataFrame:
    """S at the given day counts: value at the greatest t <= x (1.0 before the first t).

    S is non-increasing, so that value is the minimum of S over t <= x; all read-outs
    come from one conditional aggregate over the curve -- no join.
    """
    by = _by(by)
    aggs = [F.min(F.when(F.col("t") <= x, F.col("survival_raw"))).alias(f"s{x}") for x in days]
    wide = curve.groupBy(*by).agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(int(x)).alias("days"),
                               F.round(F.coalesce(F.col(f"s{x}"), F.lit(1.0)), ROUND).alias("survival"))
                      for x in days])
    return wide.select(*by, F.inline(pairs))


def km_median_by_segment(df: DataFrame, by: str = "user_segment", min_group: int = P.MIN_GROUP) -> DataFrame:
    events = _large_groups(df, [by], min_group)
    return km_median(km_curve(events, by=by), by=by)


def segment_table(df: DataFrame, by: str = "user_segment", min_group: int = P.MIN_GROUP) -> DataFrame:
    """(segment, users, median survival days) for segments with enough users."""
    events = _large_groups(df, [by], min_group)
    curve = km_curve(events, by=by)
    med = F.min(F.when(F.col("survival_raw") <= 0.5, F.col("t")))
    return curve.groupBy(by).agg(F.max("group_size").alias("users"), med.alias("median_survival_days"))


def survival_summary(df: DataFrame) -> DataFrame:
    """Users, churned users, churn share (%) and mean lifetime of the analysed users."""
    churn = F.col("churned").cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum(churn).cast("long").alias("churned_users"),
        F.round(F.avg(churn) * 100, 6).alias("churn_pct"),
        F.round(F.avg("survival_days"), 6).alias("avg_survival_days"),
    )
