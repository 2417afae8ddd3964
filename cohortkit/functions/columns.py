"""Column-expression helpers.  All return built-in Catalyst expressions (no UDFs),
so they stay inside whole-stage code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tier(c, thresholds, default: str) -> Column:
    """Searched CASE: first ``value >= threshold`` wins; null falls to ``default``."""
    c = _col(c)
    expr = None
    for threshold, label in thresholds:
        expr = F.when(c >= threshold, label) if expr is None else expr.when(c >= threshold, label)
    return expr.otherwise(default)


def traction_tier(upvotes="upvotes") -> Column:
    return tier(upvotes, P.TRACTION_TIERS, P.TRACTION_DEFAULT)


def user_segment(review_count="review_count") -> Column:
    return tier(review_count, P.USER_SEGMENTS, P.USER_SEGMENT_DEFAULT)


def influence_tier(fans="fans") -> Column:
    return tier(fans, P.INFLUENCE_TIERS, P.INFLUENCE_DEFAULT)


def sentiment(stars="stars") -> Column:
    """>= 4 Positive, exactly 3 Neutral, everything else (3.5, null, ...) Negative."""
    s = _col(stars)
    return (F.when(s >= P.SENTIMENT_POSITIVE_MIN, "Positive")
            .when(s == P.SENTIMENT_NEUTRAL, "Neutral")
            .otherwise("Negative"))


def month_start(d) -> Column:
    """Truncate a date to the first of its month, as a DATE."""
    return F.trunc(_col(d), "month")


def year_start(d) -> Column:
    return F.trunc(_col(d), "year")


def months_between_starts(later, earlier) -> Column:
    """Whole calendar months from ``earlier`` to ``later`` (both month starts).

    Negative when ``later`` precedes ``earlier``.  Integer arithmetic, so exact.
    """
    a, b = _col(later), _col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def days_between(later, earlier) -> Column:
    """``later - earlier`` in whole days as INT (Spark's date minus date is an interval)."""
    return F.datediff(_col(later), _col(earlier))


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast("date")


def exact_pct(numerator, denominator, scale: int) -> Column:
    """round(numerator / denominator * 100, scale) with exact HALF_UP rounding, as DOUBLE.

    Counts are cast to DECIMAL(19,0) (any long fits) and multiplied by 100 first, so
    Spark's decimal division keeps 15 fractional digits; rounding the quotient to
    ``scale`` places is then exact for any denominator below 10^12.  (Wider operands
    would make Spark cut the quotient to 6 digits, and rounding twice can flip a
    result such as 49.9949998 to 50.00.)
    """
    num = _col(numerator).cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)")
    q = F.try_divide(num, _col(denominator).cast("decimal(19,0)"))
    return F.round(q, scale).cast("double")


def round_avg(c, scale: int) -> Column:
    """round(avg(c), scale) on the exact mean (HALF_UP), as DOUBLE.

    The sum is exact in DECIMAL(28,6); dividing by the count as DECIMAL(19,0) keeps 16
    fractional digits, so the single rounding step sees the exact mean (as a NUMERIC
    average would).  ``avg`` on decimals would first round the mean to 6 digits.
    """
    col = _col(c)
    total = F.sum(col.cast("decimal(28,6)")).cast("decimal(28,6)")
    n = F.count(col).cast("decimal(19,0)")
    return F.round(F.try_divide(total, n), scale).cast("double")


def iso_date_prefix(c) -> Column:
    """First 10 characters of an ISO date / timestamp string as a DATE; null if invalid."""
    return F.try_to_date(F.substring(_col(c), 1, 10), "yyyy-MM-dd")


def display_number(c, decimals: int = 0) -> Column:
    """Thousands-separated text with fixed decimals (e.g. 12,345 or 52.3); a last-step
    projection for display -- datasets keep numbers."""
    return F.format_number(_col(c).cast("double"), decimals)
