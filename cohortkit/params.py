"""Parameters and fixed values.

Nothing in the engine reads the wall clock: every date-relative rule takes ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the analysed project's rules for results to match.
# ---------------------------------------------------------------------------
# Launch traction tiers by upvotes (>= threshold, checked top-down).
TRACTION_TIERS = [(700, "High Traction"), (500, "Medium Traction")]
TRACTION_DEFAULT = "Low Traction"
# Review sentiment by stars: >= 4 Positive, == 3 Neutral, anything else Negative.
SENTIMENT_POSITIVE_MIN = 4
SENTIMENT_NEUTRAL = 3
SENTIMENTS = ["Positive", "Neutral", "Negative"]
# User segment by lifetime review_count (>= threshold, checked top-down).
USER_SEGMENTS = [(100, "Power User"), (20, "Regular User"), (5, "Casual User")]
USER_SEGMENT_DEFAULT = "New User"
SEGMENT_NAMES = ["Power User", "Regular User", "Casual User", "New User"]
# Influence tier by fans (>= threshold, checked top-down).
INFLUENCE_TIERS = [(100, "Influencer"), (10, "Active")]
INFLUENCE_DEFAULT = "Standard"
INFLUENCE_NAMES = ["Influencer", "Active", "Standard"]
# Launch scoring.
TOP_PERFORMER_UPVOTES = 700
SUCCESS_SCORE_DIVISOR = 10
SUCCESS_SCORE_CAP = 100
UNCATEGORIZED = "Uncategorized"
# Churn flag: no activity in the 12 calendar months before as_of.
INACTIVE_MONTHS = 12
# Churn label for the classifier: lifetime shorter than 180 days.
CHURN_DAYS = 180
# Survival analysis population: users with at least 2 reviews and a lifetime >= 0.
MIN_REVIEWS = 2
# Segments with fewer users than this get no curve.
MIN_GROUP = 10
# Survival read-outs at these day counts.
MILESTONE_DAYS = [30, 90, 180, 365]
# Days per "month" when a day count is reported in months.
DAYS_PER_MONTH = 30
# Fallback product URL when a launch has no website.
LAUNCH_URL_PREFIX = "https://www.producthunt.com/posts/"
# Raw-user defaults for missing keys.
DEFAULT_YELPING_SINCE = dt.date(2004, 1, 1)
# Gradient-boosted trees: 100 trees, depth 4, learning rate 0.1, seed 42; 20 % hold-out.
GBT_TREES = 100
GBT_DEPTH = 4
GBT_STEP = 0.1
SEED = 42
# Dashboard: top launches shown, retention curve horizon in months.
TOP_LAUNCHES = 10
CURVE_MAX_MONTH = 12
# Two-sided 95 % normal quantile used by the survival confidence band.
Z_95 = 1.959963984540054


@dataclass(frozen=True)
class Params:
    """Run parameters.  ``as_of`` replaces the database's CURRENT_DATE."""

    as_of: dt.date
    inactive_months: int = INACTIVE_MONTHS
    churn_days: int = CHURN_DAYS
    min_reviews: int = MIN_REVIEWS
    min_group: int = MIN_GROUP
    milestones: tuple = tuple(MILESTONE_DAYS)
    # Dashboard cohort window, half open [cohort_lo, cohort_hi); None: no bound.
    cohort_lo: dt.date | None = None
    cohort_hi: dt.date | None = None
    # Bounds of the quality suite's row-count and review-date checks; None: no bound.
    dq_max_rows: int | None = None
    dq_date_lo: dt.date | None = None
    dq_date_hi: dt.date | None = None
    curve_max_month: int = CURVE_MAX_MONTH
    top_n: int = TOP_LAUNCHES


# The driver-generated test tables end on this date; the fixture views use it as as_of.
FIXTURE_PARAMS = Params(
    as_of=dt.date(2001, 8, 1),
    cohort_lo=dt.date(1996, 1, 1),
    cohort_hi=dt.date(2000, 1, 1),
    dq_date_lo=dt.date(2000, 1, 1),
    dq_date_hi=dt.date(2030, 1, 1),
)
