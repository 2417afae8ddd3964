"""Binary-classification metrics as distributed aggregates.

``classification_report`` needs only the four confusion counts (one aggregate).
``roc_auc`` is the exact rank statistic with ties counted half:

    AUC = sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N)

computed as a distributed prefix sum: scores are grouped (partial aggregation) and cut
into ranges of about equal numbers of scores, each range gets its exclusive offset from a
small per-range total table, and the running sum inside a range is a window over that range
only.  The borders come from a quantile sketch; they only balance the work, so the result
is exact whatever the sketch says, and equal scores are one row, so never split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROUND = 6


def _safe(num, den):
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted means.

    A metric whose denominator is 0 is reported as 0.  Accuracy is in the ``f1``
    column of the ``accuracy`` row (as in the usual text report).
    """
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    counts = scored.agg(
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("double").alias("fp"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("double").alias("tn"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("double").alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    pr1, re1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    pr0, re0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    f1_1, f1_0 = _safe(2 * pr1 * re1, pr1 + re1), _safe(2 * pr0 * re0, pr0 + re0)
    s1, s0 = tp + fn, tn + fp
    total = s1 + s0

    def r(c):
        return F.round(c, ROUND).cast("double")

    def row(name, pr, re, f1, sup):
        return F.struct(F.lit(name).alias("class"),
                        (r(pr) if pr is not None else F.lit(None).cast("double")).alias("precision"),
                        (r(re) if re is not None else F.lit(None).cast("double")).alias("recall"),
                        r(f1).alias("f1"),
                        sup.cast("long").alias("support"))

    rows = F.array(
        row("0", pr0, re0, f1_0, s0),
        row("1", pr1, re1, f1_1, s1),
        row("accuracy", None, None, _safe(tp + tn, total), total),
        row("macro avg", (pr0 + pr1) / 2, (re0 + re1) / 2, (f1_0 + f1_1) / 2, total),
        row("weighted avg", _safe(pr0 * s0 + pr1 * s1, total), _safe(re0 * s0 + re1 * s1, total),
            _safe(f1_0 * s0 + f1_1 * s1, total), total),
    )
    return counts.select(F.inline(rows))


def score_ranges(by_score: DataFrame, groups: int = 32) -> DataFrame:
    """``by_score`` (a row per distinct score ``s``) with ``r``, its range of at most ``groups`` ** 2, in order.

    The borders are approximate quantiles of the distinct scores, found in the same plan.  A score
    looks for its group of ranges first, then for its range in it: 2 x ``groups`` comparisons.
    """
    n = groups * groups
    if n == 1:
        return by_score.withColumn("r", F.lit(0))
    shares = ", ".join(f"{i / n!r}D" for i in range(1, n))
    borders = by_score.select(F.expr(f"percentile_approx(s, array({shares}), {20 * n})")).scalar()
    # Of the first border of each further group, how many lie below the score.
    heads = F.transform(F.sequence(F.lit(1), F.lit(groups - 1)), lambda i: F.get(F.col("_borders"), i * groups - 1))

    def below(values):
        return F.coalesce(F.size(F.filter(values, lambda b: b < F.col("s"))), F.lit(0))

    grouped = by_score.withColumn("_borders", borders).withColumn("_group", F.when(
        F.col("_borders").isNotNull(), below(heads)).otherwise(0))
    within = F.slice("_borders", F.col("_group") * groups + 1, F.lit(groups - 1))
    return grouped.withColumn("r", F.when(F.col("_borders").isNotNull(), F.col("_group") * groups + below(within)).otherwise(0)).drop(
        "_borders", "_group")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", ranges: int = 1024) -> DataFrame:
    """Exact ROC AUC (ties count one half) of any scores, as a one-row DataFrame ``auc``.

    The ranges keep the scores' order, so the running count needs a window only inside a range; the
    per-range totals are at most ``ranges`` rows, up to the next square.  Nothing runs while the query is built.
    """
    y = F.col(label).cast("long")
    by_score = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    ranged = score_ranges(by_score, math.isqrt(max(1, ranges) - 1) + 1)
    totals = ranged.groupBy("r").agg(F.sum("neg").alias("range_neg"))
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("r", F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("neg_before_range"))
    inside = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("neg_before_in_range", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(
        F.broadcast(offsets), "r")
    below = F.col("neg_before_range") + F.col("neg_before_in_range")
    return ranked.agg(
        F.round(F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                             F.sum("pos") * F.sum("neg")), ROUND).alias("auc"))
