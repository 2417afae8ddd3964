"""Survival, churn and dashboard queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting, churn, datasets, metrics, survival
from ..params import FIXTURE_PARAMS, Z_95
from ..session import stored
from .catalog import register
from .oracle import with_models

LO = FIXTURE_PARAMS.cohort_lo.isoformat()
HI = FIXTURE_PARAMS.cohort_hi.isoformat()
MAXM = FIXTURE_PARAMS.curve_max_month
MIN_GROUP = FIXTURE_PARAMS.min_group


# ----------------------------------------------------------------- oracle SQL
def _km_ctes(by: str | None = None, min_group: int = 0) -> str:
    """Kaplan-Meier views in DuckDB SQL: km_in, km_base, km_tab, km_ev, km_cv."""
    p = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    start = (f"SELECT {by}, 0 AS t, 0 AS observed, 0 AS removed FROM km_base GROUP BY {by}" if by
             else "SELECT 0 AS t, 0 AS observed, 0 AS removed")
    return f"""
km_in AS (
  SELECT user_id, survival_days, churned, user_segment, total_reviews, avg_engagement_score
  FROM survival WHERE survival_days >= 0 AND total_reviews >= 2
),
km_base AS (
  SELECT {p}CAST(survival_days AS INT) AS t, CAST(SUM(CAST(churned AS INT)) AS BIGINT) AS observed,
         COUNT(*) AS removed
  FROM km_in GROUP BY ALL
),
km_tab AS (
  SELECT {p}t, CAST(SUM(observed) AS BIGINT) AS observed, CAST(SUM(removed) AS BIGINT) AS removed
  FROM (SELECT {p}t, observed, removed FROM km_base UNION ALL {start}) u GROUP BY ALL
),
km_ev AS (
  SELECT {p}t, observed, removed, removed - observed AS censored,
         CAST(SUM(removed) OVER ({part} ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS at_risk,
         CAST(SUM(removed) OVER ({part}) AS BIGINT) AS group_size
  FROM km_tab
),
km_cv AS (
  SELECT *,
         product(1.0 - observed / at_risk) OVER w AS s,
         CASE WHEN MAX(CASE WHEN at_risk = observed THEN 1 ELSE 0 END) OVER w = 0
              THEN SUM(COALESCE(CASE WHEN at_risk > observed
                                     THEN observed / (at_risk * (at_risk - observed)) END, 0.0)) OVER w
         END AS var
  FROM km_ev WHERE group_size >= {min_group}
  WINDOW w AS ({part} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def _km(final: str, by: str | None = None, min_group: int = 0) -> str:
    return with_models(final, _km_ctes(by, min_group))


_MED = "MIN(CASE WHEN s <= 0.5 THEN t END)"

TRAINING_CTE = """
training AS (
  SELECT user_id, survival_days, total_reviews, avg_stars, avg_engagement_score, user_segment,
         CASE WHEN survival_days < 180 THEN 1 ELSE 0 END AS churned_early
  FROM survival WHERE survival_days >= 0 AND total_reviews >= 2
),
rule_scored AS (
  SELECT user_id, churned_early AS label, ROUND(1.0 / total_reviews, 6) AS score,
         CASE WHEN ROUND(1.0 / total_reviews, 6) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM training
)"""

REPORT_SQL = """
WITH_CONF AS (
  SELECT CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
         CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
         CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
         CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
  FROM rule_scored
),
m1 AS (
  SELECT *,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS pr1,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS re1,
         CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS pr0,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS re0,
         tp + fn AS s1, tn + fp AS s0
  FROM WITH_CONF
),
m2 AS (
  SELECT *,
         CASE WHEN pr1 + re1 = 0 THEN 0.0 ELSE 2 * pr1 * re1 / (pr1 + re1) END AS f1_1,
         CASE WHEN pr0 + re0 = 0 THEN 0.0 ELSE 2 * pr0 * re0 / (pr0 + re0) END AS f1_0,
         s0 + s1 AS total
  FROM m1
)"""

REPORT_SELECT = """
SELECT '0' AS class, ROUND(pr0, 6) AS precision, ROUND(re0, 6) AS recall, ROUND(f1_0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM m2
UNION ALL SELECT '1', ROUND(pr1, 6), ROUND(re1, 6), ROUND(f1_1, 6), CAST(s1 AS BIGINT) FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(CASE WHEN total = 0 THEN 0.0 ELSE (tp + tn) / total END, 6), CAST(total AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', ROUND((pr0 + pr1) / 2, 6), ROUND((re0 + re1) / 2, 6), ROUND((f1_0 + f1_1) / 2, 6), CAST(total AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg',
  ROUND(CASE WHEN total = 0 THEN 0.0 ELSE (pr0 * s0 + pr1 * s1) / total END, 6),
  ROUND(CASE WHEN total = 0 THEN 0.0 ELSE (re0 * s0 + re1 * s1) / total END, 6),
  ROUND(CASE WHEN total = 0 THEN 0.0 ELSE (f1_0 * s0 + f1_1 * s1) / total END, 6),
  CAST(total AS BIGINT) FROM m2
"""

CURVE_CTES = f"""
curve_window AS (
  SELECT * FROM retention
  WHERE months_since_joining <= {MAXM} AND cohort_month >= DATE '{LO}' AND cohort_month < DATE '{HI}'
),
cohort_list AS (
  SELECT cohort_month, CAST(row_number() OVER (ORDER BY cohort_month) - 1 AS INT) AS position
  FROM (SELECT DISTINCT cohort_month FROM curve_window) d
),
default_cohorts AS (
  SELECT cohort_month, position FROM cohort_list
  WHERE position = 0 OR (position = 6 AND (SELECT COUNT(*) FROM cohort_list) > 6)
)"""


# ------------------------------------------------------------------ survival
def _km_in(m):
    return survival.km_input(m.survival_inputs)


register("km_input", _km("SELECT * FROM km_in"))(_km_in)

register("km_event_table", _km("SELECT t, at_risk, observed, censored, removed FROM km_ev"))(
    lambda m: survival.km_event_table(_km_in(m)))

register("km_overall", _km(
    "SELECT t, at_risk, observed, censored, ROUND(s, 6) AS survival, ROUND(s * 100, 4) AS survival_pct FROM km_cv"))(
    lambda m: survival.km_overall(_km_in(m)))

register("km_confidence", _km(f"""
SELECT t, ROUND(s, 6) AS survival,
       CASE WHEN s > 0 AND s < 1 AND var IS NOT NULL THEN ROUND(pow(s, exp(-({Z_95!r} * sqrt(var) / ln(s)))), 6) END AS ci_lower,
       CASE WHEN s > 0 AND s < 1 AND var IS NOT NULL THEN ROUND(pow(s, exp({Z_95!r} * sqrt(var) / ln(s))), 6) END AS ci_upper
FROM km_cv"""))(lambda m: survival.km_confidence(_km_in(m), Z_95))

register("km_by_segment", _km(
    "SELECT user_segment, t, at_risk, observed, censored, ROUND(s, 6) AS survival FROM km_cv",
    by="user_segment", min_group=MIN_GROUP))(
    lambda m: survival.km_by_segment(_km_in(m), min_group=MIN_GROUP))

register("km_median", _km(
    f"SELECT {_MED} AS median_days, ROUND({_MED} / 30.0, 1) AS median_months FROM km_cv"))(
    lambda m: survival.km_median(survival.km_curve(survival.km_event_table(_km_in(m)))))

register("km_median_by_segment", _km(
    f"SELECT user_segment, {_MED} AS median_days, ROUND({_MED} / 30.0, 1) AS median_months "
    f"FROM km_cv GROUP BY user_segment", by="user_segment", min_group=MIN_GROUP))(
    lambda m: survival.km_median_by_segment(_km_in(m), min_group=MIN_GROUP))

register("km_milestones", _km("\nUNION ALL ".join(
    f"SELECT {x} AS days, ROUND(COALESCE(MIN(CASE WHEN t <= {x} THEN s END), 1.0), 6) AS survival FROM km_cv"
    for x in FIXTURE_PARAMS.milestones)))(
    lambda m: survival.km_at(survival.km_curve(survival.km_event_table(_km_in(m))),
                             FIXTURE_PARAMS.milestones))

register("segment_table", _km(
    f"SELECT user_segment, MAX(group_size) AS users, {_MED} AS median_survival_days FROM km_cv GROUP BY user_segment",
    by="user_segment", min_group=MIN_GROUP))(
    lambda m: survival.segment_table(_km_in(m), min_group=MIN_GROUP))

register("segment_counts", _km(
    "SELECT user_segment, COUNT(*) AS users FROM km_in GROUP BY user_segment"))(
    lambda m: datasets.segment_counts(_km_in(m)))

register("survival_summary", _km("""
SELECT COUNT(*) AS users, CAST(SUM(CAST(churned AS INT)) AS BIGINT) AS churned_users,
       ROUND(AVG(CAST(churned AS INT)) * 100, 6) AS churn_pct, ROUND(AVG(survival_days), 6) AS avg_survival_days
FROM km_in"""))(lambda m: survival.survival_summary(_km_in(m)))


# --------------------------------------------------------------------- churn
def _training(m):
    return churn.churn_training_set(m.survival_inputs, m.params.churn_days, m.params.min_reviews)


def _churn_sql(final: str, extra: str = "") -> str:
    return with_models(final, TRAINING_CTE + ("," + extra if extra else ""))


register("churn_training_set", _churn_sql("SELECT * FROM training"))(_training)

register("segment_encoding", _churn_sql("""
SELECT t.*, CAST(c.code AS INT) AS user_segment_encoded
FROM training t JOIN (
  SELECT user_segment, dense_rank() OVER (ORDER BY user_segment) - 1 AS code
  FROM (SELECT DISTINCT user_segment FROM training) v
) c ON t.user_segment = c.user_segment"""))(
    lambda m: churn.segment_encoding(_training(m)))

# The hold-out side: a fifth of the users, rounded up, by the order of their hashes.
HELD_OUT = """
held AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(user_id)) <= ceil(count(*) OVER () * 20 / 100.0) THEN 'test'
                 ELSE 'train' END AS split
  FROM training
)"""

register("churn_split", _churn_sql("SELECT * FROM held", HELD_OUT))(
    lambda m: churn.churn_split(_training(m)))

register("churn_split_sizes", _churn_sql("SELECT split, COUNT(*) AS users FROM held GROUP BY split", HELD_OUT))(
    lambda m: churn.split_sizes(churn.churn_split(_training(m))))

register("label_distribution", _churn_sql(
    "SELECT churned_early, COUNT(*) AS users FROM training GROUP BY churned_early"))(
    lambda m: churn.label_distribution(_training(m)))

register("segment_survival_means", _churn_sql("""
SELECT ROUND(AVG(survival_days), 6) AS avg_survival_days,
       ROUND(AVG(CASE WHEN user_segment = 'Power User' THEN survival_days END), 6) AS power_avg_survival_days,
       ROUND(AVG(CASE WHEN user_segment = 'New User' THEN survival_days END), 6) AS new_avg_survival_days
FROM training"""))(lambda m: churn.segment_survival_means(_training(m)))

register("classification_report", _churn_sql(REPORT_SELECT, REPORT_SQL))(
    lambda m: metrics.classification_report(churn.rule_score(_training(m))))

register("roc_auc", _churn_sql("""
SELECT ROUND(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS auc
FROM (
  SELECT s, pos, neg,
         COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT CAST(score AS DOUBLE) AS s, SUM(label) AS pos, SUM(1 - label) AS neg
        FROM rule_scored GROUP BY score) g
) c"""))(lambda m: metrics.roc_auc(churn.rule_score(_training(m))))

# The boosted-tree model: trained once per session, parameters and content of its input, and reused by
# the keys below.
_MODELS: dict = {}


def _stored_survival(m):
    """(survival inputs stored once, key of the session, the parameters and the content)."""
    survival_inputs = stored(m.spark, m.survival_inputs, "survival-inputs")
    content = survival_inputs.agg(F.count("*"), F.bit_xor(F.xxhash64(*survival_inputs.columns))).first()
    return survival_inputs, (m.spark.sparkContext.applicationId, m.source, m.params, tuple(content))


def _trained(m):
    survival_inputs, key = _stored_survival(m)
    if key not in _MODELS:
        _MODELS[key] = churn.train_and_score(survival_inputs, m.params.churn_days, m.params.min_reviews)
    return _MODELS[key]


register("churn_predictions")(lambda m: churn.displayed(_trained(m)[1]))
# Whoever is on the hold-out side is scored, with the label that the training set has.
register("churn_scored_users", _churn_sql(
    "SELECT user_id, churned_early AS label FROM held WHERE split = 'test'", HELD_OUT))(
    lambda m: _trained(m)[1].select("user_id", "label"))
register("feature_importance")(lambda m: churn.feature_importance(_trained(m)[0], m.spark))
register("top_feature")(lambda m: churn.top_feature(
    churn.feature_importance(_trained(m)[0], m.spark)))
register("churn_model_report")(lambda m: metrics.classification_report(_trained(m)[1]))
register("churn_model_auc")(lambda m: metrics.roc_auc(_trained(m)[1]))

# The second-order booster: every split, gain and score can be said in SQL.  Scores are those of the whole model, the
# other keys hold its first trees.  The borders are fixed so that both sides cut the features alike.
WHOLE = boosting.Settings()
BOOSTED = boosting.Settings(trees=2)
BORDERS = {"total_reviews": [float(i) for i in range(3, 25)], "avg_stars": [1 + i / 4 for i in range(1, 17)],
           "avg_engagement_score": [i / 2 for i in range(4, 32)], "user_segment_encoded": [1.0, 2.0, 3.0]}
_BOOSTED: dict = {}


def _boosted(m, settings=BOOSTED):
    """(model, encoded training set with its split), fitted once per session, input and settings."""
    survival_inputs, key = _stored_survival(m)
    key += (settings,)
    training = churn.churn_training_set(survival_inputs, m.params.churn_days, m.params.min_reviews)
    data = churn.churn_split(churn.segment_encoding(training))
    if key not in _BOOSTED:
        _BOOSTED[key] = boosting.fit(data.where("split = 'train'"), churn.LABEL, BORDERS, settings)
    return _BOOSTED[key], data


ENCODED = HELD_OUT.replace("FROM training", "FROM (SELECT *, dense_rank() OVER (ORDER BY user_segment) - 1 AS user_segment_encoded FROM training)")


def _boosted_sql(final: str) -> str:
    return _churn_sql(final, ENCODED + ",\n" + boosting.boosting_sql("held", churn.LABEL, BORDERS, BOOSTED))


register("boosting_splits", _boosted_sql("SELECT * FROM splits"))(
    lambda m: _boosted(m)[0].splits(m.spark).withColumn("cover", F.round("cover", 6)))


def _boosted_scores(m, settings=BOOSTED):
    model, data = _boosted(m, settings)
    return model.score(data.where("split = 'test'")).select(
        "user_id", F.col(churn.LABEL).alias("label"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("prediction"))


register("boosting_scores", _churn_sql(
    "SELECT user_id, label, round(1 / (1 + exp(-margin)), 6) AS score FROM margins WHERE split = 'test'",
    ENCODED + ",\n" + boosting.boosting_rounds_sql("held", churn.LABEL, BORDERS, WHOLE)))(
    lambda m: _boosted_scores(m, WHOLE).select("user_id", "label", F.round("score", 6).alias("score")))
register("boosting_importance", _boosted_sql("""
SELECT feature, importance, CAST(rank() OVER (ORDER BY importance DESC) AS INTEGER) AS rank FROM (
  SELECT feature, round(coalesce(mean, 0) / sum(coalesce(mean, 0)) OVER (), 6) AS importance
  FROM (VALUES """ + ", ".join(f"('{f}')" for f in BORDERS) + """) AS known(feature)
  LEFT JOIN (SELECT feature, avg(gain) AS mean FROM splits GROUP BY feature) AS s USING (feature))"""))(
    lambda m: _boosted(m)[0].importance(m.spark))
register("boosting_top_feature", _boosted_sql("""
SELECT feature AS top_feature FROM splits GROUP BY feature ORDER BY avg(gain) DESC LIMIT 1"""))(
    lambda m: churn.top_feature(_boosted(m)[0].importance(m.spark)).select("top_feature"))
register("boosting_auc", _boosted_sql("""
SELECT round(sum((a.margin > b.margin)::INT + (a.margin = b.margin)::INT / 2.0) / count(*), 6) AS auc
FROM (SELECT round(margin, 9) AS margin FROM margins WHERE split = 'test' AND label = 1) AS a,
     (SELECT round(margin, 9) AS margin FROM margins WHERE split = 'test' AND label = 0) AS b"""))(
    lambda m: metrics.roc_auc(_boosted_scores(m).withColumn("score", F.round("score", 9))))


# ------------------------------------------------------------------ datasets
register("overview_kpis", with_models("""
SELECT (SELECT COUNT(*) FROM survival) AS users,
       ROUND((SELECT AVG(CAST(churned AS INT)) FROM survival) * 100, 6) AS churn_rate_pct,
       ROUND((SELECT AVG(survival_days) FROM survival), 6) AS avg_survival_days,
       (SELECT COUNT(*) FROM launch_perf) AS launches"""))(
    lambda m: datasets.overview_kpis(m.survival_inputs, m.launch_performance))

register("cohort_list", with_models("SELECT * FROM cohort_list", CURVE_CTES))(
    lambda m: datasets.cohort_list(m.retention_cohorts, FIXTURE_PARAMS.cohort_lo,
                                   FIXTURE_PARAMS.cohort_hi, MAXM))

register("default_cohorts", with_models("SELECT * FROM default_cohorts", CURVE_CTES))(
    lambda m: datasets.default_cohorts(m.retention_cohorts, FIXTURE_PARAMS.cohort_lo,
                                       FIXTURE_PARAMS.cohort_hi, MAXM))

register("retention_curves", with_models("""
SELECT cohort_month, months_since_joining, retention_rate FROM curve_window
WHERE cohort_month IN (SELECT cohort_month FROM default_cohorts)""", CURVE_CTES))(
    lambda m: datasets.retention_curves(m.retention_cohorts, FIXTURE_PARAMS.cohort_lo,
                                        FIXTURE_PARAMS.cohort_hi, MAXM))

register("month1_by_year", with_models("""
SELECT CAST(year(cohort_month) AS INT) AS cohort_year, CAST(ROUND(AVG(retention_rate), 1) AS DOUBLE) AS avg_month1_retention
FROM retention WHERE months_since_joining = 1 GROUP BY 1 ORDER BY 1"""))(
    lambda m: datasets.month1_by_year(m.retention_cohorts))

register("category_bars", with_models(
    "SELECT category, avg_success_score FROM category_perf ORDER BY avg_success_score, category"))(
    lambda m: datasets.category_bars(m.category_performance))

register("launch_scatter", with_models("""
SELECT name, upvotes, category, traction_tier, success_score, days_since_launch, launch_month
FROM launch_perf ORDER BY upvotes DESC NULLS FIRST, name"""))(
    lambda m: datasets.launch_scatter(m.launch_performance))

register("launch_share", with_models("""
SELECT category, total_launches, ROUND(total_launches * 100.0 / SUM(total_launches) OVER (), 6) AS share_pct
FROM category_perf"""))(lambda m: datasets.launch_share(m.category_performance))

register("top_launches", with_models("""
SELECT name, upvotes, category, traction_tier, success_score
FROM launch_perf ORDER BY upvotes DESC NULLS FIRST, product_url LIMIT 10"""))(
    lambda m: datasets.top_launches(m.launch_performance, FIXTURE_PARAMS.top_n))

