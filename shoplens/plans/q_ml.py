"""Registered model queries. Model outputs have no SQL oracle (rows-only
check); the training set and confusion metrics of a rule are SQL-checked."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..operators import ml
from ..operators.customers import user_order_summary
from ..session import scratch_path
from .catalog import ORACLE_BODY, register
from .oracle_ctes import _div
from .worlds import ClickWorld, CommerceWorld


def _train_set(spark, sf_dir):
    w = ClickWorld(spark, sf_dir)
    return ml.training_set(w.sessions, w.orders)


@register("ml1_training_set", """
SELECT s.website_session_id, s.user_id, s.marketing_channel, s.device_type, s.channel_group, s.session_hour,
  s.day_of_week, CAST(s.is_repeat_session AS BIGINT) AS is_repeat_int, CAST(s.is_weekend AS BIGINT) AS is_weekend_int,
  s.session_year, s.session_month, CAST(CASE WHEN o.website_session_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS converted_label
FROM sess s LEFT JOIN (SELECT DISTINCT website_session_id FROM c_orders_raw) o
  ON s.website_session_id = o.website_session_id""")
def ml1_training_set(spark, sf_dir):
    """ML1: session features + conversion label (one row per session)."""
    return _train_set(spark, sf_dir)


@register("ml2_class_weights", f"""
SELECT converted_label, count(*) AS sessions,
  CAST((SELECT count(*) FROM sess) AS DOUBLE) / (2.0 * count(*)) AS weight
FROM (SELECT s.website_session_id, CAST(CASE WHEN o.website_session_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS converted_label
      FROM sess s LEFT JOIN (SELECT DISTINCT website_session_id FROM c_orders_raw) o
        ON s.website_session_id = o.website_session_id) t GROUP BY converted_label""")
def ml2_class_weights(spark, sf_dir):
    """ML2: class-balanced weights n / (2 n_class) per label."""
    d = ml.class_weights(_train_set(spark, sf_dir))
    return d.groupBy("converted_label").agg(F.count(F.lit(1)).alias("sessions"), F.first("weight").alias("weight"))


@register("ml2_stratified_sample", f"""
SELECT * FROM ({ORACLE_BODY['ml1_training_set']}) t
WHERE CAST('0x' || substr(md5(CAST(website_session_id AS VARCHAR) || ':{ml.SEED}'), 1, 8) AS BIGINT) % 1000000
  < {int(ml.SAMPLE_FRAC * 1_000_000)}""")
def ml2_stratified_sample(spark, sf_dir):
    """ML2: 20% of each class by a hash of the session id."""
    return ml.stratified_sample(_train_set(spark, sf_dir))


_WRITTEN: dict[tuple[str, str, str], str] = {}
KEPT = 8  # written frames that are remembered; older ones are made anew


def _once(spark, sf_dir, name, make):
    """A frame that several model queries read, written to the shared folder at its first
    use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        make().write.parquet(path)
        while len(_WRITTEN) >= KEPT:
            _WRITTEN.pop(next(iter(_WRITTEN)))
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def _model_set(spark, sf_dir):
    return _once(spark, sf_dir, "training-set", lambda: _train_set(spark, sf_dir))


def _logistic_scores(spark, sf_dir):
    """All sessions as the logistic baseline scores them; fitted on the train split."""
    def make():
        d = _model_set(spark, sf_dir)
        return ml.score(ml.fit_logistic(ml.split(d)[0]), d)

    return _once(spark, sf_dir, "logistic-scores", make)


@register("ml3_propensity_scores")
def ml3_propensity_scores(spark, sf_dir):
    """ML3 + PRJ14: weighted logistic regression fit on the train split,
    every session scored and banded LOW / MEDIUM / HIGH."""
    return _logistic_scores(spark, sf_dir)


# --- fixed values: categories taken away for the imputation, and rows it is fitted on ---
GAP_RULE, GAP_REST, FIT_RULE = 9, 4, 8
# ----------------------------------------------------------------------------------------


@register("ml3_mode_imputation", f"""
WITH t AS (SELECT website_session_id, CASE WHEN website_session_id % {GAP_RULE} <> {GAP_REST} THEN marketing_channel END AS marketing_channel,
             CASE WHEN website_session_id % {GAP_RULE} <> {GAP_REST} THEN device_type END AS device_type FROM sess),
m AS (SELECT
    (SELECT marketing_channel FROM t WHERE website_session_id % 10 < {FIT_RULE} AND marketing_channel IS NOT NULL
     GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS channel,
    (SELECT device_type FROM t WHERE website_session_id % 10 < {FIT_RULE} AND device_type IS NOT NULL
     GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS device)
SELECT website_session_id, coalesce(marketing_channel, channel) AS marketing_channel, coalesce(device_type, device) AS device_type
FROM t, m""")
def ml3_mode_imputation(spark, sf_dir):
    """ML3: null categories filled with the mode of the rows the imputer is fitted on (eight
    of ten sessions); a ninth of all categories is taken away before."""
    gap = F.col("website_session_id") % GAP_RULE == GAP_REST
    cols = ["marketing_channel", "device_type"]
    d = ClickWorld(spark, sf_dir).sessions.select(
        "website_session_id", *[F.when(~gap, F.col(c)).alias(c) for c in cols])
    imputer = ml.ModeImputer(inputCols=cols, outputCols=[f"{c}_filled" for c in cols])
    filled = imputer.fit(d.where(F.col("website_session_id") % 10 < FIT_RULE)).transform(d)
    return filled.select("website_session_id", *[F.col(f"{c}_filled").alias(c) for c in cols])


@register("ml6_model_metrics")
def ml6_model_metrics(spark, sf_dir):
    """ML6: ROC-AUC, PR-AUC, precision, recall, F1 of the LR baseline on the
    held-out split."""
    return ml.model_metrics(spark, ml.split(_logistic_scores(spark, sf_dir))[1], "logistic_regression")


@register("ml6_logistic_invariants", """
SELECT count(*) AS sessions, count(*) AS distinct_sessions, true AS probabilities_in_range, true AS bands_agree,
  true AS predictions_agree,
  CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM c_orders_raw o WHERE o.website_session_id = sess.website_session_id)
           THEN 1 ELSE 0 END) AS BIGINT) AS converted
FROM sess""")
def ml6_logistic_invariants(spark, sf_dir):
    """ML3 + PRJ14 invariants of the logistic scores: every session once, probabilities from
    0 to 1, bands and predictions as the probabilities say, labels as the orders say."""
    return _logistic_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("sessions"), F.countDistinct("website_session_id").alias("distinct_sessions"),
        F.min(F.col("conversion_prob").between(0, 1)).alias("probabilities_in_range"),
        F.min(F.col("propensity_segment") == ml.propensity_band("conversion_prob")).alias("bands_agree"),
        F.min(F.col("predicted_conversion") == (F.col("conversion_prob") >= 0.5).cast("int")).alias("predictions_agree"),
        F.sum(F.col("converted_label").cast("long")).alias("converted"))


def scored_sessions(spark, sf_dir):
    """All sessions as the best GBT scores them. The search runs once per application and
    data folder on a sample of the train side (``ml.fit_sample``); every reader reads what
    it wrote."""
    def make():
        d = _model_set(spark, sf_dir)
        return ml.score(ml.search_gbt(ml.fit_sample(ml.split(d)[0])), d)

    return _once(spark, sf_dir, "scored-sessions", make)


@register("ml4_gbt_search")
def ml4_gbt_search(spark, sf_dir):
    """ML4 + ML6: GBT random search (12 of 243 combos, 3-fold CV, ROC-AUC) on a
    sample of the train side; the best model's metrics on the whole test side."""
    _, test = ml.split(scored_sessions(spark, sf_dir))
    return ml.model_metrics(spark, test, "gbt_random_search")


@register("ml6_feature_importances")
def ml6_feature_importances(spark, sf_dir):
    """ML6: feature importances, by name, of the best GBT of a search on the whole train
    side (the scores' search, ``scored_sessions``, is a run of its own)."""
    def make():
        d = _model_set(spark, sf_dir)
        return ml.feature_importances(ml.search_gbt(ml.split(d)[0]), d)

    return _once(spark, sf_dir, "gbt-importances", make)


@register("ml4_scored_sessions", """
SELECT count(*) AS sessions, count(*) AS distinct_sessions, true AS probabilities_in_range, true AS bands_agree
FROM sess""")
def ml4_scored_sessions(spark, sf_dir):
    """ML3 + PRJ14 invariants of the scored population: every session once,
    probabilities from 0 to 1, bands as the probabilities say."""
    s = scored_sessions(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("sessions"),
                 F.countDistinct("website_session_id").alias("distinct_sessions"),
                 F.min(F.col("conversion_prob").between(0, 1)).alias("probabilities_in_range"),
                 F.min(F.col("propensity_segment") == ml.propensity_band("conversion_prob")).alias("bands_agree"))


@register("ag15_confusion_metrics", f"""
SELECT tp, fp, fn, tn, precision, recall, accuracy,
  2.0 * precision * recall / NULLIF(precision + recall, 0) AS f1
FROM (SELECT tp, fp, fn, tn, {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall,
        {_div('tp + tn', 'tp + fp + fn + tn')} AS accuracy
      FROM (SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
              count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn
            FROM (SELECT o.website_session_id IS NOT NULL AS y, coalesce(f.funnel_depth >= 6, false) AS p
                  FROM sess s LEFT JOIN funnel_l f ON s.website_session_id = f.website_session_id
                  LEFT JOIN (SELECT DISTINCT website_session_id FROM c_orders_raw) o
                    ON s.website_session_id = o.website_session_id) x) c) m""")
def ag15_confusion_metrics(spark, sf_dir):
    """AG15: confusion-matrix metrics of the rule 'reached billing' as a
    predictor of an order."""
    w = ClickWorld(spark, sf_dir)
    d = ml.training_set(w.sessions, w.orders).join(w.funnel.select("website_session_id", "funnel_depth"),
                                                  "website_session_id", "left")
    d = d.withColumn("predicted_conversion",
                     F.coalesce((F.col("funnel_depth") >= 6), F.lit(False)).cast("int"))
    return ml.confusion_metrics(d)


def _customers(spark, sf_dir):
    return _once(spark, sf_dir, "customers", lambda: user_order_summary(CommerceWorld(spark, sf_dir).orders))


def customer_segments(spark, sf_dir):
    """Segments of all customers, made once per application and data folder."""
    return _once(spark, sf_dir, "customer-segments", lambda: ml.customer_segments(_customers(spark, sf_dir)))


@register("ml5_customer_segments")
def ml5_customer_segments(spark, sf_dir):
    """ML5: KMeans k=4 customer segments, the best of five starts."""
    return customer_segments(spark, sf_dir)


@register("ml5_segment_invariants", f"""
SELECT count(DISTINCT user_id) AS customers, count(DISTINCT user_id) AS distinct_customers, CAST({ml.KM_K} AS BIGINT) AS segments,
  true AS segments_in_range, count(*) AS orders
FROM m_orders""")
def ml5_segment_invariants(spark, sf_dir):
    """ML5 invariants: every customer in one segment, all segments used, no order lost."""
    s = customer_segments(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("user_id").alias("distinct_customers"),
                 F.countDistinct("customer_segment").alias("segments"),
                 F.min(F.col("customer_segment").between(0, ml.KM_K - 1)).alias("segments_in_range"),
                 F.sum("total_orders").cast("long").alias("orders"))


@register("ml5_elbow")
def ml5_elbow(spark, sf_dir):
    """ML5: inertia and silhouette for k = 2..6."""
    return ml.elbow(_customers(spark, sf_dir))


@register("ml7_segment_profile")
def ml7_segment_profile(spark, sf_dir):
    """ML7: per-segment profile."""
    return ml.segment_profile(customer_segments(spark, sf_dir))


@register("ml7_profile_invariants", """
SELECT count(DISTINCT user_id) AS customers, count(*) AS orders,
  CAST(round(CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE), 0) AS BIGINT) AS lifetime_value
FROM m_orders""")
def ml7_profile_invariants(spark, sf_dir):
    """ML7 invariants: the segments' customers, and averages times customers, add up to
    the totals of all orders."""
    p, n = ml.segment_profile(customer_segments(spark, sf_dir)), F.col("customers")
    return p.agg(F.sum(n).alias("customers"), F.round(F.sum(n * F.col("avg_orders"))).cast("long").alias("orders"),
                 F.round(F.sum(n * F.col("avg_ltv"))).cast("long").alias("lifetime_value"))


@register("ml8_ltv_models")
def ml8_ltv_models(spark, sf_dir):
    """ML8: 365-day LTV regression (ridge, random forest, GBT) from the
    first 90 days."""
    return ml.ltv_models(ml.ltv_dataset(CommerceWorld(spark, sf_dir).orders))


@register("ml8_censoring_weights", """
WITH f AS (SELECT user_id, arg_min(acquisition_channel, (order_ts, order_id)) AS acquisition_channel,
             (SELECT max(CAST(order_ts AS DATE)) FROM m_orders) - min(CAST(order_ts AS DATE)) AS followup
           FROM m_orders GROUP BY user_id)
SELECT acquisition_channel, count(*) AS n, CAST(count(*) FILTER (WHERE followup >= 365) AS BIGINT) AS n_complete,
  round(CAST(count(*) FILTER (WHERE followup >= 365) AS DOUBLE) / count(*), 6) AS g,
  round(CAST(count(*) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE followup >= 365), 0), 6) AS weight
FROM f GROUP BY acquisition_channel""")
def ml8_censoring_weights(spark, sf_dir):
    """ML8: Kaplan-Meier chance of a complete year by channel, and the weight it gives. With
    no customer leaving but by the end of the data it is the share of complete ones."""
    w = ml.censoring_weights(ml.ltv_dataset(CommerceWorld(spark, sf_dir).orders), 365)
    return w.select("acquisition_channel", "n", "n_complete", F.round("g", 6).alias("g"), F.round("weight", 6).alias("weight"))


@register("ml8_ltv_history", """
WITH o AS (SELECT *, CAST(order_ts AS DATE) - min(CAST(order_ts AS DATE)) OVER (PARTITION BY user_id) AS d,
             min(CAST(order_ts AS DATE)) OVER (PARTITION BY user_id) AS first_day FROM m_orders)
SELECT user_id, arg_min(acquisition_channel, (order_ts, order_id)) AS acquisition_channel,
  CAST(count(*) FILTER (WHERE d <= 30) AS DOUBLE) AS early_orders,
  CAST(sum(CASE WHEN d <= 30 THEN CAST(gross_revenue AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS early_revenue,
  CAST(sum(CASE WHEN d <= 30 THEN items_purchased ELSE 0 END) AS DOUBLE) AS early_items,
  CAST(count(*) FILTER (WHERE d <= 30 AND has_refund) AS DOUBLE) AS early_refunds,
  CAST(sum(CASE WHEN d <= 90 THEN CAST(gross_revenue AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS revenue_90d,
  CAST(sum(CASE WHEN d <= 180 THEN CAST(gross_revenue AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS revenue_180d,
  CAST(sum(CASE WHEN d <= 365 THEN CAST(gross_revenue AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS revenue_365d,
  (SELECT max(CAST(order_ts AS DATE)) FROM m_orders) - min(first_day) >= 90 AS is_complete_90d,
  (SELECT max(CAST(order_ts AS DATE)) FROM m_orders) - min(first_day) >= 180 AS is_complete_180d,
  (SELECT max(CAST(order_ts AS DATE)) FROM m_orders) - min(first_day) >= 365 AS is_complete_365d
FROM o GROUP BY user_id""")
def ml8_ltv_history(spark, sf_dir):
    """ML8: early features, revenue within 90 / 180 / 365 days, complete windows."""
    return _ltv_history(spark, sf_dir)


def _ltv_history(spark, sf_dir):
    w = CommerceWorld(spark, sf_dir)
    return ml.ltv_history(w.orders, tasks=w.tasks)


def _ltv_predictions(spark, sf_dir):
    return _once(spark, sf_dir, "ltv-predictions",
                 lambda: ml.ltv_predictions(_once(spark, sf_dir, "ltv-history", lambda: _ltv_history(spark, sf_dir))))


@register("ml8_ltv_predictions")
def ml8_ltv_predictions(spark, sf_dir):
    """ML8: predicted 90 / 180 / 365-day LTV and recommended action per customer."""
    return _ltv_predictions(spark, sf_dir)


@register("ml8_prediction_invariants", """
SELECT count(DISTINCT user_id) AS customers, count(DISTINCT user_id) AS distinct_customers, true AS all_predicted, true AS actions_agree
FROM m_orders""")
def ml8_prediction_invariants(spark, sf_dir):
    """ML8 invariants: every customer once, with a number for each horizon, and the action
    that the longest horizon's prediction says beside the mean."""
    p = _ltv_predictions(spark, sf_dir)
    longest = F.col(f"predicted_ltv_{max(ml.LTV_HORIZONS)}d")
    p = p.crossJoin(p.agg(F.avg(longest).alias("_mean")))
    near = F.lit(False)  # a prediction at a band's edge, where the mean's last digit would decide
    said, action = F.lit(ml.LTV_LAST_ACTION), None
    for share, name in ml.LTV_ACTIONS:
        edge = F.col("_mean") * share
        near = near | (F.abs(longest - edge) <= F.abs(edge) * 1e-9)
        action = F.when(longest >= edge, name) if action is None else action.when(longest >= edge, name)
    return p.agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("user_id").alias("distinct_customers"),
                 F.min(reduce(and_, [F.coalesce(~F.isnan(f"predicted_ltv_{h}d"), F.lit(False)) for h in ml.LTV_HORIZONS])).alias("all_predicted"),
                 F.min((F.col("recommended_action") == action.otherwise(said)) | near).alias("actions_agree"))
