"""Dashboard layer: gold tables as session temp views (GD33 semantic views
included), dashboard statements as SQL over them, global filters (PRJ20).

``gold_views`` registers lazy DataFrames only; a statement runs when the
caller acts on it. The statements are plain SQL so the same text runs in
Spark SQL and, for the oracle, in DuckDB over the oracle's gold tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import customers as cu
from ..operators import kpis as kp
from ..operators import marketing as mk
from ..operators import products as pr
from .worlds import ClickWorld, CommerceWorld

# gold table name -> registered query that builds it
GOLD_TABLES = {
    "channel_conversion_rates": "gd1_channel_cvr",
    "monthly_channel_trends": "gd2_monthly_channel_trends",
    "funnel_step_analysis": "gd3_funnel_rates",
    "ab_lander_test_results": "gd4_lander_test",
    "billing_ab_test_results": "gd5_billing_test",
    "channel_revenue_roi": "gd6_last_touch_revenue",
    "product_monthly_performance": "gd9_product_monthly",
    "product_launch_impact": "gd10_launch_impact",
    "cross_sell_matrix": "gd11_cross_sell_matrix",
    "refund_analysis": "gd12_refund_analysis",
    "product_channel_mix": "gd14_product_channel_mix",
    "user_order_summary": "gd15_user_order_summary",
    "acquisition_cohorts": "gd17_acquisition_cohorts",
    "repeat_session_analysis": "gd19_repeat_session_analysis",
    "ltv_by_acquisition_channel": "gd20_ltv_by_channel",
    "executive_kpis": "gd21_executive_kpis",
    "executive_scorecard": "gd26_executive_scorecard",
    "channel_efficiency_matrix": "gd27_channel_efficiency",
}


def gold_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register gold tables (lazy) as temp views for dashboard SQL."""
    from .catalog import QUERIES
    for view, q in GOLD_TABLES.items():
        if names is None or view in names:
            QUERIES[q](spark, sf_dir).createOrReplaceTempView(view)


# --- fixed values: global filter bindings (filter -> column per dataset) ----
FILTER_BINDINGS = {
    "monthly_channel_trends": {"month": "year_month", "channel": "marketing_channel",
                               "device": "device_type"},
    "channel_conversion_rates": {"channel": "marketing_channel", "device": "device_type"},
    "funnel_step_analysis": {"device": "device_type"},
    "billing_ab_test_results": {"device": "device_type"},
    "product_monthly_performance": {"month": "year_month", "product": "primary_product_name"},
    "refund_analysis": {"month": "year_month", "product": "product_name"},
    "user_order_summary": {"tier": "customer_tier", "channel": "acquisition_channel"},
    "ltv_by_acquisition_channel": {"channel": "acquisition_channel"},
    "acquisition_cohorts": {"month": "acquisition_cohort"},
    "session_conversion_predictions": {"channel": "marketing_channel", "device": "device_type"},
}
# ----------------------------------------------------------------------------


def apply_filters(df: DataFrame, dataset: str, filters: dict) -> DataFrame:
    """PRJ20: apply dashboard-wide filters only where the dataset binds them
    (unbound filters leave the dataset untouched)."""
    bind = FILTER_BINDINGS.get(dataset, {})
    for name, values in filters.items():
        if name in bind and values:
            df = df.filter(F.col(bind[name]).isin(*values))
    return df


def marketing_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD33: channel x device CVR (GD1) beside last-touch revenue (GD6)."""
    w = ClickWorld(spark, sf_dir)
    cvr = mk.channel_cvr(w.sessions_with_orders)
    rev = mk.revenue_by_channel(w.orders).select(
        "marketing_channel", "device_type", F.col("orders").alias("attributed_orders"),
        "net_revenue_last_touch", "refund_rate_pct", "avg_order_value")
    return cvr.join(rev, [cvr.marketing_channel.eqNullSafe(rev.marketing_channel),
                          cvr.device_type.eqNullSafe(rev.device_type)], "left") \
        .drop(rev.marketing_channel).drop(rev.device_type)


def product_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD33: product x month P&L (GD9) beside item refunds (GD12)."""
    m = CommerceWorld(spark, sf_dir)
    pm = pr.product_monthly(m.orders)
    rf = pr.refund_analysis(m.items_enriched).select(
        "year_month", F.col("product_name").alias("primary_product_name"),
        F.col("items_sold").alias("line_items_sold"), "items_refunded", "item_refund_rate_pct")
    return pm.join(rf, ["year_month", "primary_product_name"], "left")


def customer_360(spark: SparkSession, sf_dir: str, segments: DataFrame | None = None) -> DataFrame:
    """GD33: a row per customer: order summary and tier (GD15) beside recency, frequency
    and value scores (GD32), and the model's segment (ML5) where ``segments`` is given."""
    orders = CommerceWorld(spark, sf_dir).orders
    rfm = cu.rfm(orders).select("user_id", "recency_days", "avg_days_between_orders", "recency_score",
                                "frequency_score", "monetary_score")
    out = cu.user_order_summary(orders).join(rfm, "user_id", "left")
    out = out.withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
    if segments is not None:
        out = out.join(segments.select("user_id", "customer_segment"), "user_id", "left")
    return out


def scorecard_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD33: the monthly scorecard (GD26) beside the month's revenue turn (GD29)."""
    orders = CommerceWorld(spark, sf_dir).orders
    card = kp.executive_scorecard(kp.monthly_metrics(orders, ClickWorld(spark, sf_dir).visits))
    turns = kp.revenue_inflections(kp.monthly_revenue(orders)).select(
        F.col("year_month").alias("score_month"), F.col("pct_change").alias("revenue_change_pct"), "annotation_label", "direction")
    return card.join(turns, "score_month", "left")
