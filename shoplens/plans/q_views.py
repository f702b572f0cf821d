"""Registered GD33 semantic views."""

from __future__ import annotations

from . import dashboards as db
from .catalog import ORACLE_BODY, QUERIES, register

_cvr = ORACLE_BODY["gd1_channel_cvr"]
_rev = ORACLE_BODY["gd6_last_touch_revenue"]


@register("gd33_marketing_360", f"""
SELECT c.*, r.orders AS attributed_orders, r.net_revenue_last_touch, r.refund_rate_pct, r.avg_order_value
FROM ({_cvr}) c LEFT JOIN ({_rev}) r
  ON c.marketing_channel IS NOT DISTINCT FROM r.marketing_channel
 AND c.device_type IS NOT DISTINCT FROM r.device_type""")
def gd33_marketing_360(spark, sf_dir):
    """GD33: marketing 360 view (GD1 + GD6)."""
    return db.marketing_360(spark, sf_dir)


@register("gd33_product_360", f"""
SELECT p.*, r.items_sold AS line_items_sold, r.items_refunded, r.item_refund_rate_pct
FROM ({ORACLE_BODY['gd9_product_monthly']}) p
LEFT JOIN ({ORACLE_BODY['gd12_refund_analysis']}) r
  ON p.year_month = r.year_month AND p.primary_product_name = r.product_name""")
def gd33_product_360(spark, sf_dir):
    """GD33: product 360 view (GD9 + GD12)."""
    return db.product_360(spark, sf_dir)


@register("gd33_customer_360", f"""
SELECT u.*, r.recency_days, r.avg_days_between_orders, r.recency_score, r.frequency_score, r.monetary_score,
  r.recency_score + r.frequency_score + r.monetary_score AS rfm_score
FROM ({ORACLE_BODY['gd15_user_order_summary']}) u LEFT JOIN ({ORACLE_BODY['gd32_rfm']}) r ON u.user_id = r.user_id""")
def gd33_customer_360(spark, sf_dir):
    """GD33: customer 360 view (GD15 + GD32)."""
    return db.customer_360(spark, sf_dir)


@register("gd33_executive_scorecard", f"""
SELECT s.*, i.pct_change AS revenue_change_pct, i.annotation_label, i.direction
FROM ({ORACLE_BODY['gd26_executive_scorecard']}) s
LEFT JOIN ({ORACLE_BODY['gd29_revenue_inflections']}) i ON i.year_month = s.score_month""")
def gd33_executive_scorecard(spark, sf_dir):
    """GD33: executive scorecard view (GD26 + GD29)."""
    return db.scorecard_360(spark, sf_dir)


@register("prj20_filtered_cohorts", f"""
SELECT * FROM ({ORACLE_BODY['gd17_acquisition_cohorts']}) c WHERE acquisition_cohort IN ('1995-03', '1996-07')""")
def prj20_filtered_cohorts(spark, sf_dir):
    """PRJ20: the global month filter bound to the cohorts; channel and device aren't bound
    to them and leave them alone."""
    return db.apply_filters(QUERIES["gd17_acquisition_cohorts"](spark, sf_dir), "acquisition_cohorts",
                            {"month": ["1995-03", "1996-07"], "channel": ["none"], "device": ["none"]})
