"""Registered marketing / funnel queries (click world)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import channels as ch
from ..operators import funnel as fn
from ..operators import marketing as mk
from .catalog import register
from .oracle_ctes import _div, _pct, avg_exact_sql
from .worlds import ClickWorld


def funnel_rates_sql(source: str, group_cols: str) -> str:
    """SQL oracle of ``funnel_rates`` over a session-level source."""
    steps = [("reached_products", "saw_products"), ("reached_product_page", "saw_product_page"),
             ("reached_cart", "saw_cart"), ("reached_shipping", "saw_shipping"),
             ("reached_billing", "saw_billing_any"), ("reached_thankyou", "converted")]
    pcts = ["pct_to_products", "pct_to_product_page", "pct_to_cart", "pct_to_shipping",
            "pct_to_billing", "pct_to_order"]
    drops = ["dropoff_entry_to_products", "dropoff_products_to_page", "dropoff_page_to_cart",
             "dropoff_cart_to_shipping", "dropoff_shipping_to_billing", "dropoff_billing_to_order"]
    counts = ",\n  ".join(f"CAST(sum(CASE WHEN {f} THEN 1 ELSE 0 END) AS BIGINT) AS {r}" for r, f in steps)
    outer = [f"{_pct(r, 'sessions_entered')} AS {p}" for (r, _), p in zip(steps, pcts)]
    prev = "100.0"
    for (r, _), d in zip(steps, drops):
        cur = _pct(r, "sessions_entered")
        outer.append(f"{prev} - {cur} AS {d}")
        prev = cur
    prev = "sessions_entered"
    for r, _ in steps:
        outer.append(f"{_div(r, prev)} AS step_rate_{r.replace('reached_', '')}")
        prev = r
    return f"""SELECT *, {', '.join(outer)} FROM (
SELECT {group_cols}, count(*) AS sessions_entered,
  {counts}
FROM {source} GROUP BY {group_cols}) t"""


@register("gd3_funnel_rates", funnel_rates_sql(
    "sess JOIN funnel_l USING (website_session_id)", "channel_group, device_type"))
def gd3_funnel_rates(spark, sf_dir):
    """Minimum slice: events -> sessions -> funnel pivot -> join -> rates."""
    w = ClickWorld(spark, sf_dir)
    d = w.sessions.select("website_session_id", "channel_group", "device_type") \
        .join(w.funnel, "website_session_id", "inner")
    return fn.funnel_rates(d, ["channel_group", "device_type"])


@register("gd1_channel_cvr", f"""
SELECT marketing_channel, channel_group, device_type, count(*) AS total_sessions,
  CAST(sum(session_orders) AS BIGINT) AS total_orders,
  CAST(sum(placed_order) AS BIGINT) AS converted_sessions,
  CAST(sum(order_revenue) AS DOUBLE) AS total_gross_revenue,
  CAST(sum(order_margin) AS DOUBLE) AS total_net_margin,
  {_div('sum(total_pageviews_in_session)', 'count(total_pageviews_in_session)')} AS avg_pageviews_per_session,
  {_pct('sum(placed_order)', 'count(*)')} AS conversion_rate_pct,
  {_div('CAST(sum(order_revenue) AS DOUBLE)', 'count(*)')} AS revenue_per_session,
  {_div('CAST(sum(order_margin) AS DOUBLE)', 'count(*)')} AS margin_per_session
FROM swo GROUP BY marketing_channel, channel_group, device_type""")
def gd1_channel_cvr(spark, sf_dir):
    """GD1: channel x device CVR, revenue & margin per session."""
    return mk.channel_cvr(ClickWorld(spark, sf_dir).sessions_with_orders)


@register("gd2_monthly_channel_trends", f"""
SELECT *, {_pct('sessions - sessions_prev_month', 'sessions_prev_month')} AS sessions_mom_pct_chg,
  {_pct('orders - orders_prev_month', 'orders_prev_month')} AS orders_mom_pct_chg
FROM (
  SELECT g.*, p.sessions AS sessions_prev_month, p.orders AS orders_prev_month
  FROM g LEFT JOIN g p
    ON p.marketing_channel = g.marketing_channel AND p.device_type = g.device_type
   AND strptime(p.year_month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH
       = strptime(g.year_month || '-01', '%Y-%m-%d')) t""".replace("FROM (\n  SELECT g.*", "FROM (\n  SELECT g.*", 1))
def gd2_monthly_channel_trends(spark, sf_dir):
    """GD2 + WN5: monthly channel x device series with calendar MoM."""
    return mk.monthly_channel_trends(ClickWorld(spark, sf_dir).sessions_with_orders)


@register("gd4_lander_test", f"""
SELECT entry_page, count(*) AS sessions,
  CAST(sum(CASE WHEN converted THEN 1 ELSE 0 END) AS BIGINT) AS orders,
  CAST(sum(order_revenue) AS DOUBLE) AS total_revenue,
  {_pct('sum(CASE WHEN converted THEN 1 ELSE 0 END)', 'count(*)')} AS cvr_pct,
  {_div('CAST(sum(order_revenue) AS DOUBLE)', 'count(*)')} AS avg_revenue_per_session
FROM swo JOIN entry USING (website_session_id) GROUP BY entry_page""")
def gd4_lander_test(spark, sf_dir):
    """GD4: landing-page A/B by entry page."""
    w = ClickWorld(spark, sf_dir)
    return mk.lander_test(w.entry_pages, w.sessions_with_orders)


BILLING_SQL = f"""
SELECT billing_variant, channel_group, device_type, count(*) AS sessions_at_billing,
  CAST(sum(placed_order) AS BIGINT) AS orders,
  {_pct('sum(placed_order)', 'count(*)')} AS billing_to_order_cvr_pct,
  {_div('CAST(sum(order_revenue) AS DOUBLE)', 'count(*)')} AS avg_revenue_per_session
FROM (SELECT *, CASE WHEN saw_billing_v2 THEN '/billing-2' ELSE '/billing' END AS billing_variant
      FROM swo WHERE saw_billing_any) b
GROUP BY billing_variant, channel_group, device_type"""


@register("gd5_billing_test", BILLING_SQL)
def gd5_billing_test(spark, sf_dir):
    """GD5: billing page A/B among sessions that reached billing."""
    return mk.billing_test(ClickWorld(spark, sf_dir).sessions_with_orders)


@register("gd8_billing_significance", f"""
SELECT channel_group, n_a, n_b, conv_a, conv_b, '/billing' AS variant_a, '/billing-2' AS variant_b,
  rate_a, rate_b, (rate_b - rate_a) * 100.0 AS lift_pp, z_score,
  coalesce(abs(z_score) > 1.96, false) AS significant_95
FROM (
  SELECT *, (rate_b - rate_a) / NULLIF(sqrt(pooled * (1.0 - pooled) * (1.0 / NULLIF(CAST(n_a AS DOUBLE), 0)
         + 1.0 / NULLIF(CAST(n_b AS DOUBLE), 0))), 0) AS z_score
  FROM (
    SELECT *, {_div('conv_a', 'n_a')} AS rate_a, {_div('conv_b', 'n_b')} AS rate_b,
      {_div('conv_a + conv_b', 'n_a + n_b')} AS pooled
    FROM (
      SELECT channel_group,
        CAST(sum(CASE WHEN billing_variant = '/billing' THEN sessions_at_billing END) AS BIGINT) AS n_a,
        CAST(sum(CASE WHEN billing_variant = '/billing-2' THEN sessions_at_billing END) AS BIGINT) AS n_b,
        CAST(sum(CASE WHEN billing_variant = '/billing' THEN orders END) AS BIGINT) AS conv_a,
        CAST(sum(CASE WHEN billing_variant = '/billing-2' THEN orders END) AS BIGINT) AS conv_b
      FROM ({BILLING_SQL}) r GROUP BY channel_group) a) b) c""")
def gd8_billing_significance(spark, sf_dir):
    """GD8: two-proportion z-test of /billing-2 vs /billing per channel group."""
    res = mk.billing_test(ClickWorld(spark, sf_dir).sessions_with_orders)
    return mk.ab_significance(res, "billing_variant", "/billing", "/billing-2",
                              "sessions_at_billing", "orders", ["channel_group"])


def _revenue_sql(group_exprs: str, group_by: str, suffix: str) -> str:
    return f"""
SELECT {group_exprs}, count(order_id) AS orders,
  CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE) AS gross_revenue{suffix},
  CAST(sum(CAST(net_revenue AS DECIMAL(18,4))) AS DOUBLE) AS net_revenue{suffix},
  CAST(sum(CAST(net_margin AS DECIMAL(18,4))) AS DOUBLE) AS net_margin{suffix},
  {avg_exact_sql('gross_margin_pct')} AS avg_gross_margin_pct,
  {avg_exact_sql('net_margin_pct')} AS avg_net_margin_pct,
  CAST(sum(CASE WHEN has_refund THEN 1 ELSE 0 END) AS BIGINT) AS refund_count,
  CAST(sum(CAST(total_refund_usd AS DECIMAL(18,4))) AS DOUBLE) AS total_refunds,
  {_pct('sum(CASE WHEN has_refund THEN 1 ELSE 0 END)', 'count(order_id)')} AS refund_rate_pct,
  {_div('CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE)', 'count(order_id)')} AS avg_order_value
FROM c_orders GROUP BY {group_by}"""


@register("gd6_last_touch_revenue", _revenue_sql(
    "session_channel AS marketing_channel, session_channel_group AS channel_group, "
    "session_device_type AS device_type",
    "session_channel, session_channel_group, session_device_type", "_last_touch"))
def gd6_last_touch_revenue(spark, sf_dir):
    """GD6: last-touch revenue, margin, refund rate, AOV by session channel."""
    return mk.revenue_by_channel(ClickWorld(spark, sf_dir).orders)


@register("gd7_first_touch_revenue", _revenue_sql(
    "acquisition_channel", "acquisition_channel", "_first_touch"))
def gd7_first_touch_revenue(spark, sf_dir):
    """GD7: first-touch revenue by the user's acquisition channel."""
    return mk.revenue_by_channel(ClickWorld(spark, sf_dir).orders,
                                 channel_cols=("acquisition_channel",),
                                 rename=("acquisition_channel",), suffix="_first_touch")


@register("se3_funnel_unpivoted", """
SELECT channel_group, device_type, funnel_step, sessions_remaining, pct_remaining, step_order
FROM (""" + funnel_rates_sql("sess JOIN funnel_l USING (website_session_id)",
                             "channel_group, device_type") + """) f,
LATERAL (VALUES
  ('Sessions entered', CAST(sessions_entered AS DOUBLE), 100.0, CAST(1 AS BIGINT)),
  ('Reached products', CAST(reached_products AS DOUBLE), pct_to_products, 2),
  ('Viewed product page', CAST(reached_product_page AS DOUBLE), pct_to_product_page, 3),
  ('Added to cart', CAST(reached_cart AS DOUBLE), pct_to_cart, 4),
  ('Reached shipping', CAST(reached_shipping AS DOUBLE), pct_to_shipping, 5),
  ('Reached billing', CAST(reached_billing AS DOUBLE), pct_to_billing, 6),
  ('Placed order', CAST(reached_thankyou AS DOUBLE), pct_to_order, 7)
) v(funnel_step, sessions_remaining, pct_remaining, step_order)""")
def se3_funnel_unpivoted(spark, sf_dir):
    """SE3: funnel rates unpivoted with stack(7, ...)."""
    return fn.unpivot_funnel(gd3_funnel_rates(spark, sf_dir))


@register("prj19_channel_display", """
SELECT marketing_channel, CASE marketing_channel
    WHEN 'paid_search_gsearch_nonbrand' THEN 'Paid Search - gsearch'
    WHEN 'paid_search_gsearch_brand' THEN 'Paid Search - Brand'
    WHEN 'paid_social_bsearch' THEN 'Paid Social - bsearch'
    WHEN 'direct' THEN 'Direct' WHEN 'organic_search' THEN 'Organic Search'
    ELSE replace(replace(marketing_channel, '_', ' '), 'paid search', 'Paid Search') END AS channel_display,
  count(*) AS sessions
FROM sess GROUP BY marketing_channel""")
def prj19_channel_display(spark, sf_dir):
    """PRJ19: dashboard display name per channel."""
    s = ClickWorld(spark, sf_dir).sessions
    return (s.groupBy("marketing_channel").agg(F.count(F.lit(1)).alias("sessions"))
            .withColumn("channel_display", ch.display_name("marketing_channel")))
