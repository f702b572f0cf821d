"""Registered product queries (commerce world: brands as products)."""

from __future__ import annotations

from ..operators import products as pr
from .catalog import register
from .oracle_ctes import (_div, _pct, avg_exact_sql, avg_money_sql, count_true_sql,
                          prev_month_sql, sum_money_sql)
from .worlds import CommerceWorld

PM_AGG = f"""
SELECT strftime(order_ts, '%Y-%m') AS year_month, order_year, order_month, primary_product_id,
  primary_product_name, count(order_id) AS orders, CAST(sum(items_purchased) AS BIGINT) AS items_sold,
  {sum_money_sql('gross_revenue')} AS gross_revenue, {sum_money_sql('gross_cogs')} AS total_cogs,
  {sum_money_sql('gross_margin')} AS gross_margin, {avg_exact_sql('gross_margin_pct')} AS avg_gross_margin_pct,
  {sum_money_sql('total_refund_usd')} AS total_refunds, {count_true_sql('has_refund')} AS refunded_orders,
  {sum_money_sql('net_revenue')} AS net_revenue, {sum_money_sql('net_margin')} AS net_margin,
  {avg_exact_sql('net_margin_pct')} AS avg_net_margin_pct,
  {count_true_sql('is_cross_sell_order')} AS cross_sell_orders
FROM m_orders GROUP BY ALL"""


@register("gd9_product_monthly", f"""
WITH pm AS ({PM_AGG})
SELECT *, {_pct('refunded_orders', 'orders')} AS refund_rate_pct,
  {_pct('cross_sell_orders', 'orders')} AS cross_sell_rate_pct,
  {_pct('gross_revenue - gross_revenue_prev_month', 'gross_revenue_prev_month')} AS revenue_mom_pct
FROM ({prev_month_sql('pm', ['primary_product_id'], ['gross_revenue'])}) t""")
def gd9_product_monthly(spark, sf_dir):
    """GD9 + WN6: product x month P&L with calendar MoM revenue change."""
    return pr.product_monthly(CommerceWorld(spark, sf_dir).orders)


@register("gd10_launch_impact", f"""
SELECT primary_product_name, launch_period, count(order_id) AS orders,
  {sum_money_sql('gross_revenue')} AS gross_revenue, {avg_exact_sql('gross_margin_pct')} AS avg_margin_pct,
  {count_true_sql('has_refund')} AS refunded_orders,
  {_pct(count_true_sql('has_refund'), 'count(order_id)')} AS refund_rate_pct
FROM (SELECT *, CASE WHEN months_after_product_launch IS NULL OR months_after_product_launch < 0 THEN NULL
    WHEN months_after_product_launch <= 0 THEN 'M00' WHEN months_after_product_launch <= 2 THEN 'M01-02'
    WHEN months_after_product_launch <= 5 THEN 'M03-05' WHEN months_after_product_launch <= 11 THEN 'M06-11'
    WHEN months_after_product_launch <= 23 THEN 'M12-23' ELSE 'M24+' END AS launch_period
  FROM m_orders WHERE primary_product_id IS NOT NULL) t
GROUP BY primary_product_name, launch_period""")
def gd10_launch_impact(spark, sf_dir):
    """GD10: sales by months since product launch."""
    return pr.launch_impact(CommerceWorld(spark, sf_dir).orders)


@register("gd11_cross_sell_matrix", f"""
SELECT primary_product_name, cross_sell_product_name, cross_sell_orders, total_order_revenue,
  avg_margin_pct, total_orders_for_product,
  {_div('total_order_revenue', 'cross_sell_orders')} AS avg_order_value,
  {_pct('cross_sell_orders', 'total_orders_for_product')} AS attach_rate_pct
FROM (
  SELECT o.primary_product_name, p.product_name AS cross_sell_product_name,
    count(o.order_id) AS cross_sell_orders, {sum_money_sql('o.gross_revenue')} AS total_order_revenue,
    {avg_exact_sql('o.gross_margin_pct')} AS avg_margin_pct, max(t.n) AS total_orders_for_product
  FROM m_orders o
  LEFT JOIN m_products p ON o.cross_sell_product_id = p.product_id
  LEFT JOIN (SELECT primary_product_name, count(*) AS n FROM m_orders GROUP BY 1) t
    ON o.primary_product_name IS NOT DISTINCT FROM t.primary_product_name
  WHERE o.cross_sell_product_id IS NOT NULL
  GROUP BY o.primary_product_name, o.cross_sell_product_id, p.product_name) x""")
def gd11_cross_sell_matrix(spark, sf_dir):
    """GD11 + JN11: cross-sell pairs with attach rate."""
    w = CommerceWorld(spark, sf_dir)
    return pr.cross_sell_matrix(w.orders, w.products)


@register("gd12_refund_analysis", f"""
SELECT strftime(item_ts, '%Y-%m') AS year_month, product_name, count(*) AS items_sold,
  {count_true_sql('is_refunded')} AS items_refunded, {sum_money_sql('item_refund_usd')} AS total_refund_usd,
  {avg_money_sql('price_usd')} AS avg_sale_price, {sum_money_sql('item_net_revenue')} AS net_revenue,
  {sum_money_sql('item_net_margin')} AS net_margin,
  {_pct(count_true_sql('is_refunded'), 'count(*)')} AS item_refund_rate_pct
FROM m_items GROUP BY 1, 2""")
def gd12_refund_analysis(spark, sf_dir):
    """GD12: item refunds by product x month."""
    return pr.refund_analysis(CommerceWorld(spark, sf_dir).items_enriched)


@register("gd13_days_to_refund", f"""
SELECT primary_product_name, count(order_id) AS refunded_orders,
  {_div('sum(days_to_refund)', 'count(days_to_refund)')} AS avg_days_to_refund,
  min(days_to_refund) AS min_days_to_refund, max(days_to_refund) AS max_days_to_refund,
  {sum_money_sql('total_refund_usd')} AS total_refund_value
FROM m_orders WHERE has_refund GROUP BY primary_product_name""")
def gd13_days_to_refund(spark, sf_dir):
    """GD13: days-to-refund statistics per product."""
    return pr.days_to_refund_stats(CommerceWorld(spark, sf_dir).orders)


@register("gd14_product_channel_mix", f"""
SELECT *, CAST(sum(orders) OVER (PARTITION BY primary_product_name) AS BIGINT) AS product_total_orders,
  {_pct('orders', 'sum(orders) OVER (PARTITION BY primary_product_name)')} AS channel_order_share_pct
FROM (SELECT primary_product_name, session_channel, session_channel_group, session_device_type,
        count(order_id) AS orders, {sum_money_sql('gross_revenue')} AS gross_revenue,
        {sum_money_sql('net_margin')} AS net_margin, {avg_exact_sql('gross_margin_pct')} AS avg_margin_pct,
        {count_true_sql('has_refund')} AS refund_count
      FROM m_orders WHERE primary_product_name IS NOT NULL GROUP BY ALL) g""")
def gd14_product_channel_mix(spark, sf_dir):
    """GD14 + JN11: product x channel mix with share within product."""
    return pr.product_channel_mix(CommerceWorld(spark, sf_dir).orders)
