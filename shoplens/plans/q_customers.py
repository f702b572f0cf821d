"""Registered customer queries (users = customers for orders, visitors for
sessions)."""

from __future__ import annotations

from ..operators import customers as cu
from .catalog import register
from .oracle_ctes import (CTES, _div, _pct, avg_exact_sql, avg_money_sql, count_true_sql,
                          sum_money_sql)
from .worlds import ClickWorld, CommerceWorld


def _user_summary_sql(orders: str) -> str:
    return f"""
SELECT *, CAST(last_order_ts AS DATE) - CAST(first_order_ts AS DATE) AS days_since_first_order,
  total_orders > 1 AS is_repeat_buyer,
  CASE WHEN gross_lifetime_value >= 100 THEN 'High Value' WHEN gross_lifetime_value >= 50 THEN 'Mid Value'
       ELSE 'Single Purchase' END AS customer_tier,
  {_pct('orders_with_refund', 'total_orders')} AS refund_rate_pct
FROM (SELECT user_id, count(order_id) AS total_orders,
  {sum_money_sql('gross_revenue')} AS gross_lifetime_value, {sum_money_sql('net_revenue')} AS net_lifetime_value,
  {sum_money_sql('net_margin')} AS lifetime_margin, {avg_money_sql('gross_revenue')} AS avg_order_value,
  {avg_exact_sql('net_margin_pct')} AS avg_net_margin_pct, min(order_ts) AS first_order_ts,
  max(order_ts) AS last_order_ts, {count_true_sql('has_refund')} AS orders_with_refund,
  {sum_money_sql('total_refund_usd')} AS total_refunds_received,
  {count_true_sql('is_cross_sell_order')} AS cross_sell_orders,
  count(DISTINCT primary_product_id) AS distinct_products_ordered,
  arg_min(acquisition_channel, (order_ts, order_id)) AS acquisition_channel
FROM {orders} GROUP BY user_id) t"""


CTES["m_users"] = _user_summary_sql("m_orders")
CTES["c_users"] = _user_summary_sql("c_orders")


@register("gd15_user_order_summary", "SELECT * FROM m_users")
def gd15_user_order_summary(spark, sf_dir):
    """GD15 + PRJ13 + AG10: per-customer LTV, tier, repeat flag, refund %."""
    return cu.user_order_summary(CommerceWorld(spark, sf_dir).orders)


@register("gd16_tier_distribution", f"""
SELECT customer_tier, is_repeat_buyer, count(user_id) AS customers,
  {avg_money_sql('gross_lifetime_value')} AS avg_ltv
FROM m_users GROUP BY 1, 2""")
def gd16_tier_distribution(spark, sf_dir):
    """GD16: customers and average LTV per tier."""
    return cu.tier_distribution(cu.user_order_summary(CommerceWorld(spark, sf_dir).orders))


def _cohort_sql(later: str) -> str:
    days = (60, 90, 180, 365)
    reps = ",\n  ".join(f"{count_true_sql(f'days_to_first_repeat <= {d}')} AS repeated_{d}d" for d in days)
    rates = ",\n  ".join(f"{_pct(count_true_sql(f'days_to_first_repeat <= {d}'), 'count(user_id)')} "
                         f"AS retention_rate_{d}d" for d in days)
    comp = ",\n  ".join(f"(CAST((SELECT max(order_ts) FROM m_orders) AS DATE) - CAST(max(first_order_ts) AS DATE)) "
                        f">= {d} AS is_complete_{d}d" for d in days)
    return f"""
WITH fo AS (
  SELECT user_id, order_ts AS first_order_ts, gross_revenue AS first_order_value, acquisition_channel,
    strftime(order_ts, '%Y-%m') AS acquisition_cohort
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_ts, order_id) AS rn FROM m_orders) x
  WHERE rn = 1),
rep AS (
  SELECT fo.user_id, min(CAST(o.order_ts AS DATE) - CAST(fo.first_order_ts AS DATE)) AS days_to_first_repeat
  FROM fo JOIN m_orders o ON o.user_id = fo.user_id AND {later}
  GROUP BY fo.user_id),
u AS (SELECT fo.*, rep.days_to_first_repeat FROM fo LEFT JOIN rep ON fo.user_id = rep.user_id)
SELECT acquisition_cohort, acquisition_channel, count(user_id) AS new_customers,
  {sum_money_sql('first_order_value')} AS cohort_first_revenue,
  {avg_money_sql('first_order_value')} AS avg_first_order_value,
  {reps},
  {_div('sum(days_to_first_repeat)', 'count(days_to_first_repeat)')} AS avg_days_to_repeat,
  {rates},
  {comp}
FROM u GROUP BY acquisition_cohort, acquisition_channel"""


@register("gd17_acquisition_cohorts", _cohort_sql("o.order_ts > fo.first_order_ts"))
def gd17_acquisition_cohorts(spark, sf_dir):
    """GD17 + WN4 + JN5: 60/90/180/365-day repeat rates by month x channel."""
    return cu.acquisition_cohorts(CommerceWorld(spark, sf_dir).orders)


@register("gd18_cohorts_day_gap", _cohort_sql(
    "CAST(o.order_ts AS DATE) - CAST(fo.first_order_ts AS DATE) > 0"))
def gd18_cohorts_day_gap(spark, sf_dir):
    """GD18: cohort variant, a repeat needs a later calendar day."""
    return cu.acquisition_cohorts(CommerceWorld(spark, sf_dir).orders, same_day_counts=False)


@register("gd19_repeat_session_analysis", f"""
SELECT is_repeat_session, channel_group, device_type, count(*) AS sessions,
  CAST(sum(placed_order) AS BIGINT) AS orders, CAST(sum(order_revenue) AS DOUBLE) AS total_revenue,
  {_pct('sum(placed_order)', 'count(*)')} AS cvr_pct,
  {_div('CAST(sum(order_revenue) AS DOUBLE)', 'count(*)')} AS avg_revenue_per_session
FROM swo GROUP BY 1, 2, 3""")
def gd19_repeat_session_analysis(spark, sf_dir):
    """GD19: new vs repeat session CVR."""
    return cu.repeat_session_analysis(ClickWorld(spark, sf_dir).sessions_with_orders)


@register("gd20_ltv_by_channel", f"""
SELECT acquisition_channel, count(user_id) AS customers_acquired,
  {count_true_sql('is_repeat_buyer')} AS repeat_buyers,
  {avg_money_sql('gross_lifetime_value')} AS avg_gross_ltv, {avg_money_sql('net_lifetime_value')} AS avg_net_ltv,
  {avg_money_sql('lifetime_margin')} AS avg_lifetime_margin,
  {_div('sum(total_orders)', 'count(total_orders)')} AS avg_orders_per_customer,
  {avg_exact_sql('avg_order_value')} AS avg_order_value,
  {avg_exact_sql('refund_rate_pct')} AS avg_customer_refund_rate,
  {sum_money_sql('gross_lifetime_value')} AS total_channel_ltv,
  {_pct(count_true_sql('is_repeat_buyer'), 'count(user_id)')} AS repeat_buyer_rate_pct
FROM m_users WHERE acquisition_channel IS NOT NULL GROUP BY acquisition_channel""")
def gd20_ltv_by_channel(spark, sf_dir):
    """GD20: LTV by acquisition channel, one row per user counted once."""
    return cu.ltv_by_channel(cu.user_order_summary(CommerceWorld(spark, sf_dir).orders))


EXEC_KPI_SQL = f"""
SELECT count(order_id) AS total_orders, count(DISTINCT user_id) AS total_customers,
  {sum_money_sql('gross_revenue')} AS total_gross_revenue, {sum_money_sql('net_revenue')} AS total_net_revenue,
  {sum_money_sql('net_margin')} AS total_net_margin, {sum_money_sql('gross_cogs')} AS total_cogs, {avg_exact_sql('gross_margin_pct')} AS avg_gross_margin_pct,
  {avg_exact_sql('net_margin_pct')} AS avg_net_margin_pct, {avg_money_sql('gross_revenue')} AS avg_order_value,
  {count_true_sql('has_refund')} AS total_refunded_orders, {sum_money_sql('total_refund_usd')} AS total_refund_value,
  {_pct(count_true_sql('has_refund'), 'count(order_id)')} AS overall_refund_rate_pct,
  {count_true_sql('is_cross_sell_order')} AS cross_sell_orders,
  {_pct(count_true_sql('is_cross_sell_order'), 'count(order_id)')} AS cross_sell_rate_pct,
  {_div('sum(items_purchased)', 'count(order_id)')} AS avg_items_per_order,
  min(order_ts) AS first_order_date, max(order_ts) AS last_order_date
FROM m_orders"""
CTES["m_exec"] = EXEC_KPI_SQL


@register("gd21_executive_kpis", "SELECT * FROM m_exec")
def gd21_executive_kpis(spark, sf_dir):
    """GD21 + AG11: one-row executive KPI summary."""
    return cu.executive_kpis(CommerceWorld(spark, sf_dir).orders)


@register("gd22_session_kpis", f"""
SELECT count(website_session_id) AS total_sessions, count(DISTINCT user_id) AS unique_visitors,
  {count_true_sql('is_repeat_session')} AS repeat_sessions,
  {_pct(count_true_sql('is_repeat_session'), 'count(website_session_id)')} AS repeat_session_pct,
  count(DISTINCT marketing_channel) AS distinct_channels
FROM sess""")
def gd22_session_kpis(spark, sf_dir):
    """GD22: one-row session summary."""
    return cu.session_kpis(ClickWorld(spark, sf_dir).sessions)


@register("gd32_rfm", f"""
SELECT user_id, CAST(last_order_date AS VARCHAR) AS last_order_date,
  CAST(first_order_date AS VARCHAR) AS first_order_date, frequency, monetary,
  (SELECT max(CAST(order_ts AS DATE)) FROM m_orders) - last_order_date AS recency_days,
  CASE WHEN frequency > 1 THEN {_div('last_order_date - first_order_date', 'frequency - 1')} END
    AS avg_days_between_orders,
  ntile(5) OVER (ORDER BY last_order_date, user_id) AS recency_score,
  ntile(5) OVER (ORDER BY frequency, user_id) AS frequency_score,
  ntile(5) OVER (ORDER BY monetary, user_id) AS monetary_score
FROM (SELECT user_id, max(CAST(order_ts AS DATE)) AS last_order_date, min(CAST(order_ts AS DATE)) AS first_order_date,
        count(order_id) AS frequency, {sum_money_sql('gross_revenue')} AS monetary
      FROM m_orders GROUP BY user_id) t""")
def gd32_rfm(spark, sf_dir):
    """GD32: recency / frequency / monetary features and quintile scores."""
    return cu.rfm(CommerceWorld(spark, sf_dir).orders)


@register("gd18b_cohorts_three_key", """
WITH cohort_g AS (""" + _cohort_sql("CAST(o.order_ts AS DATE) - CAST(fo.first_order_ts AS DATE) > 0") + """)
SELECT acquisition_cohort, acquisition_channel, new_customers, repeated_60d, repeated_90d, repeated_180d,
  repeated_365d, retention_rate_60d, retention_rate_90d, retention_rate_180d, retention_rate_365d
FROM cohort_g""")
def gd18b_cohorts_three_key(spark, sf_dir):
    """GD18 + JN9 + AG4: dashboard cohort retention with a 3-key null-safe
    join and distinct-user counts; equals GD18 on the shared columns."""
    return cu.cohort_retention_keyed(CommerceWorld(spark, sf_dir).orders)
