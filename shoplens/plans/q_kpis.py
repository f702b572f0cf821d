"""Registered KPI queries: daily metrics on a dense calendar (click world with
sessions), long-history KPIs on the commerce orders."""

from __future__ import annotations

from ..operators import funnel as fn
from ..operators import kpis as kp
from ..sources import adapters as ad
from ..operators.customers import user_order_summary
from .catalog import register
from .oracle_ctes import CTES, _div
from .worlds import ClickWorld, CommerceWorld

CTES["c_daily"] = """
SELECT CAST(session_ts AS DATE) AS metric_date, CAST(sum(session_orders) AS BIGINT) AS daily_orders,
  CAST(sum(order_revenue) AS DECIMAL(18,4)) AS daily_revenue, count(*) AS daily_sessions,
  CAST(sum(placed_order) AS BIGINT) AS converted_sessions,
  CAST(sum(session_refunded_orders) AS BIGINT) AS refunded_orders
FROM swo GROUP BY 1"""

CTES["m_daily"] = """
SELECT CAST(order_ts AS DATE) AS metric_date, count(*) AS daily_orders,
  CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS daily_revenue,
  CAST(NULL AS BIGINT) AS daily_sessions, CAST(NULL AS BIGINT) AS converted_sessions,
  CAST(sum(CASE WHEN has_refund THEN 1 ELSE 0 END) AS BIGINT) AS refunded_orders
FROM m_orders GROUP BY 1"""


def _dense(daily: str, sessions_zero: bool) -> str:
    sess = ("coalesce(d.daily_sessions, 0) AS daily_sessions, coalesce(d.converted_sessions, 0) AS converted_sessions"
            if sessions_zero else "d.daily_sessions, d.converted_sessions")
    return f"""
SELECT c.metric_date, coalesce(d.daily_orders, 0) AS daily_orders,
  coalesce(d.daily_revenue, CAST(0 AS DECIMAL(18,4))) AS daily_revenue,
  {sess}, coalesce(d.refunded_orders, 0) AS refunded_orders
FROM (SELECT CAST(unnest(generate_series(min(metric_date), max(metric_date), INTERVAL 1 DAY)) AS DATE)
        AS metric_date FROM {daily}) c
LEFT JOIN {daily} d ON c.metric_date = d.metric_date"""


def _kpi(dense: str) -> str:
    return f"""SELECT *, {_div('converted_sessions', 'daily_sessions')} AS daily_cvr,
  {_div('refunded_orders', 'daily_orders')} AS daily_refund_rate FROM ({dense}) t"""


CTES["visits"] = f"""
SELECT s.session_ts - ({ad.VISITS_BACK} + s.user_id % {ad.VISITS_SPREAD}) * INTERVAL 1 MONTH AS session_ts,
  CASE WHEN o.website_session_id IS NULL THEN 0 ELSE 1 END AS placed_order
FROM sess s LEFT JOIN (SELECT DISTINCT website_session_id FROM c_orders_raw) o
  ON s.website_session_id = o.website_session_id"""
CTES["mv_daily"] = """
SELECT coalesce(o.metric_date, v.metric_date) AS metric_date, o.daily_orders, o.daily_revenue, v.daily_sessions,
  v.converted_sessions, o.refunded_orders
FROM m_daily o FULL JOIN (
  SELECT CAST(session_ts AS DATE) AS metric_date, count(*) AS daily_sessions,
    CAST(sum(placed_order) AS BIGINT) AS converted_sessions FROM visits GROUP BY 1) v
  ON o.metric_date = v.metric_date"""
CTES["mv_dense"] = _kpi(_dense("mv_daily", True))
CTES["c_dense"] = _kpi(_dense("c_daily", True))
CTES["m_dense"] = _kpi(_dense("m_daily", False))


def _out(cols_sql: str) -> str:
    return f"CAST(metric_date AS VARCHAR) AS metric_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, {cols_sql}"


@register("gd23_daily_metrics", "SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date, "
                                "CAST(daily_revenue AS DOUBLE) AS daily_revenue) FROM c_dense")
def gd23_daily_metrics(spark, sf_dir):
    """GD23: daily orders, revenue, sessions, CVR, refund rate by session day
    on a dense calendar."""
    w = ClickWorld(spark, sf_dir)
    return kp.daily_kpis(w.orders, w.sessions_with_orders)


def _wavg_sql(c: str, n: int) -> str:
    w = f"OVER (ORDER BY metric_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    if c == "daily_cvr":
        x = f"CAST(floor(CAST({c} AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT)"
        return f"(CAST(sum({x}) {w} AS DOUBLE) / NULLIF(CAST(count({x}) {w} AS DOUBLE), 0) / 1000000.0)"
    return (f"(CAST(sum(CAST({c} AS DECIMAL(38,6))) {w} AS DOUBLE) / "
            f"NULLIF(CAST(count(CAST({c} AS DECIMAL(38,6))) {w} AS DOUBLE), 0))")


ROLL = ", ".join(f"{_wavg_sql(m, n)} AS {m.replace('daily_', '')}_{n}d_avg"
                 for n in (7, 30, 90)
                 for m in ("daily_orders", "daily_revenue", "daily_sessions", "daily_cvr"))


@register("gd24_rolling_kpis", f"""SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date,
  CAST(daily_revenue AS DOUBLE) AS daily_revenue) FROM (SELECT *, {ROLL} FROM mv_dense) t""")
def gd24_rolling_kpis(spark, sf_dir):
    """GD24 + WN8: 7/30/90-day trailing averages on the order calendar, with the
    sessions of its days."""
    return kp.rolling_kpis(_daily(spark, sf_dir))


def _daily(spark, sf_dir):
    return kp.daily_kpis(CommerceWorld(spark, sf_dir).orders, visits=ClickWorld(spark, sf_dir).visits)


def _pop_sql() -> str:
    cols = []
    for m in ("daily_orders", "daily_revenue"):
        base = m.replace("daily_", "")
        for name, n in (("wow", 7), ("mom", 30), ("yoy", 365)):
            prev = f"lag({m}, {n}) OVER (ORDER BY metric_date)"
            prev_out = f"CAST({prev} AS DOUBLE)" if m == "daily_revenue" else prev
            chg = (f"((CAST({m} AS DOUBLE) - CAST({prev} AS DOUBLE)) / NULLIF(CAST({prev} AS DOUBLE), 0) * 100.0)")
            cols.append(f"{prev_out} AS {base}_prev_{n}d")
            cols.append(f"{chg} AS {base}_{name}_pct")
            cols.append(f"CASE WHEN {chg} > 5.0 THEN 'UP' WHEN {chg} < -5.0 THEN 'DOWN' ELSE 'STABLE' END "
                        f"AS {base}_{name}_trend")
    prev = "lag(daily_cvr, 30) OVER (ORDER BY metric_date)"
    chg = f"((daily_cvr - {prev}) / NULLIF({prev}, 0) * 100.0)"
    cols.append(f"CASE WHEN {chg} > 5.0 THEN 'UP' WHEN {chg} < -5.0 THEN 'DOWN' ELSE 'STABLE' END AS cvr_trend_30d")
    return ", ".join(cols)


@register("gd25_period_over_period", f"""SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date,
  CAST(daily_revenue AS DOUBLE) AS daily_revenue) FROM (SELECT *, {_pop_sql()} FROM mv_dense) t""")
def gd25_period_over_period(spark, sf_dir):
    """GD25 + WN7 + PRJ15: WoW / MoM / YoY by calendar day with trend labels."""
    return kp.period_over_period(_daily(spark, sf_dir))


CTES["m_monthly"] = """
SELECT coalesce(o.score_month, v.score_month) AS score_month, coalesce(o.n, 0) AS monthly_orders,
  o.monthly_revenue, o.monthly_margin,
  CAST(v.conv AS DOUBLE) / NULLIF(CAST(v.n AS DOUBLE), 0) AS monthly_cvr,
  CAST(o.refunded AS DOUBLE) / NULLIF(CAST(coalesce(o.n, 0) AS DOUBLE), 0) AS monthly_refund_rate,
  CAST(o.cross AS DOUBLE) / NULLIF(CAST(coalesce(o.n, 0) AS DOUBLE), 0) AS monthly_cross_sell_rate
FROM (
  SELECT strftime(order_ts, '%Y-%m') AS score_month, count(*) AS n,
    CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE) AS monthly_revenue,
    CAST(sum(CAST(net_margin AS DECIMAL(18,4))) AS DOUBLE) AS monthly_margin,
    sum(CASE WHEN has_refund THEN 1 ELSE 0 END) AS refunded,
    sum(CASE WHEN is_cross_sell_order THEN 1 ELSE 0 END) AS cross
  FROM m_orders GROUP BY 1) o
FULL JOIN (SELECT strftime(session_ts, '%Y-%m') AS score_month, count(*) AS n, sum(placed_order) AS conv
           FROM visits GROUP BY 1) v ON o.score_month = v.score_month"""
CTES["m_scored"] = """
SELECT *, CAST(substr(score_month, 1, 4) AS INTEGER) * 12 + CAST(substr(score_month, 6, 2) AS INTEGER) AS mi
FROM m_monthly"""


@register("gd26_executive_scorecard", """
SELECT *, revenue_growth_score * CAST(0.25 AS DOUBLE) + cvr_performance_score * CAST(0.25 AS DOUBLE) + refund_rate_score * CAST(0.25 AS DOUBLE)
    + cross_sell_rate_score * CAST(0.25 AS DOUBLE) AS composite_performance_score,
  CASE WHEN revenue_growth_score * CAST(0.25 AS DOUBLE) + cvr_performance_score * CAST(0.25 AS DOUBLE) + refund_rate_score * CAST(0.25 AS DOUBLE)
    + cross_sell_rate_score * CAST(0.25 AS DOUBLE) >= 80 THEN 'GREEN'
       WHEN revenue_growth_score * CAST(0.25 AS DOUBLE) + cvr_performance_score * CAST(0.25 AS DOUBLE) + refund_rate_score * CAST(0.25 AS DOUBLE)
    + cross_sell_rate_score * CAST(0.25 AS DOUBLE) >= 60 THEN 'AMBER' ELSE 'RED' END AS rag_status
FROM (
  SELECT score_month, monthly_orders, monthly_revenue, monthly_margin, monthly_cvr, monthly_refund_rate,
    monthly_cross_sell_rate, prior_month_revenue, cvr_avg AS cvr_90d_avg,
    CASE WHEN prior_month_revenue IS NULL THEN CAST(50.0 AS DOUBLE)
      WHEN (monthly_revenue - prior_month_revenue) / NULLIF(prior_month_revenue, 0) > 0.10 THEN CAST(100.0 AS DOUBLE)
      WHEN (monthly_revenue - prior_month_revenue) / NULLIF(prior_month_revenue, 0) > 0.05 THEN CAST(85.0 AS DOUBLE)
      WHEN (monthly_revenue - prior_month_revenue) / NULLIF(prior_month_revenue, 0) > 0 THEN CAST(70.0 AS DOUBLE)
      WHEN (monthly_revenue - prior_month_revenue) / NULLIF(prior_month_revenue, 0) > -0.05 THEN CAST(50.0 AS DOUBLE)
      ELSE CAST(25.0 AS DOUBLE) END AS revenue_growth_score,
    CASE WHEN monthly_cvr IS NULL THEN CAST(50.0 AS DOUBLE) WHEN monthly_cvr > cvr_avg * 1.10 THEN CAST(100.0 AS DOUBLE) WHEN monthly_cvr > cvr_avg * 1.05 THEN CAST(85.0 AS DOUBLE)
      WHEN monthly_cvr >= cvr_avg * 0.95 THEN CAST(70.0 AS DOUBLE) WHEN monthly_cvr >= cvr_avg * 0.90 THEN CAST(50.0 AS DOUBLE)
      ELSE CAST(25.0 AS DOUBLE) END AS cvr_performance_score,
    CASE WHEN monthly_refund_rate < 0.05 * 0.5 THEN CAST(100.0 AS DOUBLE) WHEN monthly_refund_rate < 0.05 * 0.75 THEN CAST(85.0 AS DOUBLE)
      WHEN monthly_refund_rate <= 0.05 THEN CAST(70.0 AS DOUBLE) WHEN monthly_refund_rate <= 0.05 * 1.25 THEN CAST(50.0 AS DOUBLE)
      ELSE CAST(25.0 AS DOUBLE) END AS refund_rate_score,
    CASE WHEN monthly_cross_sell_rate > 0.08 * 1.25 THEN CAST(100.0 AS DOUBLE) WHEN monthly_cross_sell_rate > 0.08 * 1.10 THEN CAST(85.0 AS DOUBLE)
      WHEN monthly_cross_sell_rate >= 0.08 THEN CAST(70.0 AS DOUBLE) WHEN monthly_cross_sell_rate >= 0.08 * 0.75 THEN CAST(50.0 AS DOUBLE)
      ELSE CAST(25.0 AS DOUBLE) END AS cross_sell_rate_score
  FROM (SELECT m.*, p.monthly_revenue AS prior_month_revenue, a.cvr_avg
        FROM m_scored m LEFT JOIN m_scored p ON p.mi = m.mi - 1
        JOIN (SELECT mi,
          CAST(sum(CAST(floor(monthly_cvr * 1000000.0 + 0.5) AS BIGINT)) OVER w AS DOUBLE)
            / NULLIF(CAST(count(monthly_cvr) OVER w AS DOUBLE), 0) / 1000000.0 AS cvr_avg
          FROM m_scored WINDOW w AS (ORDER BY mi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)) a ON a.mi = m.mi) c) b""")
def gd26_executive_scorecard(spark, sf_dir):
    """GD26 + WN9 + WN10 + PRJ17: monthly scorecard, composite and RAG."""
    return kp.executive_scorecard(kp.monthly_metrics(CommerceWorld(spark, sf_dir).orders,
                                                     ClickWorld(spark, sf_dir).visits))


@register("gd27_channel_efficiency", """
SELECT *, revenue_per_session_rank * CAST(0.25 AS DOUBLE) + margin_per_session_rank * CAST(0.25 AS DOUBLE) + refund_rate_rank * CAST(0.2 AS DOUBLE)
    + repeat_rate_rank * CAST(0.15 AS DOUBLE) + ltv_rank * CAST(0.15 AS DOUBLE) AS composite_efficiency_rank,
  CASE WHEN dense_rank() OVER (ORDER BY revenue_per_session_rank * CAST(0.25 AS DOUBLE) + margin_per_session_rank * CAST(0.25 AS DOUBLE)
         + refund_rate_rank * CAST(0.2 AS DOUBLE) + repeat_rate_rank * CAST(0.15 AS DOUBLE) + ltv_rank * CAST(0.15 AS DOUBLE)) <= 2 THEN 'TIER_1_HIGH_EFFICIENCY'
       WHEN dense_rank() OVER (ORDER BY revenue_per_session_rank * CAST(0.25 AS DOUBLE) + margin_per_session_rank * CAST(0.25 AS DOUBLE)
         + refund_rate_rank * CAST(0.2 AS DOUBLE) + repeat_rate_rank * CAST(0.15 AS DOUBLE) + ltv_rank * CAST(0.15 AS DOUBLE)) <= 5 THEN 'TIER_2_STANDARD'
       ELSE 'TIER_3_LOW_EFFICIENCY' END AS efficiency_tier
FROM (
  SELECT *,
    dense_rank() OVER (ORDER BY revenue_per_session DESC NULLS LAST) AS revenue_per_session_rank,
    dense_rank() OVER (ORDER BY margin_per_session DESC NULLS LAST) AS margin_per_session_rank,
    dense_rank() OVER (ORDER BY refund_rate ASC NULLS LAST) AS refund_rate_rank,
    dense_rank() OVER (ORDER BY repeat_customer_rate DESC NULLS LAST) AS repeat_rate_rank,
    dense_rank() OVER (ORDER BY avg_ltv_acquired DESC NULLS LAST) AS ltv_rank
  FROM (
    SELECT s.marketing_channel, s.total_sessions, s.total_orders,
      CAST(s.conv AS DOUBLE) / NULLIF(CAST(s.total_sessions AS DOUBLE), 0) AS cvr,
      s.rev / NULLIF(CAST(s.total_sessions AS DOUBLE), 0) AS revenue_per_session,
      s.mar / NULLIF(CAST(s.total_sessions AS DOUBLE), 0) AS margin_per_session,
      CAST(s.ref AS DOUBLE) / NULLIF(CAST(s.total_orders AS DOUBLE), 0) AS refund_rate,
      CAST(s.rep AS DOUBLE) / NULLIF(CAST(s.total_sessions AS DOUBLE), 0) AS repeat_customer_rate,
      l.avg_ltv_acquired
    FROM (SELECT marketing_channel, count(*) AS total_sessions, CAST(sum(session_orders) AS BIGINT) AS total_orders,
            sum(placed_order) AS conv, CAST(sum(CAST(order_revenue AS DECIMAL(18,4))) AS DOUBLE) AS rev,
            CAST(sum(CAST(order_margin AS DECIMAL(18,4))) AS DOUBLE) AS mar,
            sum(session_refunded_orders) AS ref, sum(CASE WHEN is_repeat_session THEN 1 ELSE 0 END) AS rep
          FROM swo GROUP BY marketing_channel) s
    LEFT JOIN (SELECT acquisition_channel, CAST(sum(CAST(gross_lifetime_value AS DECIMAL(18,4))) AS DOUBLE)
                 / NULLIF(CAST(count(gross_lifetime_value) AS DOUBLE), 0) AS avg_ltv_acquired
               FROM c_users GROUP BY acquisition_channel) l
      ON s.marketing_channel = l.acquisition_channel
    WHERE s.total_sessions > 100) c) r""")
def gd27_channel_efficiency(spark, sf_dir):
    """GD27 + WN11 + WN12 + FLT2: channel efficiency ranks and tiers."""
    w = ClickWorld(spark, sf_dir)
    return kp.channel_efficiency(w.sessions_with_orders, user_order_summary(w.orders))


CTES["m_month_rev"] = """
SELECT strftime(order_ts, '%Y-%m') AS year_month,
  CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM m_orders GROUP BY 1"""


@register("gd28_revenue_forecast", """
WITH mn AS (SELECT *, CAST(substr(year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(year_month, 6, 2) AS INTEGER) AS no
            FROM m_month_rev),
mi AS (SELECT year_month, revenue, no - first_value(no) OVER (ORDER BY year_month) + 1 AS month_index FROM mn),
last6 AS (SELECT * FROM mi WHERE strptime(year_month || '-01', '%Y-%m-%d')
            >= (SELECT max(strptime(year_month || '-01', '%Y-%m-%d')) FROM mi) - INTERVAL 5 MONTH),
fit AS (SELECT regr_slope(revenue, CAST(month_index AS DOUBLE)) AS slope,
          regr_intercept(revenue, CAST(month_index AS DOUBLE)) AS intercept,
          max(month_index) AS max_index, max(year_month) AS last_month FROM last6)
SELECT year_month, revenue, 'Actual' AS type FROM m_month_rev
UNION ALL
SELECT strftime(strptime(last_month || '-01', '%Y-%m-%d') + h * INTERVAL 1 MONTH, '%Y-%m') AS year_month,
  intercept + slope * (max_index + h) AS revenue, 'Forecast' AS type
FROM fit, (SELECT unnest([1, 2, 3]) AS h) hh""")
def gd28_revenue_forecast(spark, sf_dir):
    """GD28 + AG13 + WN14 + SE1: 3-month linear forecast appended to actuals."""
    return kp.revenue_forecast(kp.monthly_revenue(CommerceWorld(spark, sf_dir).orders))


@register("gd29_revenue_inflections", """
SELECT year_month, revenue, prev_month_revenue, pct_change,
  CASE WHEN pct_change > 20 THEN 'Revenue up ' || format('{:,.1f}', abs(pct_change)) || '%'
       ELSE 'Revenue down ' || format('{:,.1f}', abs(pct_change)) || '%' END AS annotation_label,
  CASE WHEN pct_change > 20 THEN 'Increase' ELSE 'Decrease' END AS direction
FROM (SELECT *, (revenue - prev_month_revenue) / NULLIF(prev_month_revenue, 0) * 100.0 AS pct_change
      FROM (SELECT m.year_month, m.revenue, p.revenue AS prev_month_revenue
            FROM m_month_rev m LEFT JOIN m_month_rev p
              ON p.year_month = strftime(strptime(m.year_month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m')) a) b
WHERE abs(pct_change) > 20""")
def gd29_revenue_inflections(spark, sf_dir):
    """GD29 + WN10: months with more than 20% MoM revenue change."""
    return kp.revenue_inflections(kp.monthly_revenue(CommerceWorld(spark, sf_dir).orders))


@register("gd30_funnel_dropoff", """
WITH f AS (SELECT count(*) AS s0, sum(CASE WHEN saw_products THEN 1 ELSE 0 END) AS s1,
             sum(CASE WHEN saw_product_page THEN 1 ELSE 0 END) AS s2, sum(CASE WHEN saw_cart THEN 1 ELSE 0 END) AS s3,
             sum(CASE WHEN saw_shipping THEN 1 ELSE 0 END) AS s4, sum(CASE WHEN saw_billing_any THEN 1 ELSE 0 END) AS s5,
             sum(CASE WHEN converted THEN 1 ELSE 0 END) AS s6
           FROM sess JOIN funnel_l USING (website_session_id)),
u AS (SELECT 'Entry -> Products' AS transition, CAST(1 AS BIGINT) AS step_order, s0 AS from_sessions, s1 AS to_sessions FROM f
  UNION ALL SELECT 'Products -> Product Page', 2, s1, s2 FROM f
  UNION ALL SELECT 'Product Page -> Cart', 3, s2, s3 FROM f
  UNION ALL SELECT 'Cart -> Shipping', 4, s3, s4 FROM f
  UNION ALL SELECT 'Shipping -> Billing', 5, s4, s5 FROM f
  UNION ALL SELECT 'Billing -> Order', 6, s5, s6 FROM f),
a AS (SELECT CAST(sum(CAST(gross_revenue AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(CAST(count(gross_revenue) AS DOUBLE), 0)
        AS avg_order_value FROM c_orders)
SELECT transition, step_order, CAST(from_sessions AS BIGINT) AS from_sessions, CAST(to_sessions AS BIGINT) AS to_sessions,
  avg_order_value, CAST(from_sessions - to_sessions AS BIGINT) AS lost_sessions,
  CAST(from_sessions - to_sessions AS DOUBLE) / NULLIF(CAST(from_sessions AS DOUBLE), 0) * 100.0 AS drop_pct,
  CAST(from_sessions - to_sessions AS DOUBLE) * avg_order_value * 0.05 AS estimated_revenue_leakage,
  row_number() OVER (ORDER BY from_sessions - to_sessions DESC, step_order) = 1 AS is_biggest_dropoff
FROM u, a""")
def gd30_funnel_dropoff(spark, sf_dir):
    """GD30 + SE4 + JN7 + SO3: funnel step losses, leakage, biggest drop."""
    w = ClickWorld(spark, sf_dir)
    d = w.sessions.select("website_session_id").join(w.funnel, "website_session_id", "inner")
    rates = fn.funnel_rates(d, [], with_step_rates=False)
    return kp.funnel_dropoff(rates, w.orders)


@register("gd31_anomalies", """
SELECT * EXCLUDE (n, s, ss) REPLACE (CAST(metric_date AS VARCHAR) AS metric_date,
    CAST(daily_revenue AS DOUBLE) AS daily_revenue),
  (CAST(daily_revenue AS DOUBLE) - baseline_mean) / NULLIF(baseline_std, 0) AS z_score,
  coalesce(abs((CAST(daily_revenue AS DOUBLE) - baseline_mean) / NULLIF(baseline_std, 0)) > 3.0, false) AS is_anomaly
FROM (
  SELECT *, s / NULLIF(n, 0) AS baseline_mean,
    sqrt(ss / NULLIF(n * (n - 1.0), 0)) / 100.0 AS baseline_std
  FROM (SELECT *, CAST(count(daily_revenue) OVER w AS DOUBLE) AS n, CAST(sum(daily_revenue) OVER w AS DOUBLE) AS s,
          CAST(count(daily_revenue) OVER w * sum(CAST(round(daily_revenue * 100) AS HUGEINT) * CAST(round(daily_revenue * 100) AS HUGEINT)) OVER w
            - sum(CAST(round(daily_revenue * 100) AS HUGEINT)) OVER w * sum(CAST(round(daily_revenue * 100) AS HUGEINT)) OVER w
            AS DOUBLE) AS ss
        FROM m_dense WINDOW w AS (ORDER BY metric_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)) a) b""")
def gd31_anomalies(spark, sf_dir):
    """GD31: rolling z-score anomaly flag on daily revenue."""
    out = kp.anomalies(kp.daily_kpis(CommerceWorld(spark, sf_dir).orders))
    return out
