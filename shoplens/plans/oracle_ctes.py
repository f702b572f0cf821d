"""DuckDB SQL for the canonical layers, written independently of the
DataFrame code so the oracle is a second implementation, not a copy.

``with_ctes(body, *names)`` prepends the named CTEs and their dependencies.
"""

from __future__ import annotations

import re

M = "CAST({} AS DECIMAL(18,4))"


def _div(n, d):
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def _pct(n, d):
    return f"({_div(n, d)} * 100.0)"


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ click world
CTES["ev"] = """
SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(ts AS DATE) AS event_date,
       user_id * 100000 + (CAST(ts AS DATE) - DATE '1970-01-01') AS website_session_id
FROM events"""

CTES["pv"] = """
SELECT event_id AS website_pageview_id, ts AS created_at, website_session_id, user_id,
  CASE event_type
    WHEN 'error' THEN ['/home', '/lander-1', '/lander-2', '/lander-3'][k % 4 + 1]
    WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN '/products'
         ELSE ['/the-original-mr-fuzzy', '/the-forever-love-bear',
               '/the-birthday-sugar-panda', '/the-hudson-river-mini-bear'][(k // 2) % 4 + 1] END
    WHEN 'click' THEN CASE WHEN k % 3 = 0 THEN '/shipping' ELSE '/cart' END
    WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN '/billing' ELSE '/billing-2' END
    WHEN 'purchase' THEN '/thank-you-for-your-order'
  END AS pageview_url
FROM ev"""

CTES["sess_raw"] = """
SELECT e.website_session_id, e.ts AS created_at, e.user_id,
  CASE WHEN e.event_date > uf.first_date THEN 1 ELSE 0 END AS is_repeat_session,
  CASE WHEN e.k % 8 = 0 AND e.k >= 50 THEN ' GSearch'
       WHEN e.k % 8 IN (0, 1) THEN 'gsearch' WHEN e.k % 8 IN (2, 3) THEN 'bsearch'
       WHEN e.k % 8 IN (4, 5) THEN 'socialbook' END AS utm_source,
  CASE e.k % 8 WHEN 0 THEN 'nonbrand' WHEN 1 THEN 'brand' WHEN 2 THEN 'nonbrand'
       WHEN 3 THEN 'brand' WHEN 4 THEN 'desktop_targeted' WHEN 5 THEN 'pilot' END AS utm_campaign,
  CASE WHEN e.k % 8 < 6 THEN 'ad_' || CAST(e.k % 3 + 1 AS VARCHAR) END AS utm_content,
  CASE WHEN (e.k // 8) % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS device_type,
  CASE WHEN e.k % 8 IN (0, 1, 6) THEN 'https://www.gsearch.com'
       WHEN e.k % 8 IN (2, 3) THEN 'https://www.bsearch.com'
       WHEN e.k % 8 IN (4, 5) THEN 'https://www.socialbook.com' END AS http_referer
FROM (SELECT *, row_number() OVER (PARTITION BY website_session_id ORDER BY event_id) AS rn
      FROM ev) e
JOIN (SELECT user_id, min(event_date) AS first_date FROM ev GROUP BY user_id) uf
  ON e.user_id = uf.user_id
WHERE e.rn = 1"""

CHANNEL_SQL = """CASE
    WHEN src = 'gsearch' AND cmp = 'nonbrand' THEN 'paid_search_gsearch_nonbrand'
    WHEN src = 'gsearch' AND cmp = 'brand' THEN 'paid_search_gsearch_brand'
    WHEN src = 'bsearch' AND cmp = 'nonbrand' THEN 'paid_search_bsearch_nonbrand'
    WHEN src = 'bsearch' AND cmp = 'brand' THEN 'paid_search_bsearch_brand'
    WHEN src = 'socialbook' AND cmp = 'desktop_targeted' THEN 'social_desktop'
    WHEN src = 'socialbook' AND cmp = 'pilot' THEN 'social_pilot'
    WHEN coalesce(src, '') IN ('', 'none', 'direct')
         AND (coalesce(ref LIKE '%gsearch%', false) OR coalesce(ref LIKE '%bsearch%', false))
      THEN 'organic_search'
    WHEN coalesce(src, '') IN ('', 'none', 'direct') THEN 'direct'
    ELSE 'other' END"""

CTES["sess_typed"] = f"""
SELECT website_session_id, CAST(created_at AS TIMESTAMP) AS session_ts, user_id,
  CAST(is_repeat_session AS BOOLEAN) AS is_repeat_session,
  lower(trim(coalesce(utm_source, 'direct'))) AS utm_source,
  lower(trim(coalesce(utm_campaign, 'none'))) AS utm_campaign,
  lower(trim(coalesce(utm_content, 'none'))) AS utm_content,
  lower(trim(device_type)) AS device_type,
  lower(trim(coalesce(http_referer, 'none'))) AS http_referer,
  {CHANNEL_SQL} AS marketing_channel
FROM (SELECT *, lower(trim(utm_source)) AS src, lower(trim(utm_campaign)) AS cmp,
             lower(trim(http_referer)) AS ref FROM sess_raw) r
WHERE website_session_id IS NOT NULL AND created_at IS NOT NULL AND user_id IS NOT NULL"""

CTES["sess"] = """
SELECT website_session_id, session_ts, user_id, is_repeat_session,
  CAST(row_number() OVER w AS BIGINT) AS user_session_rank,
  row_number() OVER w = 1 AS is_acquisition_session,
  utm_source, utm_campaign, utm_content, device_type, http_referer, marketing_channel,
  CASE WHEN marketing_channel LIKE 'paid_search%' THEN 'Paid Search'
       WHEN marketing_channel LIKE 'social%' THEN 'Social'
       WHEN marketing_channel = 'organic_search' THEN 'Organic'
       WHEN marketing_channel = 'direct' THEN 'Direct' ELSE 'Other' END AS channel_group,
  first_value(marketing_channel) OVER w AS acquisition_channel,
  first_value(session_ts) OVER w AS first_session_ts,
  year(session_ts) AS session_year, quarter(session_ts) AS session_quarter,
  month(session_ts) AS session_month, hour(session_ts) AS session_hour,
  dayofweek(session_ts) + 1 AS day_of_week,
  dayofweek(session_ts) IN (0, 6) AS is_weekend,
  'PASS' AS dq_flag
FROM sess_typed
WINDOW w AS (PARTITION BY user_id ORDER BY session_ts, website_session_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

PAGE_FLAG_SQL = [
    ("saw_home", "= '/home'"), ("saw_lander", "LIKE '/lander%'"),
    ("saw_lander_1", "= '/lander-1'"), ("saw_lander_2", "= '/lander-2'"),
    ("saw_lander_3", "= '/lander-3'"), ("saw_lander_4", "= '/lander-4'"),
    ("saw_lander_5", "= '/lander-5'"), ("saw_products", "= '/products'"),
    ("saw_product_page", "LIKE '/the-%'"), ("saw_mr_fuzzy", "= '/the-original-mr-fuzzy'"),
    ("saw_love_bear", "= '/the-forever-love-bear'"),
    ("saw_sugar_panda", "= '/the-birthday-sugar-panda'"),
    ("saw_mini_bear", "= '/the-hudson-river-mini-bear'"), ("saw_cart", "= '/cart'"),
    ("saw_shipping", "= '/shipping'"), ("saw_billing_any", "LIKE '/billing%'"),
    ("saw_billing_v1", "= '/billing'"), ("saw_billing_v2", "= '/billing-2'"),
    ("converted", "= '/thank-you-for-your-order'"),
]

CTES["funnel"] = "SELECT website_session_id,\n" + ",\n".join(
    f"  coalesce(bool_or(pageview_url {cond}), false) AS {name}" for name, cond in PAGE_FLAG_SQL
) + """,
  CAST(max(CASE WHEN pageview_url = '/thank-you-for-your-order' THEN 7
           WHEN pageview_url LIKE '/billing%' THEN 6 WHEN pageview_url = '/shipping' THEN 5
           WHEN pageview_url = '/cart' THEN 4 WHEN pageview_url LIKE '/the-%' THEN 3
           WHEN pageview_url = '/products' THEN 2 ELSE 1 END) AS BIGINT) AS funnel_depth,
  count(*) AS total_pageviews_in_session
FROM pv GROUP BY website_session_id"""

CTES["funnel_l"] = """
SELECT *, CASE funnel_depth WHEN 7 THEN 'Converted' WHEN 6 THEN 'Billing'
  WHEN 5 THEN 'Shipping' WHEN 4 THEN 'Cart' WHEN 3 THEN 'Product Page'
  WHEN 2 THEN 'Products' ELSE 'Entry Page' END AS funnel_exit_step
FROM funnel"""

CTES["entry"] = """
SELECT website_session_id, arg_min(pageview_url, website_pageview_id) AS entry_page
FROM pv GROUP BY website_session_id"""

CTES["c_orders_raw"] = """
SELECT event_id AS order_id, ts AS created_at, website_session_id, user_id,
  CAST(k % 4 + 1 AS BIGINT) AS primary_product_id, CAST(1 AS BIGINT) AS items_purchased,
  CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS price_usd,
  CAST(CAST(value AS DECIMAL(18,2)) * 0.4 AS DECIMAL(18,4)) AS cogs_usd, k
FROM ev WHERE event_type = 'purchase'"""

CTES["c_refunds"] = """
SELECT order_id, price_usd AS refund_amount_usd, created_at + INTERVAL 3 DAY AS created_at
FROM c_orders_raw WHERE k >= 90"""

CTES["c_products"] = """
SELECT primary_product_id AS product_id, min(created_at) AS launch_ts,
  ['Product A', 'Product B', 'Product C', 'Product D'][primary_product_id] AS product_name
FROM c_orders_raw GROUP BY primary_product_id"""

PNL_SQL = f"""
  CAST(price_usd AS DOUBLE) AS gross_revenue, CAST(cogs_usd AS DOUBLE) AS gross_cogs,
  CAST(price_usd - cogs_usd AS DOUBLE) AS gross_margin,
  {_pct('price_usd - cogs_usd', 'price_usd')} AS gross_margin_pct,
  CAST(refund AS DOUBLE) AS total_refund_usd,
  CAST(price_usd - refund AS DOUBLE) AS net_revenue,
  CAST(price_usd - cogs_usd - refund AS DOUBLE) AS net_margin,
  CASE WHEN price_usd > 0 THEN {_pct('price_usd - cogs_usd - refund', 'price_usd')} ELSE 0.0 END
    AS net_margin_pct"""

CTES["c_orders"] = f"""
SELECT order_id, order_ts, year(order_ts) AS order_year, quarter(order_ts) AS order_quarter,
  month(order_ts) AS order_month, website_session_id, user_id, primary_product_id,
  primary_product_name, product_launch_ts,
  (year(order_ts) * 12 + month(order_ts)) - (year(product_launch_ts) * 12 + month(product_launch_ts))
    AS months_after_product_launch,
  items_purchased, line_item_count, is_cross_sell_order, cross_sell_product_id,
  {PNL_SQL},
  refund_item_count, has_refund,
  CASE WHEN has_refund THEN CAST(last_refund_ts AS DATE) - CAST(order_ts AS DATE) END AS days_to_refund,
  session_channel, session_channel_group, session_utm_source, session_utm_campaign,
  session_device_type, session_is_repeat, acquisition_channel
FROM (
  SELECT o.order_id, CAST(o.created_at AS TIMESTAMP) AS order_ts, o.website_session_id, o.user_id,
    o.primary_product_id, p.product_name AS primary_product_name, p.launch_ts AS product_launch_ts,
    o.items_purchased, CAST(1 AS BIGINT) AS line_item_count, false AS is_cross_sell_order,
    CAST(NULL AS BIGINT) AS cross_sell_product_id, o.price_usd, o.cogs_usd,
    coalesce(r.refund, CAST(0 AS DECIMAL(18,4))) AS refund,
    coalesce(r.n, 0) AS refund_item_count, r.n IS NOT NULL AS has_refund, r.last_ts AS last_refund_ts,
    s.marketing_channel AS session_channel, s.channel_group AS session_channel_group,
    s.utm_source AS session_utm_source, s.utm_campaign AS session_utm_campaign,
    s.device_type AS session_device_type, s.is_repeat_session AS session_is_repeat,
    s.acquisition_channel
  FROM c_orders_raw o
  LEFT JOIN (SELECT order_id, CAST(sum(refund_amount_usd) AS DECIMAL(18,4)) AS refund,
                    count(*) AS n, max(created_at) AS last_ts
             FROM c_refunds GROUP BY order_id) r ON o.order_id = r.order_id
  LEFT JOIN sess s ON o.website_session_id = s.website_session_id
  LEFT JOIN c_products p ON o.primary_product_id = p.product_id) x"""

CTES["swo"] = """
SELECT s.*, f.* EXCLUDE (website_session_id),
  coalesce(o.n, 0) AS session_orders,
  CASE WHEN coalesce(o.n, 0) > 0 THEN 1 ELSE 0 END AS placed_order,
  coalesce(o.rev, 0) AS order_revenue, coalesce(o.mar, 0) AS order_margin,
  coalesce(o.nref, 0) AS session_refunded_orders
FROM sess s
LEFT JOIN funnel_l f ON s.website_session_id = f.website_session_id
LEFT JOIN (SELECT website_session_id, count(*) AS n,
                  sum(CAST(gross_revenue AS DECIMAL(18,4))) AS rev,
                  sum(CAST(net_margin AS DECIMAL(18,4))) AS mar,
                  count(CASE WHEN has_refund THEN 1 END) AS nref
           FROM c_orders GROUP BY website_session_id) o
  ON s.website_session_id = o.website_session_id"""

CTES["g"] = f"""
SELECT strftime(session_ts, '%Y-%m') AS year_month, channel_group, marketing_channel, device_type,
  count(*) AS sessions, CAST(sum(placed_order) AS BIGINT) AS orders,
  CAST(sum(order_revenue) AS DOUBLE) AS gross_revenue, CAST(sum(order_margin) AS DOUBLE) AS net_margin,
  {_pct('sum(placed_order)', 'count(*)')} AS cvr_pct,
  {_div('CAST(sum(order_revenue) AS DOUBLE)', 'count(*)')} AS revenue_per_session
FROM swo GROUP BY 1, 2, 3, 4"""

# --------------------------------------------------------------- commerce world
CTES["m_lines"] = """
SELECT l.*, o.o_orderdate, o.o_custkey,
  CAST(split_part(p.p_brand, '#', 2) AS BIGINT) AS product_id,
  CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(15,2)))
       AS DECIMAL(18,4)) AS price_usd,
  CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (0.35 + CAST(l.l_tax AS DECIMAL(15,2)))
       AS DECIMAL(18,4)) AS cogs_usd,
  row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
    l.l_shipdate, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
    l.l_linestatus) AS line_pos
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

CTES["m_products"] = """
SELECT product_id, min(o_orderdate) AS launch_ts, 'Brand#' || CAST(product_id AS VARCHAR) AS product_name
FROM m_lines GROUP BY product_id"""

CTES["m_orders"] = f"""
SELECT order_id, order_ts, year(order_ts) AS order_year, quarter(order_ts) AS order_quarter,
  month(order_ts) AS order_month, website_session_id, user_id, primary_product_id,
  primary_product_name, product_launch_ts,
  (year(order_ts) * 12 + month(order_ts)) - (year(product_launch_ts) * 12 + month(product_launch_ts))
    AS months_after_product_launch,
  items_purchased, line_item_count, is_cross_sell_order, cross_sell_product_id,
  {PNL_SQL},
  refund_item_count, has_refund,
  CASE WHEN has_refund THEN CAST(last_refund_ts AS DATE) - CAST(order_ts AS DATE) END AS days_to_refund,
  session_channel, session_channel_group, session_utm_source, session_utm_campaign,
  session_device_type, session_is_repeat, acquisition_channel
FROM (
  SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_ts,
    CAST(NULL AS BIGINT) AS website_session_id, o.o_custkey AS user_id,
    li.primary_product_id, p.product_name AS primary_product_name, p.launch_ts AS product_launch_ts,
    CAST(coalesce(li.n, 0) AS BIGINT) AS items_purchased, coalesce(li.n, 0) AS line_item_count,
    li.cross_id IS NOT NULL AS is_cross_sell_order, li.cross_id AS cross_sell_product_id,
    coalesce(li.price, 0) AS price_usd, coalesce(li.cogs, 0) AS cogs_usd,
    coalesce(li.refund, CAST(0 AS DECIMAL(18,4))) AS refund,
    coalesce(li.n_ref, 0) AS refund_item_count, coalesce(li.n_ref, 0) > 0 AS has_refund,
    li.last_ref AS last_refund_ts,
    lower(c.c_mktsegment) AS session_channel,
    upper(substr(lower(c.c_mktsegment), 1, 1)) || substr(lower(c.c_mktsegment), 2) AS session_channel_group,
    CAST(NULL AS VARCHAR) AS session_utm_source, CAST(NULL AS VARCHAR) AS session_utm_campaign,
    CAST(NULL AS VARCHAR) AS session_device_type, CAST(NULL AS BOOLEAN) AS session_is_repeat,
    lower(c.c_mktsegment) AS acquisition_channel
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, count(*) AS n,
               CAST(sum(price_usd) AS DECIMAL(18,4)) AS price, CAST(sum(cogs_usd) AS DECIMAL(18,4)) AS cogs,
               max(CASE WHEN line_pos = 1 THEN product_id END) AS primary_product_id,
               max(CASE WHEN line_pos > 1 THEN product_id END) AS cross_id,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN price_usd END) AS DECIMAL(18,4)) AS refund,
               count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_ref,
               max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS last_ref
             FROM m_lines GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN m_products p ON li.primary_product_id = p.product_id) x"""

CTES["m_items"] = f"""
SELECT l_orderkey * 1000 + line_pos AS order_item_id, o_orderdate AS item_ts,
  year(o_orderdate) AS item_year, month(o_orderdate) AS item_month, l_orderkey AS order_id,
  l.product_id, p.product_name, p.launch_ts AS product_launch_date, line_pos = 1 AS is_primary_item,
  CAST(price_usd AS DOUBLE) AS price_usd, CAST(cogs_usd AS DOUBLE) AS cogs_usd,
  CASE WHEN l_returnflag = 'R' THEN CAST(price_usd AS DOUBLE) END AS item_refund_usd,
  CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS refund_ts,
  l_returnflag = 'R' AS is_refunded,
  CAST(price_usd - CASE WHEN l_returnflag = 'R' THEN price_usd ELSE 0 END AS DOUBLE) AS item_net_revenue,
  CAST(price_usd - cogs_usd - CASE WHEN l_returnflag = 'R' THEN price_usd ELSE 0 END AS DOUBLE)
    AS item_net_margin,
  {_pct('price_usd - cogs_usd', 'price_usd')} AS item_margin_pct
FROM m_lines l LEFT JOIN m_products p ON l.product_id = p.product_id"""

CTES["c_items"] = f"""
SELECT o.order_id AS order_item_id, CAST(o.created_at AS TIMESTAMP) AS item_ts,
  year(o.created_at) AS item_year, month(o.created_at) AS item_month, o.order_id,
  o.primary_product_id AS product_id, p.product_name, p.launch_ts AS product_launch_date,
  true AS is_primary_item, CAST(o.price_usd AS DOUBLE) AS price_usd, CAST(o.cogs_usd AS DOUBLE) AS cogs_usd,
  CAST(r.refund_amount_usd AS DOUBLE) AS item_refund_usd, r.created_at AS refund_ts,
  r.order_id IS NOT NULL AS is_refunded,
  CAST(o.price_usd - coalesce(r.refund_amount_usd, 0) AS DOUBLE) AS item_net_revenue,
  CAST(o.price_usd - o.cogs_usd - coalesce(r.refund_amount_usd, 0) AS DOUBLE) AS item_net_margin,
  {_pct('o.price_usd - o.cogs_usd', 'o.price_usd')} AS item_margin_pct
FROM c_orders_raw o
LEFT JOIN c_refunds r ON o.order_id = r.order_id
LEFT JOIN c_products p ON o.primary_product_id = p.product_id"""


_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [t for t in dict.fromkeys(_NAME_RE.findall(body)) if t in CTES and t != name]


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    wanted = list(names) or [t for t in dict.fromkeys(_NAME_RE.findall(body)) if t in CTES]
    for n in wanted:
        visit(n)
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body


def sum_money_sql(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def avg_money_sql(c: str) -> str:
    return f"(CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(CAST(count({c}) AS DOUBLE), 0))"


def avg_exact_sql(c: str) -> str:
    x = f"CAST(floor(CAST({c} AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT)"
    return f"(CAST(sum({x}) AS DOUBLE) / NULLIF(CAST(count({x}) AS DOUBLE), 0) / 1000000.0)"


def count_true_sql(c: str) -> str:
    return f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"


def prev_month_sql(table: str, keys: list[str], cols: list[str], suffix: str = "_prev_month",
                   key: str = "year_month") -> str:
    """Previous *calendar* month's values via a null-safe self join."""
    on = " AND ".join([f"p.{k} IS NOT DISTINCT FROM g.{k}" for k in keys] +
                      [f"strptime(p.{key} || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH = "
                       f"strptime(g.{key} || '-01', '%Y-%m-%d')"])
    sel = ", ".join(f"p.{c} AS {c}{suffix}" for c in cols)
    return f"SELECT g.*, {sel} FROM {table} g LEFT JOIN {table} p ON {on}"
