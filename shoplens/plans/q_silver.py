"""Registered silver-layer queries: the canonical tables themselves."""

from __future__ import annotations

from ..operators import orders as od
from .catalog import register
from .worlds import ClickWorld, CommerceWorld


@register("silver_sessions_enriched", "SELECT * FROM sess")
def silver_sessions_enriched(spark, sf_dir):
    """PRJ1-PRJ7, WN1, WN2: 22-column sessions with channel, rank, first touch."""
    return ClickWorld(spark, sf_dir).sessions


@register("silver_funnel_steps", "SELECT * FROM funnel_l")
def silver_funnel_steps(spark, sf_dir):
    """AG5 + AG6 + AG7 + PRJ18: one row per session with 19 page flags."""
    return ClickWorld(spark, sf_dir).funnel


@register("wn3_entry_pages", "SELECT * FROM entry")
def wn3_entry_pages(spark, sf_dir):
    """WN3: entry page = first pageview of the session."""
    return ClickWorld(spark, sf_dir).entry_pages


@register("silver_orders_click", "SELECT * FROM c_orders")
def silver_orders_click(spark, sf_dir):
    """JN4 + PRJ8-PRJ11 on purchase events (session attribution)."""
    return ClickWorld(spark, sf_dir).orders


@register("silver_orders_commerce", "SELECT * FROM m_orders")
def silver_orders_commerce(spark, sf_dir):
    """JN4 + AG8 + AG9 + PRJ8-PRJ11 on orders/lineitem (customer attribution)."""
    return CommerceWorld(spark, sf_dir).orders


@register("silver_items_commerce", "SELECT * FROM m_items")
def silver_items_commerce(spark, sf_dir):
    """PRJ12: line-item P&L with refunds (returned lines)."""
    return CommerceWorld(spark, sf_dir).items_enriched


@register("silver_items_click", "SELECT * FROM c_items")
def silver_items_click(spark, sf_dir):
    """PRJ12 with a refund table rolled up to item grain first."""
    return ClickWorld(spark, sf_dir).items_enriched


@register("ag9_refunds_by_order", """
SELECT l_orderkey AS order_id, CAST(sum(price_usd) AS DOUBLE) AS total_refund_usd,
  count(*) AS refund_item_count, max(l_shipdate) AS last_refund_ts
FROM m_lines WHERE l_returnflag = 'R' GROUP BY l_orderkey""")
def ag9_refunds_by_order(spark, sf_dir):
    """AG9: refund roll-up per order."""
    return od.refunds_by_order(CommerceWorld(spark, sf_dir).refunds)


@register("ag8_items_by_order", """
SELECT l_orderkey AS order_id, count(*) AS line_item_count,
  max(CASE WHEN line_pos = 1 THEN product_id END) AS primary_product_id_items,
  max(CASE WHEN line_pos > 1 THEN product_id END) AS cross_sell_product_id
FROM m_lines GROUP BY l_orderkey""")
def ag8_items_by_order(spark, sf_dir):
    """AG8: conditional max as pivot (primary / cross-sell product)."""
    return od.items_by_order(CommerceWorld(spark, sf_dir).items)
