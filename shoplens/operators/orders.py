"""Silver orders and items: roll-ups, 5-way enrichment, P&L (AG8, AG9, JN4,
PRJ8-PRJ12).

Every side is aggregated to order grain *before* it is joined, so no join
fans out (an order with two items or two refunds stays one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MONEY, money, month_index, pct

# --- fixed values: output columns of the order and item tables ----------------
ORDER_COLUMNS = [
    "order_id", "order_ts", "order_year", "order_quarter", "order_month",
    "website_session_id", "user_id",
    "primary_product_id", "primary_product_name", "product_launch_ts",
    "months_after_product_launch",
    "items_purchased", "line_item_count", "is_cross_sell_order", "cross_sell_product_id",
    "gross_revenue", "gross_cogs", "gross_margin", "gross_margin_pct",
    "total_refund_usd", "refund_item_count", "has_refund", "days_to_refund",
    "net_revenue", "net_margin", "net_margin_pct",
    "session_channel", "session_channel_group", "session_utm_source",
    "session_utm_campaign", "session_device_type", "session_is_repeat",
    "acquisition_channel",
]


# ---------------------------------------------------------------------------


def refunds_by_order(refunds: DataFrame) -> DataFrame:
    """AG9: total, count and last refund per order."""
    return (refunds.groupBy("order_id")
            .agg(F.sum(money("refund_amount_usd")).cast(MONEY).alias("total_refund_usd"),
                 F.count(F.lit(1)).alias("refund_item_count"),
                 F.max("created_at").alias("last_refund_ts")))


def items_by_order(items: DataFrame) -> DataFrame:
    """AG8: line count and primary / cross-sell product per order."""
    return (items.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("line_item_count"),
                 F.max(F.when(F.col("is_primary_item") == 1, F.col("product_id")))
                 .alias("primary_product_id_items"),
                 F.max(F.when(F.col("is_primary_item") == 0, F.col("product_id")))
                 .alias("cross_sell_product_id")))


def session_attribution(sessions: DataFrame) -> DataFrame:
    """Session columns carried onto orders (last touch + first touch)."""
    return sessions.select(
        "website_session_id",
        F.col("marketing_channel").alias("session_channel"),
        F.col("channel_group").alias("session_channel_group"),
        F.col("utm_source").alias("session_utm_source"),
        F.col("utm_campaign").alias("session_utm_campaign"),
        F.col("device_type").alias("session_device_type"),
        F.col("is_repeat_session").alias("session_is_repeat"),
        "acquisition_channel")


def pnl_columns(price, cogs, refund) -> dict:
    """PRJ8: gross / net revenue, margin and margin % (unrounded, NULL-safe)."""
    p, c, r = money(price), money(cogs), money(refund)
    return {
        "gross_revenue": p.cast("double"),
        "gross_cogs": c.cast("double"),
        "gross_margin": (p - c).cast("double"),
        "gross_margin_pct": pct(p - c, p),
        "net_revenue": (p - r).cast("double"),
        "net_margin": (p - c - r).cast("double"),
        "net_margin_pct": F.when(p > 0, pct(p - c - r, p)).otherwise(F.lit(0.0)),
    }


def enrich_orders(orders: DataFrame, items: DataFrame | None, refunds: DataFrame | None,
                  attribution: DataFrame, products: DataFrame,
                  attribution_key: str = "website_session_id",
                  rollup: DataFrame | None = None) -> DataFrame:
    """JN4: orders ⟕ items roll-up ⟕ refunds roll-up ⟕ attribution ⟕ products.

    ``attribution`` is keyed by ``attribution_key`` (session id for click
    data, user id when orders carry no session). The product side is a
    dimension (one row per product) and is left to AQE's size-checked
    broadcast; no hint is forced on sides that grow with traffic.

    ``rollup`` (one row per order with the AG8 + AG9 columns) replaces the
    two roll-ups when the caller already aggregated the lines once; when
    ``orders`` already carries those columns nothing is joined.
    """
    o = orders.withColumn("order_ts", F.col("created_at").cast("timestamp_ntz"))
    prod = products.select(F.col("product_id").alias("primary_product_id"),
                           F.col("product_name").alias("primary_product_name"),
                           F.col("created_at").cast("timestamp_ntz").alias("product_launch_ts"))
    rolled = {"line_item_count", "cross_sell_product_id", "total_refund_usd",
              "refund_item_count", "last_refund_ts"}
    if rolled.issubset(o.columns):
        df = o
    elif rollup is not None:
        df = o.join(rollup.select("order_id", "line_item_count", "cross_sell_product_id",
                                  "total_refund_usd", "refund_item_count", "last_refund_ts"),
                    "order_id", "left")
    else:
        df = (o.join(items_by_order(items), "order_id", "left")
              .join(refunds_by_order(refunds), "order_id", "left"))
    df = (df.join(attribution, attribution_key, "left")
          .join(prod, "primary_product_id", "left"))
    has_refund = F.col("refund_item_count").isNotNull()
    df = df.withColumns({
        "total_refund_usd": F.coalesce("total_refund_usd", F.lit(0).cast(MONEY)),
        "refund_item_count": F.coalesce("refund_item_count", F.lit(0)).cast("long"),
        "has_refund": has_refund,
        "line_item_count": F.coalesce("line_item_count", F.lit(0)).cast("long"),
        "is_cross_sell_order": F.coalesce(F.col("cross_sell_product_id").isNotNull(), F.lit(False)),
    })
    df = df.withColumns(pnl_columns("price_usd", "cogs_usd", "total_refund_usd"))
    df = df.withColumns({
        "total_refund_usd": F.col("total_refund_usd").cast("double"),
        "days_to_refund": F.when(has_refund, F.datediff(F.to_date("last_refund_ts"),
                                                        F.to_date("order_ts"))),
        "order_year": F.year("order_ts"),
        "order_quarter": F.quarter("order_ts"),
        "order_month": F.month("order_ts"),
        "months_after_product_launch": month_index("order_ts") - month_index("product_launch_ts"),
    })
    return df.select(*ORDER_COLUMNS)


# --- fixed values: output columns of the item table ---------------------------
ITEM_COLUMNS = [
    "order_item_id", "item_ts", "item_year", "item_month", "order_id", "product_id",
    "product_name", "product_launch_date", "is_primary_item", "price_usd", "cogs_usd",
    "item_refund_usd", "refund_ts", "is_refunded", "item_net_revenue",
    "item_net_margin", "item_margin_pct",
]
# ---------------------------------------------------------------------------


def enrich_items(items: DataFrame, products: DataFrame,
                 refunds: DataFrame | None = None) -> DataFrame:
    """PRJ12: item P&L with refund facts.

    With ``refunds`` given, they are rolled up to item grain first (an item
    refunded twice stays one row). Without, ``items`` must already carry
    ``is_refunded`` and ``refund_ts`` (refund amount = item price).
    """
    prod = products.select("product_id", "product_name",
                           F.col("created_at").cast("timestamp_ntz").alias("product_launch_date"))
    i = items.withColumn("item_ts", F.col("created_at").cast("timestamp_ntz"))
    if refunds is not None:
        r = (refunds.groupBy("order_item_id")
             .agg(F.sum(money("refund_amount_usd")).cast(MONEY).alias("item_refund_usd"),
                  F.max("created_at").alias("refund_ts")))
        i = i.join(r, "order_item_id", "left")
    else:
        i = i.withColumns({
            "item_refund_usd": F.when(F.col("is_refunded"), money("price_usd")),
            "refund_ts": F.when(F.col("is_refunded"), F.col("refund_ts")),
        })
        if "order_item_id" not in i.columns:
            # line numbers may repeat in an order; ranks don't
            i = i.withColumn("order_item_id", F.col("order_id") * 1000 + F.col("line_rank"))
    p, c = money("price_usd"), money("cogs_usd")
    r = F.coalesce(money("item_refund_usd"), F.lit(0).cast(MONEY))
    i = i.join(prod, "product_id", "left").withColumns({
        "is_refunded": F.col("item_refund_usd").isNotNull(),
        "item_net_revenue": (p - r).cast("double"),
        "item_net_margin": (p - c - r).cast("double"),
        "item_margin_pct": pct(p - c, p),
        "is_primary_item": F.col("is_primary_item").cast("boolean"),
        "item_year": F.year("item_ts"),
        "item_month": F.month("item_ts"),
        "price_usd": p.cast("double"),
        "cogs_usd": c.cast("double"),
        "item_refund_usd": F.col("item_refund_usd").cast("double"),
    })
    return i.select(*ITEM_COLUMNS)
