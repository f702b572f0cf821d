"""Product gold: monthly P&L, launch impact, cross-sell, refunds, channel mix
(GD9-GD14, WN6, JN11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import avg_exact, count_true, month_key, pct, pct_change, ratio
from .marketing import previous_period

M4 = "decimal(18,4)"


def _sum_money(c):
    return F.sum(F.col(c).cast(M4)).cast("double")


def product_monthly(orders: DataFrame) -> DataFrame:
    """GD9 + WN6: product x month P&L, refund and cross-sell rates, MoM."""
    g = (orders.withColumn("year_month", month_key("order_ts"))
         .groupBy("year_month", "order_year", "order_month",
                  "primary_product_id", "primary_product_name")
         .agg(F.count("order_id").alias("orders"),
              F.sum("items_purchased").cast("long").alias("items_sold"),
              _sum_money("gross_revenue").alias("gross_revenue"),
              _sum_money("gross_cogs").alias("total_cogs"),
              _sum_money("gross_margin").alias("gross_margin"),
              avg_exact("gross_margin_pct").alias("avg_gross_margin_pct"),
              _sum_money("total_refund_usd").alias("total_refunds"),
              count_true("has_refund").alias("refunded_orders"),
              _sum_money("net_revenue").alias("net_revenue"),
              _sum_money("net_margin").alias("net_margin"),
              avg_exact("net_margin_pct").alias("avg_net_margin_pct"),
              count_true("is_cross_sell_order").alias("cross_sell_orders")))
    g = g.withColumns({"refund_rate_pct": pct("refunded_orders", "orders"),
                       "cross_sell_rate_pct": pct("cross_sell_orders", "orders")})
    g = previous_period(g, ["primary_product_id"], cols=("gross_revenue",))
    return g.withColumn("revenue_mom_pct", pct_change("gross_revenue", "gross_revenue_prev_month"))


# --- fixed values: launch periods (upper month bound inclusive, label) -------
LAUNCH_PERIODS = [(0, "M00"), (2, "M01-02"), (5, "M03-05"), (11, "M06-11"), (23, "M12-23")]
LAUNCH_LAST = "M24+"
# ----------------------------------------------------------------------------


def launch_period(months="months_after_product_launch", periods=LAUNCH_PERIODS,
                  last=LAUNCH_LAST):
    m = F.col(months)
    expr = F.when(m.isNull() | (m < 0), F.lit(None).cast("string"))
    for hi, label in periods:
        expr = expr.when(m <= hi, label)
    return expr.otherwise(last)


def launch_impact(orders: DataFrame) -> DataFrame:
    """GD10: orders, revenue, margin %, refund % by months since launch."""
    g = (orders.filter(F.col("primary_product_id").isNotNull())
         .withColumn("launch_period", launch_period())
         .groupBy("primary_product_name", "launch_period")
         .agg(F.count("order_id").alias("orders"),
              _sum_money("gross_revenue").alias("gross_revenue"),
              avg_exact("gross_margin_pct").alias("avg_margin_pct"),
              count_true("has_refund").alias("refunded_orders")))
    return g.withColumn("refund_rate_pct", pct("refunded_orders", "orders"))


def cross_sell_matrix(orders: DataFrame, products: DataFrame,
                      min_primary_orders: int = 0) -> DataFrame:
    """GD11 + JN11: cross-sell pairs with attach rate.

    Totals per primary product come from the same scan via a conditional
    aggregate plus a window over the (small) aggregated result, not from a
    second pass joined back.
    """
    names = products.select(F.col("product_id").alias("cross_sell_product_id"),
                            F.col("product_name").alias("cross_sell_product_name"))
    g = (orders.groupBy("primary_product_name", "cross_sell_product_id")
         .agg(F.count("order_id").alias("n"),
              _sum_money("gross_revenue").alias("total_order_revenue"),
              avg_exact("gross_margin_pct").alias("avg_margin_pct")))
    w = Window.partitionBy("primary_product_name")
    g = g.withColumn("total_orders_for_product", F.sum("n").over(w))
    g = (g.filter(F.col("cross_sell_product_id").isNotNull())
         .join(names, "cross_sell_product_id", "left")
         .withColumnRenamed("n", "cross_sell_orders"))
    g = g.withColumns({
        "avg_order_value": ratio("total_order_revenue", "cross_sell_orders"),
        "attach_rate_pct": pct("cross_sell_orders", "total_orders_for_product")})
    if min_primary_orders:
        g = g.filter(F.col("total_orders_for_product") >= min_primary_orders)
    return g.drop("cross_sell_product_id")


def refund_analysis(items: DataFrame) -> DataFrame:
    """GD12: item refunds by product x month."""
    g = (items.withColumn("year_month", month_key("item_ts"))
         .groupBy("year_month", "product_name")
         .agg(F.count(F.lit(1)).alias("items_sold"),
              count_true("is_refunded").alias("items_refunded"),
              _sum_money("item_refund_usd").alias("total_refund_usd"),
              F.try_divide(F.sum(F.col("price_usd").cast(M4)).cast("double"),
                           F.count("price_usd").cast("double")).alias("avg_sale_price"),
              _sum_money("item_net_revenue").alias("net_revenue"),
              _sum_money("item_net_margin").alias("net_margin")))
    return g.withColumn("item_refund_rate_pct", pct("items_refunded", "items_sold"))


def days_to_refund_stats(orders: DataFrame) -> DataFrame:
    """GD13: refund timing per product (negative days are kept: reported,
    not clipped)."""
    return (orders.filter(F.col("has_refund"))
            .groupBy("primary_product_name")
            .agg(F.count("order_id").alias("refunded_orders"),
                 ratio(F.sum("days_to_refund"), F.count("days_to_refund")).alias("avg_days_to_refund"),
                 F.min("days_to_refund").alias("min_days_to_refund"),
                 F.max("days_to_refund").alias("max_days_to_refund"),
                 _sum_money("total_refund_usd").alias("total_refund_value")))


def product_channel_mix(orders: DataFrame) -> DataFrame:
    """GD14 + JN11: product x channel mix with share within product."""
    g = (orders.filter(F.col("primary_product_name").isNotNull())
         .groupBy("primary_product_name", "session_channel", "session_channel_group",
                  "session_device_type")
         .agg(F.count("order_id").alias("orders"),
              _sum_money("gross_revenue").alias("gross_revenue"),
              _sum_money("net_margin").alias("net_margin"),
              avg_exact("gross_margin_pct").alias("avg_margin_pct"),
              count_true("has_refund").alias("refund_count")))
    w = Window.partitionBy("primary_product_name")
    g = g.withColumn("product_total_orders", F.sum("orders").over(w))
    return g.withColumn("channel_order_share_pct", pct("orders", "product_total_orders"))
