"""Marketing gold: channel CVR, monthly trends, A/B tests, attribution
(GD1, GD2, GD4, GD5, GD6, GD7, GD8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (avg_exact, count_true, month_key, month_start,
                               pct, pct_change, ratio)


def orders_by_session(orders: DataFrame) -> DataFrame:
    """Roll orders up to session grain (a session with two orders stays one
    row; fixes the double count of joining raw orders)."""
    return (orders.filter(F.col("website_session_id").isNotNull())
            .groupBy("website_session_id")
            .agg(F.count(F.lit(1)).alias("session_orders"),
                 F.sum(F.col("gross_revenue").cast("decimal(18,4)")).alias("_rev"),
                 F.sum(F.col("net_margin").cast("decimal(18,4)")).alias("_mar"),
                 F.sum(F.when(F.col("has_refund"), 1).otherwise(0)).alias("_ref")))


def sessions_with_orders(sessions: DataFrame, funnel: DataFrame,
                         orders: DataFrame) -> DataFrame:
    """Sessions ⟕ funnel ⟕ per-session order roll-up."""
    s = (sessions.join(funnel, "website_session_id", "left")
         .join(orders_by_session(orders), "website_session_id", "left"))
    return s.withColumns({
        "session_orders": F.coalesce("session_orders", F.lit(0)).cast("long"),
        "placed_order": F.when(F.col("session_orders") > 0, 1).otherwise(0),
        "order_revenue": F.coalesce(F.col("_rev"), F.lit(0).cast("decimal(18,4)")),
        "order_margin": F.coalesce(F.col("_mar"), F.lit(0).cast("decimal(18,4)")),
        "session_refunded_orders": F.coalesce(F.col("_ref"), F.lit(0)).cast("long"),
    }).drop("_rev", "_mar", "_ref")


def channel_cvr(swo: DataFrame, group_cols=("marketing_channel", "channel_group",
                                            "device_type")) -> DataFrame:
    """GD1: CVR, revenue and margin per session, avg pageviews."""
    g = swo.groupBy(*group_cols).agg(
        F.count("website_session_id").alias("total_sessions"),
        F.sum("session_orders").cast("long").alias("total_orders"),
        F.sum("placed_order").cast("long").alias("converted_sessions"),
        F.sum("order_revenue").cast("double").alias("total_gross_revenue"),
        F.sum("order_margin").cast("double").alias("total_net_margin"),
        ratio(F.sum("total_pageviews_in_session"), F.count("total_pageviews_in_session"))
        .alias("avg_pageviews_per_session"))
    return g.withColumns({
        "conversion_rate_pct": pct("converted_sessions", "total_sessions"),
        "revenue_per_session": ratio("total_gross_revenue", "total_sessions"),
        "margin_per_session": ratio("total_net_margin", "total_sessions"),
    })


def previous_period(df: DataFrame, part_cols, key="year_month", cols=("sessions", "orders"),
                    suffix="_prev_month") -> DataFrame:
    """WN5: previous *calendar* month's values (NULL when that month is
    missing, not the previous row's). Windows run on monthly aggregates, so
    each partition holds at most one row per month."""
    w = Window.partitionBy(*part_cols).orderBy(key)
    prev_key = F.lag(key, 1).over(w)
    is_prev = F.add_months(month_start(prev_key), 1) == month_start(key)
    return df.withColumns({c + suffix: F.when(is_prev, F.lag(c, 1).over(w)) for c in cols})


def monthly_channel_trends(swo: DataFrame) -> DataFrame:
    """GD2: month × channel × device time series with MoM change."""
    g = (swo.withColumn("year_month", month_key("session_ts"))
         .groupBy("year_month", "channel_group", "marketing_channel", "device_type")
         .agg(F.count("website_session_id").alias("sessions"),
              F.sum("placed_order").cast("long").alias("orders"),
              F.sum("order_revenue").cast("double").alias("gross_revenue"),
              F.sum("order_margin").cast("double").alias("net_margin")))
    g = g.withColumns({"cvr_pct": pct("orders", "sessions"),
                       "revenue_per_session": ratio("gross_revenue", "sessions")})
    g = previous_period(g, ["marketing_channel", "device_type"])
    return g.withColumns({
        "sessions_mom_pct_chg": pct_change("sessions", "sessions_prev_month"),
        "orders_mom_pct_chg": pct_change("orders", "orders_prev_month"),
    })


def lander_test(entry: DataFrame, swo: DataFrame, pages=None) -> DataFrame:
    """GD4: CVR and revenue by entry page (order = reached the thank-you page)."""
    d = swo.join(entry, "website_session_id", "inner")
    if pages:
        d = d.filter(F.col("entry_page").isin(*pages))
    d = d.withColumn("_conv", F.coalesce(F.col("converted"), F.lit(False)).cast("int"))
    g = d.groupBy("entry_page").agg(
        F.count("website_session_id").alias("sessions"),
        F.sum("_conv").cast("long").alias("orders"),
        F.sum("order_revenue").cast("double").alias("total_revenue"))
    return g.withColumns({"cvr_pct": pct("orders", "sessions"),
                          "avg_revenue_per_session": ratio("total_revenue", "sessions")})


def billing_test(swo: DataFrame, group_cols=("channel_group", "device_type")) -> DataFrame:
    """GD5: among sessions that reached billing, CVR by billing variant
    (v2 wins when a session saw both)."""
    d = (swo.filter(F.col("saw_billing_any"))
         .withColumn("billing_variant",
                     F.when(F.col("saw_billing_v2"), "/billing-2").otherwise("/billing")))
    g = d.groupBy("billing_variant", *group_cols).agg(
        F.count("website_session_id").alias("sessions_at_billing"),
        F.sum("placed_order").cast("long").alias("orders"),
        F.sum("order_revenue").cast("double").alias("_rev"))
    return g.withColumns({
        "billing_to_order_cvr_pct": pct("orders", "sessions_at_billing"),
        "avg_revenue_per_session": ratio("_rev", "sessions_at_billing"),
    }).drop("_rev")


def ab_significance(results: DataFrame, variant_col: str, a: str, b: str,
                    n_col: str, conv_col: str, group_cols=()) -> DataFrame:
    """GD8: two-proportion z-test of variant b against a (session-weighted).

    Sums the per-group counts of each variant, then
    z = (p_b - p_a) / sqrt(p(1-p)(1/n_a + 1/n_b)), p pooled.
    """
    v = F.col(variant_col)
    g = results.groupBy(*group_cols).agg(
        F.sum(F.when(v == a, F.col(n_col))).cast("long").alias("n_a"),
        F.sum(F.when(v == b, F.col(n_col))).cast("long").alias("n_b"),
        F.sum(F.when(v == a, F.col(conv_col))).cast("long").alias("conv_a"),
        F.sum(F.when(v == b, F.col(conv_col))).cast("long").alias("conv_b"))
    p_a, p_b = ratio("conv_a", "n_a"), ratio("conv_b", "n_b")
    pooled = ratio(F.col("conv_a") + F.col("conv_b"), F.col("n_a") + F.col("n_b"))
    se = F.sqrt(pooled * (F.lit(1.0) - pooled) *
                (F.try_divide(F.lit(1.0), F.col("n_a").cast("double")) +
                 F.try_divide(F.lit(1.0), F.col("n_b").cast("double"))))
    g = g.withColumns({"variant_a": F.lit(a), "variant_b": F.lit(b),
                       "rate_a": p_a, "rate_b": p_b})
    g = g.withColumns({"lift_pp": (F.col("rate_b") - F.col("rate_a")) * 100.0,
                       "z_score": F.try_divide(F.col("rate_b") - F.col("rate_a"), se)})
    return g.withColumn("significant_95", F.coalesce(F.abs("z_score") > 1.96, F.lit(False)))


def revenue_by_channel(orders: DataFrame, channel_cols=("session_channel", "session_channel_group",
                                                        "session_device_type"),
                       rename=("marketing_channel", "channel_group", "device_type"),
                       suffix="_last_touch") -> DataFrame:
    """GD6 (last touch, session channel) / GD7 (first touch: pass
    ``channel_cols=("acquisition_channel",)``)."""
    g = orders.groupBy(*channel_cols).agg(
        F.count("order_id").alias("orders"),
        F.sum(F.col("gross_revenue").cast("decimal(18,4)")).cast("double").alias("gross_revenue" + suffix),
        F.sum(F.col("net_revenue").cast("decimal(18,4)")).cast("double").alias("net_revenue" + suffix),
        F.sum(F.col("net_margin").cast("decimal(18,4)")).cast("double").alias("net_margin" + suffix),
        avg_exact("gross_margin_pct").alias("avg_gross_margin_pct"),
        avg_exact("net_margin_pct").alias("avg_net_margin_pct"),
        count_true("has_refund").alias("refund_count"),
        F.sum(F.col("total_refund_usd").cast("decimal(18,4)")).cast("double").alias("total_refunds"))
    g = g.withColumns({"refund_rate_pct": pct("refund_count", "orders"),
                       "avg_order_value": ratio("gross_revenue" + suffix, "orders")})
    for src, dst in zip(channel_cols, rename):
        g = g.withColumnRenamed(src, dst)
    return g
