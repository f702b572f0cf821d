"""The batch job: bronze-derived silver tables written once, gold tables
built from the written silver (the production path; the query registry
recomputes from the raw tables for checking).

Written tables cut lineage: a lost executor only recomputes from the last
written layer, never from the raw events. Paths live under the folder the
caller passes (on a cluster: a shared path such as the one in
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from ..operators import customers as cu
from ..operators import funnel as fn
from ..operators import kpis as kp
from ..operators import marketing as mk
from ..operators import products as pr
from ..sources.sinks import write_table
from .worlds import ClickWorld, CommerceWorld

SILVER = {
    # name: (builder, partition columns)
    "sessions_enriched": (lambda c, m: c.sessions, ("session_year", "session_month")),
    "session_funnel_steps": (lambda c, m: c.funnel, ()),
    "orders_enriched": (lambda c, m: m.orders, ("order_year", "order_month")),
    "order_items_enriched": (lambda c, m: m.items_enriched, ("item_year",)),
    "entry_pages": (lambda c, m: c.entry_pages, ()),
    "products": (lambda c, m: m.products, ()),
    "visits": (lambda c, m: c.visits, ()),
    "click_orders_enriched": (lambda c, m: c.orders, ()),
}


def build_silver(spark: SparkSession, sf_dir: str, out_dir: str) -> dict:
    c, m = ClickWorld(spark, sf_dir), CommerceWorld(spark, sf_dir)
    counts = {}
    for name, (fn, parts) in SILVER.items():
        counts[name] = write_table(fn(c, m), os.path.join(out_dir, "silver", name), partition_cols=parts)
    return counts


def build_gold(spark: SparkSession, out_dir: str) -> dict:
    def rd(n):
        return spark.read.parquet(os.path.join(out_dir, "silver", n))

    sessions, funnel = rd("sessions_enriched"), rd("session_funnel_steps")
    orders, items, click_orders = rd("orders_enriched"), rd("order_items_enriched"), rd("click_orders_enriched")
    swo = mk.sessions_with_orders(sessions, funnel, click_orders)
    users, click_users = cu.user_order_summary(orders), cu.user_order_summary(click_orders)
    visits = rd("visits")
    daily = kp.daily_kpis(orders, visits=visits)
    gold = {
        "channel_conversion_rates": mk.channel_cvr(swo),
        "monthly_channel_trends": mk.monthly_channel_trends(swo),
        "channel_revenue_roi": mk.revenue_by_channel(click_orders),
        "product_monthly_performance": pr.product_monthly(orders),
        "refund_analysis": pr.refund_analysis(items),
        "user_order_summary": users,
        "acquisition_cohorts": cu.acquisition_cohorts(orders),
        "executive_kpis": cu.executive_kpis(orders),
        "session_kpis": cu.session_kpis(sessions),
        "funnel_rates": fn.funnel_rates(
            sessions.select("website_session_id", "channel_group", "device_type").join(funnel, "website_session_id"),
            ["channel_group", "device_type"]),
        "lander_test": mk.lander_test(rd("entry_pages"), swo),
        "billing_test": mk.billing_test(swo),
        "launch_impact": pr.launch_impact(orders),
        "cross_sell_matrix": pr.cross_sell_matrix(orders, rd("products")),
        "product_channel_mix": pr.product_channel_mix(orders),
        "repeat_session_analysis": cu.repeat_session_analysis(swo),
        "ltv_by_acquisition_channel": cu.ltv_by_channel(users),
        "channel_efficiency": kp.channel_efficiency(swo, click_users),
        "rolling_kpis": kp.rolling_kpis(daily),
        "period_over_period": kp.period_over_period(daily),
        "executive_scorecard": kp.executive_scorecard(kp.monthly_metrics(orders, visits)),
    }
    return {n: write_table(df, os.path.join(out_dir, "gold", n)) for n, df in gold.items()}


def run(spark: SparkSession, sf_dir: str, out_dir: str) -> dict:
    return {"silver": build_silver(spark, sf_dir, out_dir), "gold": build_gold(spark, out_dir)}
