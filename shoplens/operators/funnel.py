"""Funnel pivot, depth, entry page and step rates (AG5-AG7, PRJ18, WN3, GD3,
SE3/SE4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import count_true, pct, ratio, seen
from ..functions.labels import exit_step

# --- fixed values: page flags (name, kind, pattern) ------------------------
# kind 'eq' = exact URL, 'like' = SQL LIKE pattern
PAGE_FLAGS = [
    ("saw_home", "eq", "/home"),
    ("saw_lander", "like", "/lander%"),
    ("saw_lander_1", "eq", "/lander-1"),
    ("saw_lander_2", "eq", "/lander-2"),
    ("saw_lander_3", "eq", "/lander-3"),
    ("saw_lander_4", "eq", "/lander-4"),
    ("saw_lander_5", "eq", "/lander-5"),
    ("saw_products", "eq", "/products"),
    ("saw_product_page", "like", "/the-%"),
    ("saw_mr_fuzzy", "eq", "/the-original-mr-fuzzy"),
    ("saw_love_bear", "eq", "/the-forever-love-bear"),
    ("saw_sugar_panda", "eq", "/the-birthday-sugar-panda"),
    ("saw_mini_bear", "eq", "/the-hudson-river-mini-bear"),
    ("saw_cart", "eq", "/cart"),
    ("saw_shipping", "eq", "/shipping"),
    ("saw_billing_any", "like", "/billing%"),
    ("saw_billing_v1", "eq", "/billing"),
    ("saw_billing_v2", "eq", "/billing-2"),
    ("converted", "eq", "/thank-you-for-your-order"),
]
# funnel depth: first matching rule wins, else 1 (entry)
DEPTH_RULES = [
    (7, "eq", "/thank-you-for-your-order"),
    (6, "like", "/billing%"),
    (5, "eq", "/shipping"),
    (4, "eq", "/cart"),
    (3, "like", "/the-%"),
    (2, "eq", "/products"),
]
# funnel steps for rates: (reached column, flag, pct column)
FUNNEL_STEPS = [
    ("reached_products", "saw_products", "pct_to_products"),
    ("reached_product_page", "saw_product_page", "pct_to_product_page"),
    ("reached_cart", "saw_cart", "pct_to_cart"),
    ("reached_shipping", "saw_shipping", "pct_to_shipping"),
    ("reached_billing", "saw_billing_any", "pct_to_billing"),
    ("reached_thankyou", "converted", "pct_to_order"),
]
DROPOFF_NAMES = ["dropoff_entry_to_products", "dropoff_products_to_page",
                 "dropoff_page_to_cart", "dropoff_cart_to_shipping",
                 "dropoff_shipping_to_billing", "dropoff_billing_to_order"]
STEP_LABELS = ["Sessions entered", "Reached products", "Viewed product page",
               "Added to cart", "Reached shipping", "Reached billing", "Placed order"]
# ----------------------------------------------------------------------------


def _match(url, kind, pattern):
    return url.like(pattern) if kind == "like" else (url == pattern)


def funnel_steps(pageviews: DataFrame, flags=PAGE_FLAGS, depth_rules=DEPTH_RULES) -> DataFrame:
    """AG5 + AG6 + AG7 + PRJ18: one row per session.

    A single hash aggregate keyed by session; all flags are partial
    aggregates, so a session with millions of hits is combined map-side.
    """
    url = F.col("pageview_url")
    depth = None
    for d, kind, pat in depth_rules:
        cond = _match(url, kind, pat)
        depth = F.when(cond, d) if depth is None else depth.when(cond, d)
    aggs = [seen(_match(url, kind, pat)).alias(name) for name, kind, pat in flags]
    aggs += [F.max(depth.otherwise(1)).alias("funnel_depth"),
             F.count(F.lit(1)).alias("total_pageviews_in_session")]
    return (pageviews.groupBy("website_session_id").agg(*aggs)
            .withColumn("funnel_exit_step", exit_step("funnel_depth")))


def entry_pages(pageviews: DataFrame) -> DataFrame:
    """WN3: first URL of each session (lowest pageview id), partial aggregate."""
    return (pageviews.groupBy("website_session_id")
            .agg(F.min_by("pageview_url", "website_pageview_id").alias("entry_page")))


def funnel_rates(df: DataFrame, group_cols, steps=FUNNEL_STEPS, with_step_rates=True) -> DataFrame:
    """GD3: sessions entered, reached per step, % of entry, drop-off.

    ``dropoff_*`` is the difference of entry percentages (the published
    definition); ``step_rate_*`` adds the true step-over-step rate
    reached_n / reached_(n-1).
    """
    aggs = [F.count("website_session_id").alias("sessions_entered")]
    aggs += [count_true(flag).alias(reached) for reached, flag, _ in steps]
    out = df.groupBy(*group_cols).agg(*aggs)
    out = out.withColumns({p: pct(reached, "sessions_entered") for reached, _, p in steps})
    prev_pct = F.lit(100.0)
    drops = {}
    for (reached, _, p), name in zip(steps, DROPOFF_NAMES):
        drops[name] = prev_pct - F.col(p)
        prev_pct = F.col(p)
    out = out.withColumns(drops)
    if with_step_rates:
        prev = "sessions_entered"
        rates = {}
        for reached, _, _ in steps:
            rates["step_rate_" + reached.replace("reached_", "")] = ratio(reached, prev)
            prev = reached
        out = out.withColumns(rates)
    return out


def unpivot_funnel(rates: DataFrame, id_cols=("channel_group", "device_type"),
                   steps=FUNNEL_STEPS) -> DataFrame:
    """SE3: 7 rows per group (step label, sessions remaining, % remaining)."""
    parts = ["'{}', CAST(sessions_entered AS DOUBLE), CAST(100.0 AS DOUBLE), 1".format(STEP_LABELS[0])]
    for i, (reached, _, p) in enumerate(steps, start=2):
        parts.append(f"'{STEP_LABELS[i - 1]}', CAST({reached} AS DOUBLE), CAST({p} AS DOUBLE), {i}")
    expr = f"stack({len(parts)}, {', '.join(parts)}) AS (funnel_step, sessions_remaining, pct_remaining, step_order)"
    return rates.selectExpr(*id_cols, expr)
