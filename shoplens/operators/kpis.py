"""KPI gold: daily metrics on a dense calendar, rolling and period-over-period
KPIs, scorecard, channel efficiency, forecast, inflections, biggest funnel
drop-off, anomalies (GD23-GD31, WN7-WN12, WN14, AG13).

Windows without PARTITION BY run only after aggregation to day / month /
channel grain, where the row count is bounded by the calendar or by the
channel list, never by traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import micro_units, month_index, month_key, month_start, pct, pct_change, ratio
from ..functions.labels import rag_status, trend_label
from .marketing import previous_period

M4 = "decimal(18,4)"
D12 = "decimal(38,6)"


def daily_metrics(orders: DataFrame, swo: DataFrame | None = None,
                  visits: DataFrame | None = None) -> DataFrame:
    """GD23: per day orders, revenue, sessions, CVR, refund rate.

    With ``visits`` (session_ts, placed_order) orders count on their own day and
    sessions on theirs; the two sides are joined day by day.

    With sessions (``swo``: sessions with per-session order roll-up) days are
    *session* days and orders are attributed to their session's day; without
    sessions (order-only data) days are order days and session columns are
    NULL. Both sides are aggregated to day grain before anything is joined.
    """
    if swo is not None:
        return (swo.groupBy(F.to_date("session_ts").alias("metric_date"))
                .agg(F.sum("session_orders").cast("long").alias("daily_orders"),
                     F.sum(F.col("order_revenue").cast(M4)).cast(M4).alias("daily_revenue"),
                     F.count(F.lit(1)).alias("daily_sessions"),
                     F.sum("placed_order").cast("long").alias("converted_sessions"),
                     F.sum("session_refunded_orders").cast("long").alias("refunded_orders")))
    o = (orders.groupBy(F.to_date("order_ts").alias("metric_date"))
         .agg(F.count(F.lit(1)).alias("daily_orders"),
              F.sum(F.col("gross_revenue").cast(M4)).cast(M4).alias("daily_revenue"),
              F.sum(F.when(F.col("has_refund"), 1).otherwise(0)).cast("long").alias("refunded_orders")))
    columns = ["metric_date", "daily_orders", "daily_revenue", "daily_sessions", "converted_sessions",
               "refunded_orders"]
    if visits is None:
        return o.withColumns({c: F.lit(None).cast("long") for c in ("daily_sessions", "converted_sessions")}
                             ).select(*columns)
    v = (visits.groupBy(F.to_date("session_ts").alias("metric_date"))
         .agg(F.count(F.lit(1)).alias("daily_sessions"),
              F.sum("placed_order").cast("long").alias("converted_sessions")))
    return o.join(v, "metric_date", "full").select(*columns)


def dense_calendar(daily: DataFrame, date_col: str = "metric_date") -> DataFrame:
    """Every day between the first and last metric date, zero-filled counts.

    The calendar comes from a one-row min/max aggregate exploded with
    ``sequence``: its size is the number of days, independent of traffic.
    """
    bounds = daily.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    cal = bounds.select(F.explode(F.sequence("_lo", "_hi")).alias(date_col))
    d = cal.join(daily, date_col, "left")
    return d.withColumns({
        "daily_orders": F.coalesce("daily_orders", F.lit(0)).cast("long"),
        "daily_revenue": F.coalesce("daily_revenue", F.lit(0).cast(M4)).cast(M4),
        "refunded_orders": F.coalesce("refunded_orders", F.lit(0)).cast("long"),
    })


def daily_kpis(orders: DataFrame, swo: DataFrame | None = None, visits: DataFrame | None = None) -> DataFrame:
    """GD23 on a dense calendar, with CVR and refund rate (NULL-guarded)."""
    d = dense_calendar(daily_metrics(orders, swo, visits))
    if swo is not None or visits is not None:
        d = d.withColumns({"daily_sessions": F.coalesce("daily_sessions", F.lit(0)).cast("long"),
                           "converted_sessions": F.coalesce("converted_sessions", F.lit(0)).cast("long")})
    return d.withColumns({
        "daily_cvr": ratio("converted_sessions", "daily_sessions"),
        "daily_refund_rate": ratio("refunded_orders", "daily_orders"),
    })


DOUBLE_METRICS = {"daily_cvr", "monthly_cvr"}


def _wavg(c, w):
    """Window average with an exact sum (order-independent): DECIMAL for
    money and counts, integer millionths for DOUBLE rates."""
    if c in DOUBLE_METRICS:
        x = micro_units(c)
        return F.try_divide(F.sum(x).over(w).cast("double"), F.count(x).over(w).cast("double")) / F.lit(1e6)
    x = F.col(c).cast(D12)
    return F.try_divide(F.sum(x).over(w).cast("double"), F.count(x).over(w).cast("double"))


def rolling_kpis(daily: DataFrame, spans=(7, 30, 90),
                 metrics=("daily_orders", "daily_revenue", "daily_sessions", "daily_cvr")) -> DataFrame:
    """GD24 + WN8: trailing averages over the last N calendar days."""
    out = daily
    for n in spans:
        w = Window.orderBy("metric_date").rowsBetween(-(n - 1), 0)
        out = out.withColumns({f"{m.replace('daily_', '')}_{n}d_avg": _wavg(m, w) for m in metrics})
    return out


def period_over_period(daily: DataFrame, lags=(("wow", 7), ("mom", 30), ("yoy", 365)),
                       metrics=("daily_orders", "daily_revenue")) -> DataFrame:
    """GD25 + WN7 + PRJ15: value N days earlier (dense calendar, so row
    offset = day offset), % change, and a trend label per lag."""
    w = Window.orderBy("metric_date")
    out = daily
    for m in metrics:
        base = m.replace("daily_", "")
        for name, n in lags:
            prev = F.lag(F.col(m), n).over(w)
            out = out.withColumn(f"{base}_prev_{n}d", prev.cast("double") if m == "daily_revenue" else prev)
            out = out.withColumn(f"{base}_{name}_pct", pct_change(m, f"{base}_prev_{n}d"))
            out = out.withColumn(f"{base}_{name}_trend", trend_label(f"{base}_{name}_pct"))
    cvr_change = pct_change("daily_cvr", F.lag("daily_cvr", 30).over(w))
    return out.withColumn("cvr_trend_30d", trend_label(cvr_change))


def monthly_metrics(orders: DataFrame, swo: DataFrame | None = None) -> DataFrame:
    """Month grain: orders, revenue, margin, CVR, refund and cross-sell rate."""
    o = (orders.groupBy(month_key("order_ts").alias("score_month"))
         .agg(F.count(F.lit(1)).alias("monthly_orders"),
              F.sum(F.col("gross_revenue").cast(M4)).cast(M4).alias("_rev"),
              F.sum(F.col("net_margin").cast(M4)).cast(M4).alias("_mar"),
              F.sum(F.when(F.col("has_refund"), 1).otherwise(0)).alias("_ref"),
              F.sum(F.when(F.col("is_cross_sell_order"), 1).otherwise(0)).alias("_xs")))
    if swo is not None:
        s = (swo.groupBy(month_key("session_ts").alias("score_month"))
             .agg(F.count(F.lit(1)).alias("_sess"), F.sum("placed_order").alias("_conv")))
        o = o.join(s, "score_month", "full")
        cvr = ratio("_conv", "_sess")
    else:
        cvr = F.lit(None).cast("double")
    return o.select(
        "score_month", F.coalesce("monthly_orders", F.lit(0)).alias("monthly_orders"),
        F.col("_rev").cast("double").alias("monthly_revenue"),
        F.col("_mar").cast("double").alias("monthly_margin"),
        cvr.alias("monthly_cvr"),
        ratio("_ref", "monthly_orders").alias("monthly_refund_rate"),
        ratio("_xs", "monthly_orders").alias("monthly_cross_sell_rate"))


# --- fixed values: scorecard ------------------------------------------------
REFUND_RATE_TARGET = 0.05
CROSS_SELL_TARGET = 0.08
SCORE_WEIGHTS = (0.25, 0.25, 0.25, 0.25)   # growth, cvr, refund, cross-sell
# ---------------------------------------------------------------------------


def month_number(key: str) -> Column:
    """Calendar number of a 'yyyy-MM' key."""
    return month_index(month_start(key))


def executive_scorecard(monthly: DataFrame, refund_target=REFUND_RATE_TARGET,
                        cross_sell_target=CROSS_SELL_TARGET, weights=SCORE_WEIGHTS) -> DataFrame:
    """GD26 + WN9 + WN10 + PRJ17: 4 component scores, composite, RAG. The prior
    month is the calendar month before; growth and CVR without a value to compare
    score 50."""
    # Three calendar months, whether or not each has a row.
    w = Window.orderBy(month_number("score_month")).rangeBetween(-2, 0)
    m = previous_period(monthly, [], "score_month", ["monthly_revenue"], "_prior")
    m = m.withColumnRenamed("monthly_revenue_prior", "prior_month_revenue").withColumn(
        "cvr_90d_avg", _wavg("monthly_cvr", w))
    g = F.try_divide(F.col("monthly_revenue") - F.col("prior_month_revenue"),
                     F.col("prior_month_revenue"))
    growth = (F.when(F.col("prior_month_revenue").isNull(), 50.0).when(g > 0.10, 100.0)
              .when(g > 0.05, 85.0).when(g > 0, 70.0).when(g > -0.05, 50.0).otherwise(25.0))
    cvr, avg = F.col("monthly_cvr"), F.col("cvr_90d_avg")
    cvr_s = (F.when(cvr.isNull(), 50.0)  # no sessions: as for no prior revenue
             .when(cvr > avg * 1.10, 100.0).when(cvr > avg * 1.05, 85.0)
             .when(cvr >= avg * 0.95, 70.0).when(cvr >= avg * 0.90, 50.0).otherwise(25.0))
    rr = F.col("monthly_refund_rate")
    ref_s = (F.when(rr < refund_target * 0.5, 100.0).when(rr < refund_target * 0.75, 85.0)
             .when(rr <= refund_target, 70.0).when(rr <= refund_target * 1.25, 50.0).otherwise(25.0))
    xs = F.col("monthly_cross_sell_rate")
    xs_s = (F.when(xs > cross_sell_target * 1.25, 100.0).when(xs > cross_sell_target * 1.10, 85.0)
            .when(xs >= cross_sell_target, 70.0).when(xs >= cross_sell_target * 0.75, 50.0)
            .otherwise(25.0))
    m = m.withColumns({"revenue_growth_score": growth, "cvr_performance_score": cvr_s,
                       "refund_rate_score": ref_s, "cross_sell_rate_score": xs_s})
    comp = (F.col("revenue_growth_score") * weights[0] + F.col("cvr_performance_score") * weights[1]
            + F.col("refund_rate_score") * weights[2] + F.col("cross_sell_rate_score") * weights[3])
    m = m.withColumn("composite_performance_score", comp)
    return m.withColumn("rag_status", rag_status("composite_performance_score"))


# --- fixed values: channel efficiency ---------------------------------------
EFFICIENCY_WEIGHTS = {"revenue_per_session_rank": 0.25, "margin_per_session_rank": 0.25,
                      "refund_rate_rank": 0.20, "repeat_rate_rank": 0.15, "ltv_rank": 0.15}
EFFICIENCY_TIERS = [(2, "TIER_1_HIGH_EFFICIENCY"), (5, "TIER_2_STANDARD")]
EFFICIENCY_LAST = "TIER_3_LOW_EFFICIENCY"
# ---------------------------------------------------------------------------


def channel_efficiency(swo: DataFrame, users_first_channel: DataFrame,
                       channel_col: str = "marketing_channel", min_sessions: int = 100) -> DataFrame:
    """GD27 + WN11 + WN12 + FLT2: five dense ranks, weighted composite, tier.

    Per-channel figures come from session-grain rows (orders already rolled
    up to session), LTV from a one-row-per-user table keyed by the user's
    first-touch channel, so nothing fans out.
    """
    c = swo.groupBy(channel_col).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("session_orders").cast("long").alias("total_orders"),
        F.sum("placed_order").cast("long").alias("_conv"),
        F.sum(F.col("order_revenue").cast(M4)).cast("double").alias("_rev"),
        F.sum(F.col("order_margin").cast(M4)).cast("double").alias("_mar"),
        F.sum("session_refunded_orders").cast("long").alias("_ref"),
        F.sum(F.when(F.col("is_repeat_session"), 1).otherwise(0)).alias("_rep"))
    ltv = users_first_channel.groupBy(F.col("acquisition_channel").alias(channel_col)).agg(
        F.try_divide(F.sum(F.col("gross_lifetime_value").cast(M4)).cast("double"),
                     F.count("gross_lifetime_value").cast("double")).alias("avg_ltv_acquired"))
    c = c.join(ltv, channel_col, "left").filter(F.col("total_sessions") > min_sessions)
    c = c.select(channel_col, "total_sessions", "total_orders",
                 ratio("_conv", "total_sessions").alias("cvr"),
                 ratio("_rev", "total_sessions").alias("revenue_per_session"),
                 ratio("_mar", "total_sessions").alias("margin_per_session"),
                 ratio("_ref", "total_orders").alias("refund_rate"),
                 ratio("_rep", "total_sessions").alias("repeat_customer_rate"),
                 "avg_ltv_acquired")
    w = Window.orderBy
    c = c.withColumns({
        "revenue_per_session_rank": F.dense_rank().over(w(F.col("revenue_per_session").desc_nulls_last())),
        "margin_per_session_rank": F.dense_rank().over(w(F.col("margin_per_session").desc_nulls_last())),
        "refund_rate_rank": F.dense_rank().over(w(F.col("refund_rate").asc_nulls_last())),
        "repeat_rate_rank": F.dense_rank().over(w(F.col("repeat_customer_rate").desc_nulls_last())),
        "ltv_rank": F.dense_rank().over(w(F.col("avg_ltv_acquired").desc_nulls_last())),
    })
    comp = None
    for k, wt in EFFICIENCY_WEIGHTS.items():
        term = F.col(k) * F.lit(wt)
        comp = term if comp is None else comp + term
    c = c.withColumn("composite_efficiency_rank", comp)
    r = F.dense_rank().over(w("composite_efficiency_rank"))
    tier = None
    for hi, label in EFFICIENCY_TIERS:
        tier = F.when(r <= hi, label) if tier is None else tier.when(r <= hi, label)
    return c.withColumn("efficiency_tier", tier.otherwise(EFFICIENCY_LAST))


def monthly_revenue(orders: DataFrame, ts_col="order_ts", rev_col="gross_revenue") -> DataFrame:
    return (orders.groupBy(month_key(ts_col).alias("year_month"))
            .agg(F.sum(F.col(rev_col).cast(M4)).cast("double").alias("revenue")))


def revenue_forecast(monthly: DataFrame, history: int = 6, horizon: int = 3) -> DataFrame:
    """GD28 + WN14 + AG13 + SE1: OLS on the last ``history`` months by month
    index, ``horizon`` months ahead, appended to the actuals."""
    # One row a month: the ordered window also fixes the order of the sums.
    number = month_number("year_month")
    m = monthly.withColumn("month_index", number - F.first(number).over(Window.orderBy("year_month")) + 1)
    last = m.agg(F.max("year_month").alias("_last"))
    recent = (m.crossJoin(last)
              .filter(month_start("year_month") >= F.add_months(month_start("_last"), -(history - 1))))
    fit = recent.agg(F.regr_slope(F.col("revenue"), F.col("month_index").cast("double")).alias("slope"),
                     F.regr_intercept(F.col("revenue"), F.col("month_index").cast("double")).alias("intercept"),
                     F.max("month_index").alias("max_index"), F.max("year_month").alias("last_month"))
    ahead = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    fc = ahead.select(
        F.date_format(F.add_months(month_start("last_month"), F.col("h")), "yyyy-MM").alias("year_month"),
        (F.col("intercept") + F.col("slope") * (F.col("max_index") + F.col("h"))).alias("revenue"),
        F.lit("Forecast").alias("type"))
    actual = monthly.select("year_month", "revenue", F.lit("Actual").alias("type"))
    return actual.unionByName(fc)


def revenue_inflections(monthly: DataFrame, threshold: float = 20.0) -> DataFrame:
    """GD29 + WN10: months whose revenue moved more than ``threshold`` % MoM."""
    m = previous_period(monthly, [], "year_month", ["revenue"], "_prev").withColumnRenamed(
        "revenue_prev", "prev_month_revenue")
    m = m.withColumn("pct_change", pct_change("revenue", "prev_month_revenue"))
    shown = F.format_number(F.abs("pct_change"), 1)
    m = m.filter(F.abs("pct_change") > threshold)
    return m.withColumns({
        "annotation_label": F.when(F.col("pct_change") > threshold,
                                   F.concat(F.lit("Revenue up "), shown, F.lit("%")))
        .otherwise(F.concat(F.lit("Revenue down "), shown, F.lit("%"))),
        "direction": F.when(F.col("pct_change") > threshold, "Increase").otherwise("Decrease"),
    })


# --- fixed values: revenue-leakage factor for a lost funnel session ---------
LEAKAGE_FACTOR = 0.05
# ---------------------------------------------------------------------------


def funnel_dropoff(rates_overall: DataFrame, orders: DataFrame,
                   factor: float = LEAKAGE_FACTOR) -> DataFrame:
    """GD30 + SE4 + JN7 + SO3: step losses, leakage = lost x AOV x factor,
    and a flag on the single biggest drop (ties -> earliest step)."""
    steps = ["sessions_entered", "reached_products", "reached_product_page", "reached_cart",
             "reached_shipping", "reached_billing", "reached_thankyou"]
    names = ["Entry", "Products", "Product Page", "Cart", "Shipping", "Billing", "Order"]
    parts = []
    for i in range(1, len(steps)):
        parts.append(f"'{names[i - 1]} -> {names[i]}', {i}, CAST({steps[i - 1]} AS BIGINT), "
                     f"CAST({steps[i]} AS BIGINT)")
    u = rates_overall.selectExpr(
        f"stack({len(parts)}, {', '.join(parts)}) AS (transition, step_order, from_sessions, to_sessions)")
    aov = orders.agg(F.try_divide(F.sum(F.col("gross_revenue").cast(M4)).cast("double"),
                                  F.count("gross_revenue").cast("double")).alias("avg_order_value"))
    u = u.crossJoin(aov).withColumns({
        "lost_sessions": F.col("from_sessions") - F.col("to_sessions"),
        "drop_pct": pct(F.col("from_sessions") - F.col("to_sessions"), "from_sessions"),
    })
    u = u.withColumn("estimated_revenue_leakage",
                     F.col("lost_sessions").cast("double") * F.col("avg_order_value") * factor)
    top = F.row_number().over(Window.orderBy(F.col("lost_sessions").desc(), "step_order"))
    return u.withColumn("is_biggest_dropoff", top == 1)


def anomalies(daily: DataFrame, metric: str = "daily_revenue", lookback: int = 28,
              z: float = 3.0) -> DataFrame:
    """GD31: rolling z-score against the previous ``lookback`` days.

    mean and variance come from exact DECIMAL sums over the frame, in whole
    cents (a day's revenue up to 10^15), so the score does not depend on summation
    order.
    """
    w = Window.orderBy("metric_date").rowsBetween(-lookback, -1)
    x = F.col(metric).cast(M4)
    n = F.count(x).over(w).cast("double")
    # n * sum(x^2) - sum(x)^2 over cents as whole numbers: nothing cancels before
    # the subtraction, however small the deviation is against the mean.
    cents = F.round(x * 100).cast("decimal(19,0)")
    s = F.sum(cents).over(w)
    ss = F.sum((cents * cents).cast("decimal(38,0)")).over(w)
    spread = (F.count(x).over(w).cast("decimal(5,0)") * ss).cast("decimal(38,0)") - (
        s.cast("decimal(19,0)") * s.cast("decimal(19,0)")).cast("decimal(38,0)")
    mean = F.try_divide(F.sum(x).over(w).cast("double"), n)
    sd = F.sqrt(F.try_divide(spread.cast("double"), n * (n - 1.0))) / 100.0
    out = daily.withColumns({"baseline_mean": mean, "baseline_std": sd})
    out = out.withColumn("z_score", F.try_divide(F.col(metric).cast("double") - F.col("baseline_mean"),
                                                 F.when(F.col("baseline_std") > 0, F.col("baseline_std"))))
    return out.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > z, F.lit(False)))
