"""Customer gold: user summary, tiers, cohorts, repeat sessions, LTV,
executive and session KPIs, RFM (GD15-GD22, GD32, WN4, JN5, AG10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import avg_exact, count_true, month_key, pct, ratio
from ..functions.labels import customer_tier
from ..session import scratch_path

M4 = "decimal(18,4)"
RETENTION_DAYS = (60, 90, 180, 365)


def _sum_money(c):
    return F.sum(F.col(c).cast(M4)).cast("double")


def _avg_money(c):
    return F.try_divide(F.sum(F.col(c).cast(M4)).cast("double"), F.count(c).cast("double"))


def user_order_summary(orders: DataFrame, tier_bands=None) -> DataFrame:
    """GD15 + PRJ13 + AG10: one row per user. The acquisition channel is the
    channel of the user's *first* order (min_by on (ts, id)), not an
    arbitrary ``first``."""
    first = F.min_by("acquisition_channel", F.struct("order_ts", "order_id"))
    g = orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        _sum_money("gross_revenue").alias("gross_lifetime_value"),
        _sum_money("net_revenue").alias("net_lifetime_value"),
        _sum_money("net_margin").alias("lifetime_margin"),
        _avg_money("gross_revenue").alias("avg_order_value"),
        avg_exact("net_margin_pct").alias("avg_net_margin_pct"),
        F.min("order_ts").alias("first_order_ts"),
        F.max("order_ts").alias("last_order_ts"),
        count_true("has_refund").alias("orders_with_refund"),
        _sum_money("total_refund_usd").alias("total_refunds_received"),
        count_true("is_cross_sell_order").alias("cross_sell_orders"),
        F.countDistinct("primary_product_id").alias("distinct_products_ordered"),
        first.alias("acquisition_channel"))
    tier = customer_tier("gross_lifetime_value") if tier_bands is None else \
        customer_tier("gross_lifetime_value", tier_bands)
    return g.withColumns({
        "days_since_first_order": F.datediff(F.to_date("last_order_ts"), F.to_date("first_order_ts")),
        "is_repeat_buyer": F.col("total_orders") > 1,
        "customer_tier": tier,
        "refund_rate_pct": pct("orders_with_refund", "total_orders"),
    })


def tier_distribution(users: DataFrame) -> DataFrame:
    """GD16."""
    return users.groupBy("customer_tier", "is_repeat_buyer").agg(
        F.count("user_id").alias("customers"),
        _avg_money("gross_lifetime_value").alias("avg_ltv"))


def first_orders(orders: DataFrame) -> DataFrame:
    """WN4: each user's first order by (ts, id) via a partial ``min(struct)``
    aggregate — no per-user window, so a hot user is combined map-side."""
    f = orders.groupBy("user_id").agg(F.min(F.struct(
        "order_ts", "order_id", F.col("gross_revenue").alias("first_order_value"),
        "acquisition_channel")).alias("f"))
    return f.select("user_id", F.col("f.order_ts").alias("first_order_ts"),
                    F.col("f.first_order_value").alias("first_order_value"),
                    F.col("f.acquisition_channel").alias("acquisition_channel"),
                    month_key("f.order_ts").alias("acquisition_cohort"))


def acquisition_cohorts(orders: DataFrame, days=RETENTION_DAYS,
                        same_day_counts: bool = True) -> DataFrame:
    """GD17 (``same_day_counts=True``: a later order the same day counts,
    days are timestamp-ordered) / GD18 (False: only day difference > 0).

    JN5 without pairs: orders are counted per user and time, then per user and
    day (no task holds a hot user's orders; what is left of a user is a row a
    day), joined to the user's single first-order row, and rolled up to user and
    to cohort.
    """
    fo = first_orders(orders)
    by_time = orders.groupBy("user_id", F.col("order_ts").alias("_ts")).agg(F.count(F.lit(1)).alias("_n"))
    by_day = by_time.groupBy("user_id", F.to_date("_ts").alias("_day")).agg(
        F.sum("_n").alias("_n"), F.min(F.struct("_ts", "_n")).alias("_first"))
    j = by_day.join(fo.select("user_id", "first_order_ts"), "user_id", "inner")
    dd = F.datediff("_day", F.to_date("first_order_ts"))
    # On the first day only what comes after the first time counts, if at all.
    same_day = F.col("_n") - F.col("_first._n") if same_day_counts else F.lit(0)
    j = j.withColumn("_later", F.when(dd > 0, F.col("_n")).otherwise(same_day)).filter("_later > 0")
    per_user = (j.groupBy("user_id")
                .agg(F.min(dd).alias("days_to_first_repeat"), F.sum("_later").alias("repeat_order_count")))
    u = fo.join(per_user, "user_id", "left")
    aggs = [F.count("user_id").alias("new_customers"),
            _sum_money("first_order_value").alias("cohort_first_revenue"),
            _avg_money("first_order_value").alias("avg_first_order_value")]
    aggs += [count_true(F.col("days_to_first_repeat") <= d).alias(f"repeated_{d}d") for d in days]
    aggs += [ratio(F.sum("days_to_first_repeat"), F.count("days_to_first_repeat"))
             .alias("avg_days_to_repeat"),
             F.max("first_order_ts").alias("_last_first")]
    g = u.groupBy("acquisition_cohort", "acquisition_channel").agg(*aggs)
    # right-censoring: a cohort is complete for N days once the data's last
    # order is at least N days after the cohort's last acquisition
    data_end = orders.agg(F.max("order_ts").alias("_data_end"))
    g = g.crossJoin(data_end)   # one-row aggregate (JN7)
    g = g.withColumns({f"retention_rate_{d}d": pct(f"repeated_{d}d", "new_customers") for d in days})
    g = g.withColumns({f"is_complete_{d}d": F.datediff(F.to_date("_data_end"), F.to_date("_last_first")) >= d
                       for d in days})
    return g.drop("_last_first", "_data_end")


def repeat_session_analysis(swo: DataFrame) -> DataFrame:
    """GD19: new vs repeat session CVR (orders rolled up to session)."""
    g = swo.groupBy("is_repeat_session", "channel_group", "device_type").agg(
        F.count("website_session_id").alias("sessions"),
        F.sum("placed_order").cast("long").alias("orders"),
        F.sum("order_revenue").cast("double").alias("total_revenue"))
    return g.withColumns({"cvr_pct": pct("orders", "sessions"),
                          "avg_revenue_per_session": ratio("total_revenue", "sessions")})


def ltv_by_channel(users: DataFrame) -> DataFrame:
    """GD20: one row per acquisition channel; each user counted once."""
    g = users.filter(F.col("acquisition_channel").isNotNull()).groupBy("acquisition_channel").agg(
        F.count("user_id").alias("customers_acquired"),
        count_true("is_repeat_buyer").alias("repeat_buyers"),
        _avg_money("gross_lifetime_value").alias("avg_gross_ltv"),
        _avg_money("net_lifetime_value").alias("avg_net_ltv"),
        _avg_money("lifetime_margin").alias("avg_lifetime_margin"),
        ratio(F.sum("total_orders"), F.count("total_orders")).alias("avg_orders_per_customer"),
        avg_exact("avg_order_value").alias("avg_order_value"),
        avg_exact("refund_rate_pct").alias("avg_customer_refund_rate"),
        _sum_money("gross_lifetime_value").alias("total_channel_ltv"))
    return g.withColumn("repeat_buyer_rate_pct", pct("repeat_buyers", "customers_acquired"))


def executive_kpis(orders: DataFrame) -> DataFrame:
    """GD21: one row, 17 metrics (AG11)."""
    return orders.agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("user_id").alias("total_customers"),
        _sum_money("gross_revenue").alias("total_gross_revenue"),
        _sum_money("net_revenue").alias("total_net_revenue"),
        _sum_money("net_margin").alias("total_net_margin"),
        _sum_money("gross_cogs").alias("total_cogs"),
        avg_exact("gross_margin_pct").alias("avg_gross_margin_pct"),
        avg_exact("net_margin_pct").alias("avg_net_margin_pct"),
        _avg_money("gross_revenue").alias("avg_order_value"),
        count_true("has_refund").alias("total_refunded_orders"),
        _sum_money("total_refund_usd").alias("total_refund_value"),
        pct(count_true("has_refund"), F.count("order_id")).alias("overall_refund_rate_pct"),
        count_true("is_cross_sell_order").alias("cross_sell_orders"),
        pct(count_true("is_cross_sell_order"), F.count("order_id")).alias("cross_sell_rate_pct"),
        ratio(F.sum("items_purchased"), F.count("order_id")).alias("avg_items_per_order"),
        F.min("order_ts").alias("first_order_date"),
        F.max("order_ts").alias("last_order_date"))


def session_kpis(sessions: DataFrame) -> DataFrame:
    """GD22: one-row session summary."""
    rep = count_true("is_repeat_session")
    return sessions.agg(
        F.count("website_session_id").alias("total_sessions"),
        F.countDistinct("user_id").alias("unique_visitors"),
        rep.alias("repeat_sessions"),
        pct(rep, F.count("website_session_id")).alias("repeat_session_pct"),
        F.countDistinct("marketing_channel").alias("distinct_channels"))


#: Of a border's bracket, found by approximate percentiles, the part of all rows.
PERCENTILE_ACCURACY = 10_000


def _cuts(rows: DataFrame, group: str, value: str, wanted: dict, sizes: dict) -> dict:
    """Exact order statistics of many groups: ``wanted`` is {group: [ranks from 0]},
    ``sizes`` {group: rows}, the result {(group, rank): (value, rows below it, rows with it)}.

    Approximate percentiles give each rank a bracket; rows below the bracket are counted
    and values inside it grouped, by aggregates over all rows whose results have the size of
    the brackets. Where a bracket misses its rank, its group's whole range takes its place."""
    spark = rows.sparkSession
    ranks = [(g, k) for g, ks in wanted.items() for k in ks]
    if not ranks:
        return {}
    shares = sorted({p for g, k in ranks for p in (max(0.0, k / sizes[g] - 2 / PERCENTILE_ACCURACY),
                                                   min(1.0, (k + 1) / sizes[g] + 2 / PERCENTILE_ACCURACY))})
    near = {r[0]: dict(zip(shares, r[1])) for r in rows.groupBy(group).agg(
        F.percentile_approx(value, shares, PERCENTILE_ACCURACY)).collect()}
    brackets = [(g, k, near[g][max(0.0, k / sizes[g] - 2 / PERCENTILE_ACCURACY)],
                 near[g][min(1.0, (k + 1) / sizes[g] + 2 / PERCENTILE_ACCURACY)]) for g, k in ranks]
    out = {}
    for widen in (False, True):
        if widen:
            brackets = [(g, k, None, None) for g, k, *_ in brackets if (g, k) not in out]
        if not brackets:
            break
        kind = rows.schema[value].dataType.simpleString()
        group_kind = rows.schema[group].dataType.simpleString()
        # one row a border: a few dozen
        sides = F.broadcast(spark.createDataFrame(brackets, f"_g {group_kind}, _k bigint, _lo {kind}, _hi {kind}"))
        j = rows.join(sides, F.col(group) == F.col("_g"))
        below = F.coalesce(F.col(value) < F.col("_lo"), F.lit(False))
        inside = j.where(below | (F.col("_hi").isNull() | (F.col(value) <= F.col("_hi"))))
        seen = inside.groupBy("_g", "_k", F.when(~below, F.col(value)).alias("_v"), below.alias("_b")).count()
        w = Window.partitionBy("_g", "_k").orderBy(F.desc("_b"), "_v").rowsBetween(Window.unboundedPreceding, -1)
        at = seen.withColumn("_before", F.coalesce(F.sum("count").over(w), F.lit(0)))
        hit = at.where(~F.col("_b") & (F.col("_before") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("count")))
        out |= {(r._g, r._k): (r._v, r._before, r["count"]) for r in hit.collect()}  # a row a border
    return out


def with_tiles(rows: DataFrame, scores: dict[str, tuple[str, bool]], tie: str, n: int) -> DataFrame:
    """``ntile(n) OVER (ORDER BY value, tie)`` for several values at once, without sorting
    all rows: ``scores`` is {new column: (value column, descending)}; ``tie`` tells all rows
    apart. The first row of each tile is found by exact counts, for all scores together, and
    every row is then compared with the tiles' first rows: no row is moved. Nulls of a value
    come first (last if descending), as Spark orders them; ``tie`` is a whole number."""
    total = rows.count()
    size, more = divmod(total, n)
    starts = [k * size + min(k, more) for k in range(1, n) if k * size + min(k, more) < total]
    if not starts:
        return rows.withColumns({c: F.lit(1).cast("int") for c in scores})

    def key(column, descending):  # ordered as numbers; nulls as Spark has them
        v = F.col(column).cast("double")
        return F.coalesce(-v if descending else v, F.lit(float("inf" if descending else "-inf")))

    names = list(scores)
    number = F.coalesce(F.col(tie).cast("bigint"), F.lit(-2**63))  # nulls first
    tall = rows.select(number.alias(tie), F.explode(F.array(*[F.struct(F.lit(i).alias("s"), key(*scores[c]).alias("v"))
                                                for i, c in enumerate(names)])).alias("x")).select(tie, "x.s", "x.v")
    every = range(len(names))
    values = _cuts(tall, "s", "v", {i: starts for i in every}, {i: total for i in every})
    # where a border falls among equal values, the tie tells
    groups = sorted({(s, v) for (s, k), (v, before, count) in values.items() if before < k})
    ties = {}
    if groups:
        hits = F.broadcast(rows.sparkSession.createDataFrame([(i, s, v) for i, (s, v) in enumerate(groups)], "g int, _s int, _v double"))
        same = tall.join(hits, (F.col("s") == F.col("_s")) & (F.col("v") == F.col("_v"))).select("g", tie)
        counts = {i: next(n for (s, _), (v, _, n) in values.items() if (s, v) == g) for i, g in enumerate(groups)}
        wanted = {i: [k - before for (s, k), (v, before, _) in values.items() if (s, v) == g and before < k]
                  for i, g in enumerate(groups)}
        ties = {(groups[i], k): t for (i, k), (t, _, _) in _cuts(same, "g", tie, wanted, counts).items()}
    out = {}
    for i, c in enumerate(names):
        tile, v = F.lit(1), key(*scores[c])
        for k in starts:
            cut, before, _ = values[i, k]
            first = F.lit(cut).cast("double")
            at = ties.get(((i, cut), k - before))
            reached = (v >= first) if before == k else ((v > first) | ((v == first) & (number >= F.lit(at))))
            tile = tile + reached.cast("int")
        out[c] = tile.cast("int")
    return rows.withColumns(out)


def rfm(orders: DataFrame, as_of=None, buckets: int = 5) -> DataFrame:
    """GD32: recency / frequency / monetary per user + quintile scores (the most
    recent, frequent and valuable users score ``buckets``; ties by user id).

    Average days between orders = (last - first) / (orders - 1), which equals
    the mean of consecutive gaps without a per-user ordered window.
    """
    end = orders.agg(F.max(F.to_date("order_ts")).alias("_as_of")) if as_of is None else None
    u = orders.groupBy("user_id").agg(
        F.max(F.to_date("order_ts")).alias("last_order_date"),
        F.min(F.to_date("order_ts")).alias("first_order_date"),
        F.count("order_id").alias("frequency"),
        _sum_money("gross_revenue").alias("monetary"))
    if end is not None:
        u = u.crossJoin(end)
    else:
        u = u.withColumn("_as_of", F.lit(as_of).cast("date"))
    u = u.withColumns({
        "recency_days": F.datediff("_as_of", "last_order_date"),
        "avg_days_between_orders": F.when(
            F.col("frequency") > 1,
            ratio(F.datediff("last_order_date", "first_order_date"), F.col("frequency") - 1)),
    }).drop("_as_of")
    path = scratch_path(orders.sparkSession, "rfm")
    u.write.parquet(path)  # a row per user, read for the borders and for the result
    u = orders.sparkSession.read.schema(u.schema).parquet(path)
    return with_tiles(u, {"recency_score": ("recency_days", True), "frequency_score": ("frequency", False),
                          "monetary_score": ("monetary", False)}, "user_id", buckets)


def cohort_retention_keyed(orders: DataFrame, days=RETENTION_DAYS) -> DataFrame:
    """GD18 in the dashboard's shape (JN9 + AG4): repeat buyers per (cohort, channel) and
    window. A user's cohort and channel are those of the first order, so a repeat order
    meets them on (user, cohort, channel), a null channel too. Distinct users are counted
    without distinct: orders shrink to a row per user and day, a user to one row with a flag
    for each window, and the flags are added up."""
    fo = first_orders(orders)
    o = orders.groupBy("user_id", F.to_date("order_ts").alias("_day")).agg(F.lit(1).alias("_one"))
    gap = F.datediff("_day", F.to_date("first_order_ts"))
    users = (fo.join(o, fo.user_id.eqNullSafe(o.user_id), "left").drop(o.user_id)
             .groupBy("user_id", "acquisition_cohort", "acquisition_channel")
             .agg(*[F.max(F.coalesce((gap > 0) & (gap <= d), F.lit(False))).alias(f"_{d}") for d in days]))
    named = F.col("user_id").isNotNull()  # a distinct count leaves out the null user
    g = users.groupBy("acquisition_cohort", "acquisition_channel").agg(
        count_true(named).alias("new_customers"), *[count_true(named & F.col(f"_{d}")).alias(f"repeated_{d}d") for d in days])
    return g.withColumns({f"retention_rate_{d}d": pct(f"repeated_{d}d", "new_customers") for d in days})
