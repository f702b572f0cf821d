"""Properties over the whole sf0.001 tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from given_data import SF_SMALL
from shoplens.plans.worlds import ClickWorld, CommerceWorld


def q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_depth_counts_never_rise(spark):
    f = ClickWorld(spark, SF_SMALL).funnel
    counts = [f.filter(F.col("funnel_depth") >= n).count() for n in range(1, 8)]
    assert counts == sorted(counts, reverse=True)


def test_one_row_per_session_and_order(spark):
    w = ClickWorld(spark, SF_SMALL)
    for df, key in ((w.sessions, "website_session_id"), (w.funnel, "website_session_id"),
                    (w.orders, "order_id"), (CommerceWorld(spark, SF_SMALL).orders, "order_id")):
        assert df.groupBy(key).count().filter("count > 1").count() == 0


def test_net_is_gross_minus_refunds(spark):
    o = CommerceWorld(spark, SF_SMALL).orders
    bad = o.filter(F.abs(F.col("net_revenue") - (F.col("gross_revenue") - F.col("total_refund_usd"))) > 1e-6)
    assert bad.count() == 0


def test_shares_sum_to_100(spark):
    mix = q(spark, "gd14_product_channel_mix")
    tot = mix.groupBy("primary_product_name").agg(F.sum("channel_order_share_pct").alias("s")).collect()
    assert all(abs(r.s - 100.0) < 1e-9 for r in tot)
    dist = q(spark, "dq13_source_distribution").agg(F.sum("pct_of_total")).collect()[0][0]
    assert abs(dist - 100.0) < 1e-9


def test_merge_idempotent_and_as_of_latest(spark):
    r = q(spark, "mrg12_idempotency").first()
    assert r.rows_once == r.rows_twice > 0 and (r.only_once, r.only_twice, r.rows_changed) == (0, 0, 0)
    latest = q(spark, "mrg6_as_of_latest")
    from shoplens.plans.q_incremental import _snapshots
    assert latest.count() == _snapshots(spark, SF_SMALL)[1].count()


def test_hot_user_is_dealt_by_day(spark):
    """Without broadcast joins the sessions of one user still go to many tasks."""
    import re
    from shoplens.plans.worlds import ClickWorld
    from shoplens.operators.sessions import enrich_sessions
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = enrich_sessions(ClickWorld(spark, SF_SMALL).raw_sessions)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    window = plan.index("row_number()")
    assert re.search(r"hashpartitioning\(user_id#\d+L?, _day#\d+", plan[window:])


def test_scorecard_with_gaps(spark):
    """A missing month is no prior month, and no sessions is not a bad CVR."""
    from shoplens.operators import kpis as kp
    rows = [("2020-01", 5, 100.0, 10.0, 0.5, 0.0, 0.0), ("2020-03", 5, 200.0, 10.0, None, 0.0, 0.0),
            ("2020-04", 5, 250.0, 10.0, 0.9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "score_month string, monthly_orders long, monthly_revenue double, "
                               "monthly_margin double, monthly_cvr double, monthly_refund_rate double, "
                               "monthly_cross_sell_rate double")
    out = {r.score_month: r for r in kp.executive_scorecard(df).collect()}
    assert out["2020-03"].prior_month_revenue is None and out["2020-03"].revenue_growth_score == 50
    assert out["2020-03"].cvr_performance_score == 50 and out["2020-04"].prior_month_revenue == 200.0
    assert out["2020-04"].cvr_90d_avg == 0.9  # January is out of the three months
    monthly = spark.createDataFrame([("2020-01", 10.0), ("2020-02", 20.0), ("2020-05", 50.0)],
                                    "year_month string, revenue double")
    ahead = {r.year_month: r.revenue for r in kp.revenue_forecast(monthly).collect() if r.type == "Forecast"}
    assert {k: round(v, 6) for k, v in ahead.items()} == {"2020-06": 60.0, "2020-07": 70.0, "2020-08": 80.0}
    assert [r.year_month for r in kp.revenue_inflections(monthly).collect()] == ["2020-02"]


def test_anomaly_deviation_doesnt_cancel(spark):
    from shoplens.operators import kpis as kp
    big = 10 ** 9
    rows = [(f"2020-01-{d:02d}", float(big + d % 2)) for d in range(1, 29)] + [("2020-01-29", float(big + 5))]
    df = spark.createDataFrame(rows, "metric_date string, daily_revenue double")
    last = [r for r in kp.anomalies(df).collect() if r.metric_date == "2020-01-29"][0]
    assert abs(last.baseline_std - 0.5091750772) < 1e-6 and last.is_anomaly


def test_forecast_appends_three_months(spark):
    f = q(spark, "gd28_revenue_forecast")
    assert f.filter("type = 'Forecast'").count() == 3


def _small_commerce(spark, copies):
    import datetime as dt
    from decimal import Decimal

    day = dt.datetime(1998, 1, 1)
    lines = [(7, 2, 20, 1, day, 1.0, 100.0, 0.1, 0.0, "R", "O"), (7, 1, 10, 1, day, 1.0, 50.0, 0.0, 0.05, "N", "O"),
             (9, 1, 20, 1, day, 1.0, 10.0, 0.0, 0.0, "N", "O"), (5, 1, 10, 1, day, 1.0, 1.0, 0.0, 0.0, "R", "O"),
             (None, 1, 10, 1, day, 1.0, 1.0, 0.0, 0.0, "R", "O")]
    li = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, "
                                      "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                      "l_returnflag string, l_linestatus string")
    part = spark.createDataFrame([(10, "Brand#4"), (20, "Brand#3")], "p_partkey long, p_brand string")
    keys = [7] * copies + [9, 8, None]
    orders = spark.createDataFrame([(k, i, day) for i, k in enumerate(keys)], "o_orderkey long, o_custkey long, o_orderdate timestamp")
    return li, part, orders, Decimal


def test_lines_and_orders_are_dealt_to_tasks_by_the_lines_number(spark):
    from shoplens.sources import adapters as ad

    li, part, orders, _ = _small_commerce(spark, 1)
    assert ad.line_tasks(600_000, 200) is None  # AQE has it
    assert ad.line_tasks(36_000_000, 200) == 200 and ad.line_tasks(36_000_000, 8) == 30
    assert all(n / ad.line_tasks(n, 8) <= ad.LINES_A_TASK for n in (5_000_001, 216_000_000, 3_000_000_000))
    lines = ad.commerce_lines(li, part, 7)
    assert lines.rdd.getNumPartitions() == 7
    assert ad.commerce_items(li, orders, part, 7).rdd.getNumPartitions() == 7
    made = ad.commerce_orders(orders, ad.commerce_rollup(lines).hint("merge"), 7)
    assert made.rdd.getNumPartitions() == 7 and made.count() == 4


def test_lines_belong_to_each_row_of_their_order_key(spark):
    from shoplens.sources import adapters as ad

    for copies in (1, 2):
        li, part, orders, D = _small_commerce(spark, copies)
        got = ad.commerce_orders(orders, ad.commerce_rollup(ad.commerce_lines(li, part))).collect()
        # the roll-up of the items, which come once for each row of their order
        roll = {r.order_id: r for r in ad.commerce_rollup(ad.commerce_items(li, orders, part)).collect()}
        assert len(got) == copies + 3
        for r in got:
            e = roll.get(r.order_id) if r.order_id else None
            assert (r.items_purchased, r.price_usd, r.cogs_usd) == ((e.line_item_count, e.items_price, e.items_cogs) if e else (0, D(0), D(0)))
            assert (r.line_item_count, r.primary_product_id, r.cross_sell_product_id, r.total_refund_usd, r.refund_item_count, r.last_refund_ts) == (
                (e.line_item_count, e.primary_product_id_items, e.cross_sell_product_id, e.total_refund_usd, e.refund_item_count, e.last_refund_ts)
                if e else (None,) * 6)
        seven = next(r for r in got if r.order_id == 7)
        assert (seven.primary_product_id, seven.cross_sell_product_id, seven.items_purchased) == ((4, 3, 2) if copies == 1 else (4, 4, 4))
        assert seven.total_refund_usd == D(90) * copies
