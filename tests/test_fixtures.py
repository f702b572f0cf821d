"""Hand-made edge rows (FIXTURES.md §6) with the expected answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoplens.functions.channels import channel_group, classify_channel
from shoplens.operators import customers as cu
from shoplens.operators import funnel as fn
from shoplens.operators import incremental as inc
from shoplens.operators import kpis as kp
from shoplens.operators import marketing as mk
from shoplens.operators import orders as od
from shoplens.operators import quality as dq
from shoplens.operators.sessions import enrich_sessions
from shoplens.sources import ingest

TS = dt.datetime


def test_channel_rules(spark):
    rows = [("gsearch", "nonbrand", None), (" GSearch ", "Brand", None), ("NULL", None, None),
            (None, None, "https://www.gsearch.com"), (None, None, None), ("none", None, "x.bsearch.y"),
            ("socialbook", "pilot", None), ("mystery", "x", None)]
    df = spark.createDataFrame(rows, "s string, c string, r string")
    out = [r.ch for r in df.select(classify_channel("s", "c", "r").alias("ch")).collect()]
    assert out == ["paid_search_gsearch_nonbrand", "paid_search_gsearch_brand", "other",
                   "organic_search", "direct", "organic_search", "social_pilot", "other"]
    g = spark.createDataFrame([(c,) for c in out], "m string").select(channel_group("m").alias("g"))
    assert [r.g for r in g.collect()] == ["Paid Search", "Paid Search", "Other", "Organic", "Direct",
                                          "Organic", "Social", "Other"]


def test_sessions_dq_rank_and_first_touch(spark):
    schema = ingest.SCHEMAS["website_sessions"]
    rows = [(1, "2024-01-01 10:00:00", 7, 0, "gsearch", "nonbrand", None, "Desktop", None),
            (2, "2024-01-01 10:00:00", 7, 1, None, None, None, "mobile", None),   # same second
            (3, "2024-01-03 09:00:00", 7, 1, "bsearch", "brand", None, "mobile", None),
            (None, "2024-01-01 10:00:00", 8, 0, None, None, None, "mobile", None),
            (4, "not a time", 8, 0, None, None, None, "mobile", None),
            (5, "2024-01-02 10:00:00", None, 0, None, None, None, "mobile", None)]
    s = enrich_sessions(spark.createDataFrame(rows, schema))
    got = {r.website_session_id: r for r in s.collect()}
    assert set(got) == {1, 2, 3}
    assert [got[i].user_session_rank for i in (1, 2, 3)] == [1, 2, 3]
    assert {got[i].acquisition_channel for i in (1, 2, 3)} == {"paid_search_gsearch_nonbrand"}
    assert got[1].device_type == "desktop" and got[2].marketing_channel == "direct"
    flags = enrich_sessions(spark.createDataFrame(rows, schema), keep_failed=True)
    assert sorted(r.dq_flag for r in flags.filter("dq_flag != 'PASS'").collect()) == \
        ["MISSING_SESSION_ID", "MISSING_USER_ID", "NULL_TIMESTAMP"]


def test_funnel_flags_with_null_url(spark):
    pv = spark.createDataFrame([(1, 10, "/lander-9"), (2, 10, None), (3, 10, "/billing"), (4, 10, "/billing-2"),
                                (5, 11, "/thank-you-for-your-order"), (6, 12, None)],
                               "website_pageview_id long, website_session_id long, pageview_url string")
    f = {r.website_session_id: r for r in fn.funnel_steps(pv).collect()}
    assert f[10].saw_lander and not f[10].saw_lander_1 and f[10].saw_billing_v1 and f[10].saw_billing_v2
    assert f[10].funnel_depth == 6 and f[10].funnel_exit_step == "Billing"
    assert f[11].converted and not f[11].saw_cart and f[11].funnel_depth == 7
    assert f[12].saw_home is False and f[12].funnel_depth == 1   # never NULL
    e = {r.website_session_id: r.entry_page for r in fn.entry_pages(pv).collect()}
    assert e[10] == "/lander-9"


def _orders_fixture(spark):
    o = spark.createDataFrame(
        [(1, TS(2024, 1, 1), 100, 7, 1, 2, 50.0, 20.0), (2, TS(2024, 1, 1), 100, 7, 1, 1, 30.0, 10.0),
         (3, TS(2024, 1, 2), 101, 8, 2, 0, 0.0, 0.0)],
        "order_id long, created_at timestamp_ntz, website_session_id long, user_id long, "
        "primary_product_id int, items_purchased int, price_usd double, cogs_usd double")
    it = spark.createDataFrame(
        [(11, 1, 1, 1, 25.0, 10.0), (12, 1, 2, 0, 15.0, 5.0), (13, 1, 3, 0, 10.0, 5.0), (21, 2, 1, 1, 30.0, 10.0)],
        "order_item_id long, order_id long, product_id int, is_primary_item int, price_usd double, cogs_usd double"
    ).withColumn("created_at", F.lit(TS(2024, 1, 1)).cast("timestamp_ntz"))
    rf = spark.createDataFrame(
        [(1, 12, 1, 7.5, TS(2024, 1, 5)), (2, 12, 1, 7.5, TS(2024, 1, 6)), (3, 999, 5, 1.0, TS(2024, 1, 6))],
        "order_item_refund_id long, order_item_id long, order_id long, refund_amount_usd double, created_at timestamp_ntz")
    pr = spark.createDataFrame([(1, TS(2023, 12, 1), "A"), (2, TS(2023, 11, 1), "B"), (3, TS(2023, 12, 1), "C")],
                               "product_id int, created_at timestamp_ntz, product_name string")
    s = spark.createDataFrame([(100, "gsearch", "Paid Search"), (101, "direct", "Direct")],
                              "website_session_id long, marketing_channel string, channel_group string")
    s = s.withColumns({"utm_source": F.lit(None).cast("string"), "utm_campaign": F.lit(None).cast("string"),
                       "device_type": F.lit("desktop"), "is_repeat_session": F.lit(False),
                       "acquisition_channel": F.col("marketing_channel")})
    return o, it, rf, pr, s


def test_order_enrichment_does_not_fan_out(spark):
    o, it, rf, pr, s = _orders_fixture(spark)
    e = {r.order_id: r for r in od.enrich_orders(o, it, rf, od.session_attribution(s), pr).collect()}
    assert len(e) == 3
    assert e[1].line_item_count == 3 and e[1].is_cross_sell_order and e[1].cross_sell_product_id == 3
    assert e[1].total_refund_usd == 15.0 and e[1].refund_item_count == 2 and e[1].days_to_refund == 5
    assert e[1].net_revenue == e[1].gross_revenue - e[1].total_refund_usd
    assert e[3].is_cross_sell_order is False and e[3].line_item_count == 0     # no items
    assert e[3].gross_margin_pct is None and e[3].net_margin_pct == 0.0        # price 0: no error
    assert e[1].months_after_product_launch == 1
    items = {r.order_item_id: r for r in od.enrich_items(it, pr, rf).collect()}
    assert len(items) == 4 and items[12].item_refund_usd == 15.0 and items[12].is_refunded


def test_two_orders_in_one_session_count_once(spark):
    o, it, rf, pr, s = _orders_fixture(spark)
    orders = od.enrich_orders(o, it, rf, od.session_attribution(s), pr)
    sess = s.withColumn("session_ts", F.lit(TS(2024, 1, 1)).cast("timestamp_ntz"))
    funnel = spark.createDataFrame([(100, 3), (101, 1)], "website_session_id long, total_pageviews_in_session long")
    swo = mk.sessions_with_orders(sess, funnel, orders)
    cvr = {r.marketing_channel: r for r in mk.channel_cvr(swo).collect()}
    assert cvr["gsearch"].total_sessions == 1 and cvr["gsearch"].converted_sessions == 1
    assert cvr["gsearch"].total_orders == 2 and cvr["gsearch"].conversion_rate_pct == 100.0


def test_cohort_day_boundaries(spark):
    rows = [(1, 1, TS(2024, 1, 1, 9)), (2, 1, TS(2024, 1, 1, 17)),        # same-day repeat
            (3, 2, TS(2024, 1, 1)), (4, 2, TS(2024, 3, 1)),               # day 60
            (5, 3, TS(2024, 1, 1)), (6, 3, TS(2024, 3, 2)),               # day 61
            (7, 4, TS(2024, 1, 1)), (8, 4, TS(2025, 1, 1))]               # one year (366 d)
    o = spark.createDataFrame(rows, "order_id long, user_id long, order_ts timestamp_ntz").withColumns(
        {"gross_revenue": F.lit(10.0), "acquisition_channel": F.lit(None).cast("string")})
    a = cu.acquisition_cohorts(o).collect()[0]
    assert a.new_customers == 4 and a.repeated_60d == 2 and a.repeated_90d == 3 and a.repeated_365d == 3
    b = cu.acquisition_cohorts(o, same_day_counts=False).collect()[0]
    assert b.repeated_60d == 1            # same-day repeat no longer counts
    assert a.acquisition_channel is None  # NULL channel kept as its own cohort


def test_dense_calendar_and_lags(spark):
    o = spark.createDataFrame([(1, TS(2024, 1, 1), 10.0, False), (2, TS(2024, 1, 3), 20.0, True)],
                              "order_id long, order_ts timestamp_ntz, gross_revenue double, has_refund boolean")
    d = kp.daily_kpis(o).orderBy("metric_date").collect()
    assert [r.daily_orders for r in d] == [1, 0, 1]                      # missing day filled
    pop = kp.period_over_period(kp.daily_kpis(o), lags=(("d2", 2),)).orderBy("metric_date").collect()
    assert pop[2].orders_prev_2d == 1 and pop[2].orders_d2_pct == 0.0
    z = kp.period_over_period(kp.daily_kpis(o), lags=(("d1", 1),)).orderBy("metric_date").collect()
    assert z[2].orders_d1_pct is None and z[2].orders_d1_trend == "STABLE"   # zero previous value


def test_quality_edge_cases(spark):
    empty = spark.createDataFrame([], "id long, d string")
    nulls = spark.createDataFrame([(None, "2013-01-01"), (None, None)], "id long, d string")
    devices = spark.createDataFrame([(i, f"s{i}", d) for i, d in enumerate(["Tablet", "tv", "desktop"] + ["mobile"] * 18)],
                                    "id long, src string, device string")
    checks = (dq.null_rate(empty, "e", ["id"]) + dq.null_rate(nulls, "n", ["id"]) +
              [dq.duplicate_keys(nulls, "n", ["id"]), dq.date_range(nulls, "n", "d"),
               dq.max_cardinality(devices, "dv", "src"), dq.domain(devices, "dv", "device")])
    r = {(x.table_name, x.check_name): x for x in dq.score_checks(dq.run_checks(checks)).collect()}
    assert r[("e", "null_rate_check")].records_checked == 0 and r[("e", "null_rate_check")].passed
    assert r[("n", "null_rate_check")].failure_rate_pct == 100.0 and not r[("n", "null_rate_check")].passed
    assert r[("n", "duplicate_detection")].records_failed == 0          # NULL keys are DQ1's
    assert r[("n", "date_range_validation")].records_failed == 0        # NULL date counts as valid
    assert r[("dv", "cardinality_validation")].records_checked in (21, 21)
    dom = [x for x in r.values() if x.column_name == "device"][0]
    assert dom.records_failed == 1                                       # 'tv' only; Tablet is valid
    with pytest.raises(dq.QualityGateError):
        dq.assert_gate(dq.score_checks(dq.run_checks(checks)))


def _snap(spark, rows):
    return spark.createDataFrame(rows, "order_id long, n long, updated_at timestamp_ntz")


def test_upsert_semantics(spark):
    tgt = _snap(spark, [(1, 1, TS(2024, 1, 2)), (2, 1, TS(2024, 1, 2)), (3, 1, TS(2024, 1, 2))])
    src = _snap(spark, [(1, 9, TS(2024, 1, 3)), (2, 9, TS(2024, 1, 2)), (3, 9, TS(2024, 1, 1)), (4, 9, TS(2024, 1, 1))])
    newer = F.col("_src.updated_at") > F.col("_tgt.updated_at")
    out = {r.order_id: r.n for r in inc.merge_upsert(tgt, src, ["order_id"], update_condition=newer).collect()}
    assert out == {1: 9, 2: 1, 3: 1, 4: 9}                             # newer / equal / older / new
    dup = src.unionByName(src.limit(1))
    with pytest.raises(inc.DuplicateKeyError):
        inc.merge_upsert(tgt, dup, ["order_id"], check_unique=True)
    once = inc.merge_upsert(tgt, src, ["order_id"], update_condition=newer)
    twice = inc.merge_upsert(once, src, ["order_id"], update_condition=newer)
    assert inc.idempotency_diff(once, twice).count() == 0


def test_upsert_takes_the_newest_of_repeated_keys(spark):
    tgt = _snap(spark, [(1, 1, TS(2024, 1, 2)), (2, 1, TS(2024, 1, 5)), (None, 1, TS(2024, 1, 1))])
    src = _snap(spark, [(1, 7, TS(2024, 1, 3)), (1, 8, TS(2024, 1, 4)), (1, 6, None), (3, 1, TS(2024, 1, 1)),
                        (3, 2, TS(2024, 1, 2)), (3, 2, TS(2024, 1, 2)), (2, 9, TS(2024, 1, 4))])
    out = inc.merge_upsert(tgt, src, ["order_id"], order_col="updated_at",
                           update_condition=F.col("_src.updated_at") > F.col("_tgt.updated_at")).collect()
    assert sorted((str(r.order_id), r.n) for r in out) == [("1", 8), ("2", 1), ("3", 2), ("None", 1)]
    with pytest.raises(inc.DuplicateKeyError):  # no order given: repeated keys are refused
        inc.merge_upsert(tgt, src, ["order_id"])


def _marks(spark, rows):
    return spark.createDataFrame(rows, inc.WATERMARK_SCHEMA)


def test_high_water_mark_never_falls(spark):
    stored = TS(2024, 1, 1, 12, 0)
    marks = _marks(spark, [("s", "updated_at", stored, stored, "p", True)])
    tgt = _snap(spark, [(1, 1, TS(2024, 1, 1))])
    none = _snap(spark, [])
    for batch, want in ((none, stored), (_snap(spark, [(1, 2, TS(2024, 1, 1, 11, 0))]), stored),
                        (_snap(spark, [(1, 2, TS(2024, 1, 1, 13, 0))]), TS(2024, 1, 1, 13, 0))):
        _, after, _, _ = inc.incremental_load(tgt, batch, ["order_id"], "updated_at", marks, "s", "p")
        assert [r.last_processed_timestamp for r in after.collect()] == [want]
    _, after, _, _ = inc.incremental_load(tgt, none, ["order_id"], "updated_at", _marks(spark, []), "s", "p")
    assert after.collect() == []  # no mark, no rows: nothing to write


def test_logged_load(spark):
    events, written = [], []
    tgt = _snap(spark, [(1, 1, TS(2024, 1, 1)), (2, 1, TS(2024, 1, 1))])
    src = _snap(spark, [(1, 2, TS(2024, 1, 2)), (3, 1, TS(2024, 1, 2)), (3, 0, TS(2024, 1, 1))])

    def write(df):
        written.append(df.collect())
        return spark.createDataFrame(written[-1], df.schema)

    def load(**writers):
        return inc.run_incremental_load(tgt, src, ["order_id"], "updated_at", _marks(spark, []), "s", "t", "p", "r1",
                                        **{"write_target": write, "write_watermarks": write,
                                           "log_event": lambda e: events.extend(e.collect())} | writers)

    assert sorted((r.order_id, r.n) for r in load().collect()) == [(1, 2), (2, 1), (3, 1)]
    assert [e.status for e in events] == ["RUNNING", "SUCCESS"]
    assert (events[1].rows_read, events[1].rows_inserted, events[1].rows_updated, events[1].rows_deleted) == (3, 1, 1, 0)
    assert events[1].watermark_end == TS(2024, 1, 2) and len(written) == 2

    def broken(df):
        raise OSError("can't write 'there'")

    with pytest.raises(OSError):
        load(write_target=broken)
    assert events[-1].status == "FAILED" and "can't write 'there'" in events[-1].error_message
    assert len(written) == 2  # and no watermark


def test_as_of_time(spark):
    v0 = _snap(spark, [(1, 1, TS(2024, 1, 1))])
    v1 = _snap(spark, [(1, 2, TS(2024, 1, 2))])
    log = inc.snapshot_log(v0, 0).withColumn("_commit_timestamp", F.lit(TS(2024, 1, 1)).cast("timestamp_ntz"))
    log = log.unionByName(inc.change_feed(v0, v1, ["order_id"], 1, F.lit(TS(2024, 1, 3)).cast("timestamp_ntz")))
    for day, n in ((1, [1]), (2, [1]), (3, [2])):
        at = F.lit(TS(2024, 1, day)).cast("timestamp_ntz")
        assert [r.n for r in inc.as_of_time(log, ["order_id"], at).collect()] == n
    assert inc.as_of_time(log, ["order_id"], F.lit(TS(2023, 1, 1)).cast("timestamp_ntz")).collect() == []


def test_change_feed_and_as_of(spark):
    v0 = _snap(spark, [(1, 1, TS(2024, 1, 1)), (2, 1, TS(2024, 1, 1))])
    v1 = _snap(spark, [(1, 2, TS(2024, 1, 2)), (3, 1, TS(2024, 1, 2))])
    feed = inc.change_feed(v0, v1, ["order_id"], version=1)
    kinds = sorted((r.order_id, r._change_type) for r in feed.collect())
    assert kinds == [(1, "update_postimage"), (1, "update_preimage"), (2, "delete"), (3, "insert")]
    c = inc.change_counts(feed).collect()[0]
    assert (c.rows_inserted, c.rows_updated, c.rows_deleted) == (1, 1, 1)
    log = inc.snapshot_log(v0, 0).unionByName(feed)
    assert sorted(inc.as_of(log, ["order_id"], 1).collect()) == sorted(v1.collect())
    assert sorted(inc.as_of(log, ["order_id"], 0).collect()) == sorted(v0.collect())


def test_run_log_quotes_and_latest_state(spark):
    e1 = inc.run_event(spark, run_id="r1", pipeline_name="p", status="RUNNING", event_time=TS(2024, 1, 1, 0, 0))
    e2 = inc.run_event(spark, run_id="r1", pipeline_name="p", status="FAILED", event_time=TS(2024, 1, 1, 0, 5),
                       error_message="can't parse 'x'")
    v = inc.run_view(e1.unionByName(e2)).collect()[0]
    assert v.status == "FAILED" and v.duration_seconds == 300 and v.error_message == "can't parse 'x'"


def test_soft_delete(spark):
    tgt = _snap(spark, [(1, 1, TS(2024, 1, 1)), (2, 1, TS(2024, 1, 1))]).withColumns(
        {"is_deleted": F.lit(False), "deleted_at": F.lit(None).cast("timestamp_ntz")})
    src = _snap(spark, [(1, 5, TS(2024, 1, 2))]).withColumns({"del": F.lit(True),
                                                              "at": F.lit(TS(2024, 1, 9)).cast("timestamp_ntz")})
    out = {r.order_id: r for r in inc.merge_upsert(tgt, src, ["order_id"], set_cols=["n", "updated_at"],
                                                   delete_col="del", deleted_at_col="at").collect()}
    assert out[1].is_deleted and out[1].n == 1 and out[1].deleted_at == TS(2024, 1, 9)
    assert not out[2].is_deleted
    new = src.withColumns({"order_id": F.lit(7).cast("long"), "del": F.lit(False)})
    out = {r.order_id: r for r in inc.merge_upsert(tgt, new, ["order_id"], set_cols=["n", "updated_at"],
                                                   delete_col="del", deleted_at_col="at").collect()}
    assert out[7].is_deleted is False and out[7].deleted_at is None


def test_csv_quarantine(spark, tmp_path):
    p = tmp_path / "pv.csv"
    p.write_text("website_pageview_id,created_at,website_session_id,pageview_url\n"
                 "1,2024-01-01 00:00:00,10,/home\n"
                 "x,2024-01-01 00:00:00,10,/cart\n"
                 "3,NULL,11,/products\n")
    good, bad = ingest.split_bad_rows(ingest.read_csv(spark, str(p), ingest.SCHEMAS["website_pageviews"]))
    assert good.count() == 2 and bad.count() == 1
    assert good.filter("website_pageview_id = 3").collect()[0].created_at is None
