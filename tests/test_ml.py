"""Model checks are bounds, not equality (fixed seeds)."""

from pyspark.sql import functions as F

from shoplens.operators import ml
from shoplens.plans import q_ml


def test_propensity_bounds_and_separable_auc(spark):
    rows = []
    for i in range(400):
        conv = 1 if i % 5 == 0 else 0
        rows.append((i, i % 7, "paid_search_gsearch_nonbrand" if conv else "direct",
                     "desktop" if i % 2 else "mobile", "Paid Search" if conv else "Direct",
                     i % 24, 1 + i % 7, conv, 0, 2024, 1, conv))
    df = spark.createDataFrame(rows, "website_session_id long, user_id long, marketing_channel string, "
                                     "device_type string, channel_group string, session_hour int, day_of_week int, "
                                     "is_repeat_int int, is_weekend_int int, session_year int, session_month int, "
                                     "converted_label int")
    train, test = ml.split(df)
    model = ml.fit_logistic(train)
    scored = ml.score(model, df)
    p = scored.agg(F.min("conversion_prob"), F.max("conversion_prob")).collect()[0]
    assert 0.0 <= p[0] <= p[1] <= 1.0
    assert set(r.propensity_segment for r in scored.select("propensity_segment").distinct().collect()) <= {
        "LOW", "MEDIUM", "HIGH"}
    m = ml.model_metrics(spark, ml.score(model, test), "lr").collect()[0]
    assert m.roc_auc > 0.9


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(100)], "website_session_id long, converted_label int")
    w = {r.converted_label: r.weight for r in ml.class_weights(df).select("converted_label", "weight").distinct().collect()}
    assert abs(w[1] - 5.0) < 1e-9 and abs(w[0] - 100 / 180) < 1e-9


def test_session_rank_hour_bucket_matches_day(spark):
    import datetime as dt
    from shoplens.operators.sessions import enrich_sessions
    from shoplens.sources.ingest import SCHEMAS
    rows = [(i, (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=37 * i)).strftime("%Y-%m-%d %H:%M:%S"), i % 2, 0,
             "gsearch" if i % 3 else None, "brand", None, "mobile", None) for i in range(1, 120)]
    raw = spark.createDataFrame(rows, SCHEMAS["website_sessions"])
    a = sorted(enrich_sessions(raw).select("website_session_id", "user_session_rank", "acquisition_channel").collect())
    b = sorted(enrich_sessions(raw, bucket="hour").select("website_session_id", "user_session_rank",
                                                          "acquisition_channel").collect())
    assert a == b


def test_search_is_fitted_on_a_share_without_a_step(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml, "search_gbt", lambda train: seen.append(train.count()))
    monkeypatch.setattr(ml, "score", lambda model, d: d)
    monkeypatch.setattr(ml, "feature_importances", lambda model, d: spark.range(1))
    monkeypatch.setattr(ml, "split", lambda d: (d, d))
    for n in (0, 300, 5000, 5001, 12_000, 50_000):
        monkeypatch.setattr(q_ml, "_train_set", lambda spark, sf_dir, n=n: spark.range(n).toDF("website_session_id"))
        assert q_ml.scored_sessions(spark, f"rows {n}").count() == n
    assert seen[:3] == [0, 300, 5000] and seen[3] > 4950
    assert abs(seen[4] - 5000) < 200 and abs(seen[5] - 10_000) < 400


def test_feature_importances_of_the_best_model_are_registered(spark, monkeypatch):
    import __spark_entry__ as E

    rows = [(i, i, "paid" if i % 5 else "direct", "mobile", "Paid", i % 24, 1 + i % 7, i % 2, 0, 2024, 1,
             int(i % 24 > 15)) for i in range(400)]
    df = spark.createDataFrame(rows, "website_session_id long, user_id long, marketing_channel string, "
                                     "device_type string, channel_group string, session_hour int, day_of_week int, "
                                     "is_repeat_int int, is_weekend_int int, session_year int, session_month int, "
                                     "converted_label int")
    space = {"maxIter": [2], "maxDepth": [2]}
    search = ml.search_gbt
    monkeypatch.setattr(q_ml, "_train_set", lambda spark, sf_dir: df)
    monkeypatch.setattr(ml, "search_gbt", lambda train: search(train, n_search=1, folds=2, space=space, parallelism=1))
    found = {r.feature: r.importance for r in E.queries()["ml6_feature_importances"](spark, "importances").collect()}
    assert set(ml.NUM_COLS) < set(found) and any("direct" in f for f in found)
    assert abs(sum(found.values()) - 1) < 1e-9 and max(found, key=found.get) == "session_hour"
    assert q_ml.scored_sessions(spark, "importances").count() == 400


def test_importances_come_from_all_rows_of_the_train_side(spark, monkeypatch):
    import __spark_entry__ as E

    seen = []
    monkeypatch.setattr(ml, "search_gbt", lambda train: seen.append(train.select("website_session_id").collect()))
    monkeypatch.setattr(ml, "score", lambda model, d: d)
    monkeypatch.setattr(ml, "feature_importances", lambda model, d: spark.range(1))
    for n in (300, 12_000, 50_000):
        rows = spark.range(n).toDF("website_session_id")
        monkeypatch.setattr(q_ml, "_train_set", lambda spark, sf_dir, rows=rows: rows)
        assert E.queries()["ml6_feature_importances"](spark, f"whole {n}").count() == 1
        assert sorted(seen[-1]) == sorted(ml.split(rows)[0].collect())
    assert len(seen) == 3


def test_thresholds_of_the_search_come_from_all_rows(spark):
    hours = {10: 23, 20_010: 23, 39_991: 23}  # the only converted sessions; the other hours are 0 and 1
    rows = [(i, "direct", "mobile", "Direct", hours.get(i, i % 2), 1, 0, 0, int(i in hours)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "website_session_id long, marketing_channel string, device_type string, "
                                     "channel_group string, session_hour int, day_of_week int, is_repeat_int int, "
                                     "is_weekend_int int, converted_label int")
    model = ml.search_gbt(df, n_search=1, folds=2, space={"maxIter": [1], "maxDepth": [1]}, parallelism=1)
    found = {r.feature: r.importance for r in ml.feature_importances(model, df).collect()}
    split = model.stages[-1].trees[0]._call_java("rootNode").split()
    hour = df.agg(F.avg("session_hour"), F.stddev("session_hour")).first()
    assert found["session_hour"] == 1
    assert abs(split.threshold() * hour[1] + hour[0] - 12) < 1e-6  # between 1 and 23, not 0 and 1


def test_starts_of_a_clustering_run_at_once_and_the_first_of_the_least_stays(spark, monkeypatch):
    import threading
    from types import SimpleNamespace

    together = threading.Barrier(2, timeout=20)

    class Start:
        def __init__(self, seed, **_):
            self.seed = seed

        def fit(self, feats):
            together.wait()  # breaks unless another start runs beside it
            return SimpleNamespace(seed=self.seed, summary=SimpleNamespace(trainingCost={42: 3.0}.get(self.seed, 1.0)))

    monkeypatch.setattr(ml, "KMeans", Start)
    assert ml._best_start(spark.range(1), 4, 4, 42, 10).seed == 43


def test_customer_history_is_dealt_to_tasks_and_reads_orders_once(spark):
    import datetime as dt
    import io
    from contextlib import redirect_stdout

    def ts(day, hour=0):
        return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day)

    rows = [(2, 1, ts(0, 9), "late", 10.0, 1, False), (1, 1, ts(0, 8), "early", 20.0, 2, True),
            (3, 1, ts(30), "x", 5.0, 1, False), (4, 1, ts(31), "x", 7.0, 1, True), (5, 1, ts(181), "x", 3.0, 1, False),
            (7, 2, ts(10), "b", 1.0, 1, False), (6, 2, ts(10), "a", 2.0, 1, False),  # the lower id of equal times
            (8, 3, ts(5), "z", 4.0, 1, False), (9, 3, None, None, 6.0, 1, False),  # no time: before all, in no window
            (10, 4, None, "n", 8.0, 1, True), (11, None, ts(-5), "gone", 9.0, 1, False), (12, 5, ts(200), None, 2.5, 3, False)]
    orders = spark.createDataFrame(rows, "order_id long, user_id long, order_ts timestamp_ntz, acquisition_channel string, "
                                         "gross_revenue double, items_purchased int, has_refund boolean")
    cols = ["user_id", "acquisition_channel", "early_orders", "early_revenue", "early_items", "early_refunds", "revenue_90d",
            "revenue_180d", "revenue_365d", "is_complete_90d", "is_complete_180d", "is_complete_365d"]
    want = [(1, "early", 3.0, 35.0, 4.0, 1.0, 42.0, 42.0, 45.0, True, True, False),
            (2, "a", 2.0, 3.0, 2.0, 0.0, 3.0, 3.0, 3.0, True, True, False),
            (3, None, 1.0, 4.0, 1.0, 0.0, 4.0, 4.0, 4.0, True, True, False),
            (4, "n", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None, None),
            (5, None, 1.0, 2.5, 3.0, 0.0, 2.5, 2.5, 2.5, False, False, False)]
    for tasks in (None, 7):
        got = ml.ltv_history(orders, tasks=tasks)
        assert got.columns == cols and sorted(tuple(r) for r in got.collect()) == want
    assert got.rdd.getNumPartitions() == 7  # the session deals to 4
    with redirect_stdout(io.StringIO()) as plan:
        ml.ltv_history(orders, tasks=7).explain()
    assert "MergeJoin" not in plan.getvalue() and "HashJoin" not in plan.getvalue()
