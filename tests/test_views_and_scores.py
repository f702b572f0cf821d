"""Roll-up maintenance, multi-score tiles, Morton order, schema versions, quality runs,
mode imputation and censoring weights on small hand-made or random tables."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from given_data import SF_SMALL
from shoplens.operators import customers as cu
from shoplens.operators import ml, views
from shoplens.operators import quality as dq
from shoplens.plans import dashboards as db
from shoplens.plans import q_incremental as qi
from shoplens.sources import sinks
from shoplens.sources.driver import read_table

def ask():
    return {"count": "n", "sums": {"total": F.col("price").cast("decimal(18,2)")}, "top": {"last": "at"}}


LINES = "k long, price double, at long"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _maintained(spark, before, feed, after):
    stored = views.rollup(spark.createDataFrame(before, LINES), ["k"], **ask())
    return views.maintained(stored, spark.createDataFrame(feed, LINES + ", _change_type string"),
                            spark.createDataFrame(after, LINES), ["k"], **ask())


def test_rollup_follows_inserts_updates_and_deletes(spark):
    before = [(1, 10.0, 5), (1, 20.0, 7), (2, 5.0, 3), (3, 1.0, 1), (None, 4.0, 4), (5, 2.0, 9), (5, 2.0, 8)]
    feed = [(1, 20.0, 7, "delete"), (2, 5.0, 3, "update_preimage"), (2, 6.5, 2, "update_postimage"), (3, 1.0, 1, "delete"),
            (4, 9.0, 9, "insert"), (4, 1.0, 2, "insert"), (None, 1.0, 6, "insert"), (5, 2.0, 8, "delete"),
            (6, 3.0, 3, "insert"), (6, 3.0, 3, "delete")]
    after = [(1, 10.0, 5), (2, 6.5, 2), (4, 9.0, 9), (4, 1.0, 2), (None, 4.0, 4), (None, 1.0, 6), (5, 2.0, 9)]
    got = _maintained(spark, before, feed, after)
    assert _rows(got) == _rows(views.rollup(spark.createDataFrame(after, LINES), ["k"], **ask()))
    assert got.columns == ["k", "n", "total", "last"]


def test_rollup_follows_random_changes(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 12), rng.randint(1, 99) / 4, rng.randint(0, 30)) for _ in range(150)]
    keep, gone = rows[:100], set(rng.sample(range(100), 45))
    feed = [(*keep[i], "delete") for i in gone] + [(*r, "insert") for r in rows[100:]]
    after = [r for i, r in enumerate(keep) if i not in gone] + rows[100:]
    full = views.rollup(spark.createDataFrame(after, LINES), ["k"], **ask())
    assert _rows(_maintained(spark, keep, feed, after)) == _rows(full)
    assert _rows(_maintained(spark, keep, [], keep)) == _rows(views.rollup(spark.createDataFrame(keep, LINES), ["k"], **ask()))


def test_line_changes_are_filtered_in_the_scan(spark):
    lines = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_shipdate", "l_returnflag"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    feed = qi.line_changes(lines, dt.datetime(1998, 1, 1), dt.datetime(1998, 6, 1))
    plan = feed._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "PushedFilters" in x]
    assert len(scans) == 2 and all("GreaterThan(l_shipdate" in x and "LessThanOrEqual(l_shipdate" in x for x in scans)


def _ntile(rows, key, n):
    order = sorted(rows, key=key)
    size, more = divmod(len(order), n)
    out, at = {}, 0
    for t in range(1, n + 1):
        for r in order[at:at + size + (t <= more)]:
            out[r[0]] = t
        at += size + (t <= more)
    return out


@pytest.mark.parametrize("n_rows, n, values", [(1, 5, 3), (4, 5, 2), (23, 5, 4), (500, 5, 7), (1000, 4, 100000), (300, 7, 1)])
def test_tiles_equal_ntile(spark, n_rows, n, values):
    rng = random.Random(n_rows + n)
    rows = [(k * 7919 % 100_003, rng.randint(0, values), round(rng.random() * values, 2)) for k in range(n_rows)]
    df = spark.createDataFrame(rows, "id long, a long, b double").repartition(3)
    got = cu.with_tiles(df, {"sa": ("a", False), "sd": ("a", True), "sb": ("b", False)}, "id", n).collect()
    want = (_ntile(rows, lambda r: (r[1], r[0]), n), _ntile(rows, lambda r: (-r[1], r[0]), n), _ntile(rows, lambda r: (r[2], r[0]), n))
    assert [(r.sa, r.sd, r.sb) for r in got] == [tuple(w[r.id] for w in want) for r in got]


def test_tiles_with_large_ids_and_a_null_id(spark):
    rows = [(2**60 + k, 1) for k in range(40)] + [(None, 1)]
    got = cu.with_tiles(spark.createDataFrame(rows, "id long, a long"), {"s": ("a", False)}, "id", 4).collect()
    want = _ntile([(-2**63 if r[0] is None else r[0], 1) for r in rows], lambda r: r[0], 4)
    assert {(r.id, r.s) for r in got} == {(None if k == -2**63 else k, v) for k, v in want.items()}


def test_cohorts_count_users_once(spark):
    rows = [(1, "2024-01-03", "ads"), (1, "2024-02-01", "ads"), (1, "2024-02-02", "ads"), (2, "2024-01-09", None),
            (2, "2024-12-30", "x"), (3, "2024-01-05", None), (3, "2024-01-05", None), (None, "2024-01-05", "ads")]
    df = spark.createDataFrame([(k, u, d + " 10:00:00", c, 5.0) for k, (u, d, c) in enumerate(rows)],
                               "order_id long, user_id long, order_ts string, acquisition_channel string, gross_revenue double")
    got = cu.cohort_retention_keyed(df.withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))).collect()
    seen = {(r.acquisition_cohort, r.acquisition_channel): (r.new_customers, r.repeated_60d, r.repeated_365d) for r in got}
    assert seen == {("2024-01", "ads"): (1, 1, 1), ("2024-01", None): (2, 0, 1)}


def _row_groups_read(path, column, lo, hi):
    hit = all_ = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            all_ += 1
            hit += s.min <= hi and s.max >= lo
    return hit, all_


def test_morton_order_skips_on_every_column(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(0, 9999), int(rng.expovariate(0.01))) for _ in range(20_000)]
    df = spark.createDataFrame(rows + [(None, 5), (7, None)], "a long, b long")
    assert sinks.morton_write(df, str(tmp_path / "m"), ["a", "b"], partitions=16) == len(rows) + 2
    assert sinks.clustered_write(df, str(tmp_path / "s"), ["a", "b"], partitions=16) == len(rows) + 2
    assert _rows(spark.read.parquet(str(tmp_path / "m"))) == _rows(df)
    for column, lo, hi in (("a", 4000, 4300), ("b", 30, 40)):
        hit, n = _row_groups_read(str(tmp_path / "m"), column, lo, hi)
        assert n >= 12 and hit <= n / 2, (column, hit, n)
    hit, n = _row_groups_read(str(tmp_path / "s"), "b", 30, 40)
    assert hit == n  # in the order of a then b, a filter on b alone skips nothing


def test_schema_versions(spark):
    a = spark.createDataFrame([(1, 2, "x")], "id int, q int, old string")
    b = spark.createDataFrame([(2**40, 2.5, dt.date(2024, 1, 1))], "ID bigint, q double, d date")
    c = spark.createDataFrame([(3, "n/a", 1.5)], "key int, q string, f float")
    got = sinks.reconciled([a, b, c], renamed={"key": "id"}, defaults={"f": -1.0}, dropped=["OLD"])
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("id", "bigint"), ("q", "string"), ("d", "date"), ("f", "float")]
    assert _rows(got) == sorted([(1, "2", None, -1.0), (2**40, "2.5", dt.date(2024, 1, 1), -1.0), (3, "n/a", None, 1.5)], key=repr)
    assert sinks.wider("int", "float") == "double" and sinks.wider("smallint", "bigint") == "bigint"


def test_quality_runs_are_kept_apart(spark, tmp_path):
    def results(failed):
        return spark.createDataFrame([("c1", "t", "x", "CRITICAL", failed == 0, 100, failed), ("c2", "t", "x", "WARNING", True, 100, 1)],
                                     "check_id string, table_name string, column_name string, severity string, "
                                     "passed boolean, records_checked long, records_failed long")

    store = str(tmp_path / "runs")
    dq.append_run(results(0), store, "a")
    dq.append_run(results(7), store, "b")
    dq.append_run(results(7), store, "b")  # written again after a failure: the run stands there once
    card = {r.severity: (r.total_checks, r.passed_checks) for r in dq.scorecard(dq.read_run(spark, store, "a")).collect()}
    assert card == {"CRITICAL": (1, 1), "WARNING": (1, 1)}
    latest = {r.severity: (r.total_checks, r.passed_checks) for r in dq.scorecard(dq.read_run(spark, store)).collect()}
    assert latest == {"CRITICAL": (1, 0), "WARNING": (1, 1)}
    assert [(r.run_id, r.total_checks, r.failed_checks) for r in dq.run_trend(spark, store).collect()] == [("a", 2, 0), ("b", 2, 1)]


def test_modes_are_those_of_the_fitted_rows(spark):
    train = spark.createDataFrame([("a", None), ("b", None), ("b", None), (None, None)], "x string, y string")
    model = ml.ModeImputer(inputCols=["x", "y"], outputCols=["fx", "fy"]).fit(train)
    other = spark.createDataFrame([("a", "q"), (None, None), ("c", None)], "x string, y string")
    assert _rows(model.transform(other).select("fx", "fy")) == sorted([("a", "q"), ("b", None), ("c", None)], key=repr)
    tie = ml.ModeImputer(inputCols=["x"], outputCols=["f"]).fit(spark.createDataFrame([("b",), ("a",)], "x string"))
    assert tie.modes == ["a"]


def test_known_censoring_is_recovered(spark):
    """Channel a spends 100 and is mostly cut off, b spends 10 and is complete: the complete
    customers' plain mean is off, the weighted one is the mean of all."""
    rows = [(k, "a", 100.0, 400 if k % 4 == 0 else 10 + k % 300) for k in range(400)]
    rows += [(1000 + k, "b", 10.0, 500) for k in range(400)]
    df = spark.createDataFrame(rows, "user_id long, acquisition_channel string, future_revenue double, followup_days int")
    w = {r.acquisition_channel: (r.n, r.n_complete, round(r.weight, 9)) for r in ml.censoring_weights(df, 365).collect()}
    assert w == {"a": (400, 100, 4.0), "b": (400, 400, 1.0)}
    d = ml.with_censoring_weights(df, 365)
    plain, weighted = d.agg(F.avg("future_revenue"), F.sum(F.col("future_revenue") * F.col("weight")) / F.sum("weight")).first()
    assert abs(weighted - 55.0) < 1e-6 and abs(plain - 28.0) < 1e-6
    none = df.withColumn("followup_days", F.lit(3))
    assert all(r.weight is None for r in ml.censoring_weights(none, 365).collect())
    assert ml.with_censoring_weights(none, 365).count() == 0


def test_filters_reach_bound_datasets_only(spark):
    scored = spark.createDataFrame([(1, "direct", "mobile"), (2, "direct", "desktop"), (3, "x", "mobile")],
                                   "website_session_id long, marketing_channel string, device_type string")
    f = {"channel": ["direct"], "device": ["mobile"], "month": ["2024-01"], "tier": ["High Value"]}
    got = db.apply_filters(scored, "session_conversion_predictions", f)
    assert [r.website_session_id for r in got.collect()] == [1]
    cohorts = spark.createDataFrame([("2024-01", "direct"), ("2024-02", "x")], "acquisition_cohort string, acquisition_channel string")
    assert [r.acquisition_cohort for r in db.apply_filters(cohorts, "acquisition_cohorts", f).collect()] == ["2024-01"]


def test_a_fitted_model_scores_after_an_observed_write(spark, tmp_path):
    """A model's training summary can't be sent to tasks of a session that has observed a
    write; what is fitted here has none."""
    sinks.write_table(spark.range(3), str(tmp_path / "t"))
    rows = [(k, k, ["a", "b", None][k % 3], ["m", "d"][k % 2], "g", k % 2, k % 3 % 2, k % 24, k % 7, 2024, 1, int(k % 5 == 0))
            for k in range(200)]
    d = spark.createDataFrame(rows, "website_session_id long, user_id long, marketing_channel string, device_type string, "
                              "channel_group string, is_repeat_int int, is_weekend_int int, session_hour int, day_of_week int, "
                              "session_year int, session_month int, converted_label int")
    assert ml.score(ml.fit_logistic(d), d).agg(F.count("conversion_prob")).first()[0] == 200
