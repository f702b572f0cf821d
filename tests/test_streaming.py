"""Streaming = batch on split files; a row later than the 2 h watermark is
dropped; replayed ids are removed."""

import datetime as dt
import os

from pyspark.sql import functions as F

from shoplens.streaming import pipeline as st
from shoplens.streaming import tables

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _write(spark, d, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(d, name))


def test_stream_equals_batch_and_drops_late(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src = tmp_path / "in"
    t0 = dt.datetime(2024, 1, 1, 12)
    b1 = [(i, t0 + dt.timedelta(minutes=10 * i), i % 3, "purchase" if i % 2 else "view", 1.0) for i in range(12)]
    late1h = [(100, t0 + dt.timedelta(minutes=60), 1, "purchase", 5.0)]      # within 2 h: kept
    late3h = [(101, t0 + dt.timedelta(minutes=110 - 180), 1, "purchase", 7.0)]  # 3 h behind: dropped
    replay = [(3, t0 + dt.timedelta(minutes=30), 0, "purchase", 1.0)]       # replayed id
    _write(spark, str(src), "p1", b1)
    stream = st.file_stream(spark, str(src / "*"), SCHEMA, max_files=1)
    deduped = st.dedupe_late(st.event_time(stream))
    out = tmp_path / "out"
    q = deduped.writeStream.format("parquet").option("path", str(out / "data")) \
        .option("checkpointLocation", str(out / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    _write(spark, str(src), "p2", late1h + late3h + replay)
    q = deduped.writeStream.format("parquet").option("path", str(out / "data")) \
        .option("checkpointLocation", str(out / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    ids = sorted(r.event_id for r in spark.read.parquet(str(out / "data")).collect())
    assert ids == list(range(12)) + [100]


def test_sessionize_batch_matches_stream_closed_sessions(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t0 = dt.datetime(2024, 1, 1, 8)
    rows = [(i, t0 + dt.timedelta(minutes=m), 1, "view", 1.0) for i, m in enumerate([0, 10, 25, 90, 100, 400])]
    _write(spark, str(tmp_path / "in"), "p1", rows)
    batch = st.sessionize(st.event_time(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(r.events for r in batch.collect()) == [1, 2, 3]
    stream = st.event_time(st.file_stream(spark, str(tmp_path / "in" / "*"), SCHEMA)).withWatermark("event_ts", "2 hours")
    q = st.sessionize(stream).writeStream.format("memory").queryName("sess_t").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(r.events for r in spark.sql("select * from sess_t").collect())
    assert set(got) <= {1, 2, 3} and 3 in got          # closed sessions emitted; open tail waits


def test_daily_kpis_batch(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 1), 1, "purchase", 2.5), (2, dt.datetime(2024, 1, 1, 23), 2, "view", 1.0),
            (3, dt.datetime(2024, 1, 2, 0), 2, "purchase", 1.5)]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    d = st.daily_kpis(st.event_time(spark.createDataFrame(rows, SCHEMA))).orderBy("day_start").collect()
    assert [(r.events, r.purchases, float(r.revenue)) for r in d] == [(2, 1, 2.5), (1, 1, 1.5)]


def _split(spark, base, batches, schema="event_id long, event_ts timestamp, v string", delay="2 hours"):
    h = tables.split_late_into(base, ["event_id"], "event_ts", delay)
    for k, rows in enumerate(batches):
        h(spark.createDataFrame(rows, schema), k)
    table = tables.ManifestTable(spark, base)
    out = {}
    for name in ("kept", "replay", "late"):
        df = tables.side(table, name)
        out[name] = sorted((tuple(r) for r in df.select("event_id", "v").collect()), key=repr) if df is not None else []
    return out, table


def test_late_and_replayed_rows_have_their_sides(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 2, h, m)
    batches = [
        [(1, at(10), "a"), (2, at(11), "b"), (2, at(11), "b2"), (None, at(9), "n1"), (None, at(9), "n2"), (3, None, "t")],
        [(4, at(8, 59), "late"), (5, at(9), "edge"), (1, at(10), "again"), (6, at(13), "c"), (3, None, "t again")],
        [(7, at(10, 59), "late2"), (6, at(13), "c again"), (8, at(11), "ok"), (5, at(9), "late replay")],
        [],
        [(9, dt.datetime(2024, 1, 1), "old day")],
    ]
    got, table = _split(spark, str(tmp_path / "t"), batches)
    assert got["kept"] == sorted([(1, "a"), (2, "b"), (3, "t"), (5, "edge"), (6, "c"), (8, "ok"), (None, "n1"), (None, "n2")],
                                 key=repr)
    assert got["late"] == [(4, "late"), (5, "late replay"), (7, "late2"), (9, "old day")]
    assert got["replay"] == [(1, "again"), (2, "b2"), (3, "t again"), (6, "c again")]
    read = 0
    for b in table.batches():
        m = table.latest(b)
        assert m["read"] == m["kept"] + m["replay"] + m["late"] == len(batches[b])
        read += m["read"]
    assert read == sum(map(len, got.values()))
    assert table.latest(3)["watermark"] == table.latest(1 + 1)["watermark"]  # an empty batch leaves the mark


def test_late_split_batch_is_applied_once(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1, k % 24), "x") for k in range(50)]
    schema = "event_id long, event_ts timestamp, v string"
    h = tables.split_late_into(str(tmp_path / "t"), ["event_id"], "event_ts", "2 hours")
    df = spark.createDataFrame(rows, schema)
    h(df, 0)
    h(df, 0)
    table = tables.ManifestTable(spark, str(tmp_path / "t"))
    assert tables.side(table, "kept").count() == 50 and tables.side(table, "replay") is None
    h(df, 1)  # the same rows as another batch: late by the committed mark, or replays
    m = table.latest()
    assert m["kept"] == 0 and m["late"] == sum(r[1] < dt.datetime(2024, 1, 1, 21) for r in rows)


def test_stream_sessions_equal_batch_with_a_hot_user(spark, tmp_path):
    s = st.stream_session(spark)
    assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "false") == "false"
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(seconds=7 * k + (40 * 60 if k > 2000 else 0)), 1, "purchase" if k % 5 == 0 else "view", 1.0)
            for k in range(3000)]
    rows += [(10_000 + k, t0 + dt.timedelta(minutes=k * 17 % 3000), 2 + k % 40, "view", 1.0) for k in range(400)]
    _write(spark, str(tmp_path / "in"), "p1", rows)
    _write(spark, str(tmp_path / "in"), "p2", [(-1, t0 + dt.timedelta(days=9), -1, "end", 0.0)])
    stream = st.event_time(st.file_stream(s, str(tmp_path / "in" / "*"), SCHEMA, max_files=4)).withWatermark("event_ts", "2 hours")
    sessions = st.sessionize(stream)
    q = (sessions.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    plan = q._jsq.explainInternal(False) if hasattr(q, "_jsq") else ""
    assert plan.count("MergingSessions") >= 2 or "UpdatingSessions" in plan or not plan
    cols = ["user_id", "session_start", "session_end", "events", "purchases"]
    got = sorted(map(tuple, s.read.parquet(str(tmp_path / "out")).select(*cols).collect()))
    batch = st.sessionize(st.event_time(s.createDataFrame(rows, SCHEMA)))
    assert got == sorted(map(tuple, batch.select(*cols).collect()))
    assert sum(r[3] for r in got if r[0] == 1) == 3000
