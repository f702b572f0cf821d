"""Registered streaming queries. Streams run over the events as they arrive in slices
and write to the session's shared folder; results are checked against SQL."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.driver import read_table, table_path
from ..streaming import pipeline as st
from ..streaming.tables import ManifestTable, side
from .catalog import register


ARRIVALS = 3
# --- fixed values: which events of the scenario come late or twice ------------
LATE_RULE, LATE_REST = 7, 3    # event_id % 7 = 3 comes one arrival after its time
AGAIN_RULE, AGAIN_REST = 11, 5  # event_id % 11 = 5 comes again one arrival later
# ------------------------------------------------------------------------------


def _scratch(spark, name):
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


class Arrivals:
    """Events as they arrive, in slices of event time. All are written once, a folder for
    each slice; a slice arrives by moving its folder to where the stream looks, and has
    been processed when the next one comes. One stream runs through all arrivals.
    ``scenario`` may change the rows' ``arrival`` and repeat rows."""

    def __init__(self, spark, sf_dir, base, scenario=None):
        self.base = base
        ev = spark.read.parquet(table_path(sf_dir, "events"))
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        low, self.high = ev.agg(F.min(us), F.max(us)).first()
        slices = F.lit(0) if low is None else F.coalesce(
            F.expr(f"((unix_micros(cast(ts as timestamp)) - {low}) * {ARRIVALS}) div {self.high - low + 1}"), F.lit(0))
        rows = (scenario or (lambda df: df))(ev.withColumn("arrival", slices.cast("long")))
        self.schema = (rows if scenario else ev).schema
        rows.withColumn("_slice", F.col("arrival")).select(*self.schema.names, "_slice").write.partitionBy("_slice").parquet(
            f"{base}/staged")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in self._fs.listStatus(self._path(f"{base}/staged"))]
        self.waiting = sorted((n for n in names if n.startswith("_slice=")), key=lambda n: int(n.split("=")[1]))
        self._fs.mkdirs(self._path(f"{base}/in"))

    def through(self, session, start) -> bool:
        """Run the query that ``start(stream)`` starts through all arrivals; False if there
        are no rows."""
        query = None
        for name in self.waiting:
            if not self._fs.rename(self._path(f"{self.base}/staged/{name}"), self._path(f"{self.base}/in/{name}")):
                raise OSError(f"{name} couldn't be moved")
            query = query or start(st.file_stream(session, f"{self.base}/in/*", self.schema))
            query.processAllAvailable()
        if query is not None:
            query.stop()
        return query is not None


def _empty(spark, ddl):
    return spark.createDataFrame([], ddl)


@register("str1_stream_ingest", """
SELECT event_id, ts, user_id, event_type, value, props, 'events' AS _source_table, 'bronze' AS _layer
FROM events""")
def str1_stream_ingest(spark, sf_dir):
    """STR1 + STR2: file stream -> 2 h watermark dedupe -> audited parquet
    sink with checkpoint, one stream over three arrivals, read back."""
    base, s = _scratch(spark, "str1"), st.stream_session(spark)
    come = Arrivals(s, sf_dir, base)
    ran = come.through(s, lambda stream: st.ingest_bronze(
        st.dedupe_late(st.event_time(stream)), f"{base}/data", f"{base}/_ckpt", "events", available_now=False,
        every=None))
    if not ran:
        return _empty(spark, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                             "props string, _source_table string, _layer string")
    return spark.read.parquet(f"{base}/data").drop("_ingest_ts", "event_ts")


def _late_scenario(df):
    late = (F.col("event_id") % LATE_RULE == LATE_REST).cast("long")
    once = df.withColumn("arrival", F.col("arrival") + F.coalesce(late, F.lit(0)))
    again = once.where(F.col("event_id") % AGAIN_RULE == AGAIN_REST).withColumn("arrival", F.col("arrival") + 1)
    return once.unionByName(again)


@register("str2_late_rows", f"""
WITH b AS (SELECT event_id, ts, epoch_us(ts) AS us FROM events),
m AS (SELECT min(us) AS lo, max(us) AS hi FROM b),
o AS (SELECT event_id, ts, CAST(((us - lo) * {ARRIVALS}) // (hi - lo + 1)
        + CASE WHEN event_id % {LATE_RULE} = {LATE_REST} THEN 1 ELSE 0 END AS BIGINT) AS arrival FROM b, m),
a AS (SELECT *, false AS again FROM o
      UNION ALL SELECT event_id, ts, arrival + 1, true FROM o WHERE event_id % {AGAIN_RULE} = {AGAIN_REST}),
w AS (SELECT k.arrival, (SELECT max(ts) FROM a WHERE a.arrival < k.arrival) - INTERVAL 2 HOUR AS mark
      FROM (SELECT DISTINCT arrival FROM a) k)
SELECT event_id, ts, a.arrival, CASE WHEN ts < mark THEN 'late' WHEN again THEN 'replay' ELSE 'kept' END AS outcome
FROM a JOIN w ON w.arrival = a.arrival""")
def str2_late_rows(spark, sf_dir):
    """STR2: a stream with planted late and repeated rows; each row it read, with the
    side it was put on (kept, replay or late: nothing is lost)."""
    base, s = _scratch(spark, "str2"), st.stream_session(spark)
    come = Arrivals(s, sf_dir, base, _late_scenario)
    come.through(s, lambda stream: st.run_late_split(st.event_time(stream), f"{base}/table", f"{base}/_ckpt",
                                                     available_now=False))
    table = ManifestTable(s, f"{base}/table")
    sides = [(n, side(table, n)) for n in ("kept", "replay", "late")]
    found = [df.select("event_id", "ts", "arrival", F.lit(n).alias("outcome")) for n, df in sides if df is not None]
    if not found:
        return _empty(spark, "event_id bigint, ts timestamp_ntz, arrival bigint, outcome string")
    return reduce(lambda a, b: a.unionByName(b), found)


@register("str3_stream_upsert", """
SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def str3_stream_upsert(spark, sf_dir):
    """STR3 + MRG2: the newest event of every user, upserted from a stream into a table
    of 64 partitions of users; a micro-batch rewrites those it has users of."""
    base, s = _scratch(spark, "str3"), st.stream_session(spark)
    come = Arrivals(s, sf_dir, base)

    def start(stream):
        rows = stream.select("user_id", "ts", "event_id", "event_type")
        return st.run_upsert_stream(rows, f"{base}/table", f"{base}/_ckpt", ["user_id"],
                                    F.pmod(F.xxhash64("user_id"), F.lit(64)), update_col="ts", mode="append",
                                    available_now=False)

    come.through(s, start)
    table = ManifestTable(s, f"{base}/table")
    out = table.rows(table.latest())
    return out if out is not None else _empty(spark, "user_id bigint, ts timestamp_ntz, event_id bigint, event_type string")


@register("str5_stream_daily_kpis", """
SELECT date_trunc('day', ts) AS day_start, count(*) AS events,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS revenue
FROM events GROUP BY 1""")
def str5_stream_daily_kpis(spark, sf_dir):
    """STR5 + STR3: 1-day windows with a 2 h watermark, update mode, upserted into a
    table of monthly partitions. The state is a row per open day, so four partitions do."""
    base, s = _scratch(spark, "str5"), st.stream_session(spark, partitions=4)
    come = Arrivals(s, sf_dir, base)

    def start(stream):
        kpis = st.daily_kpis(st.event_time(stream).withWatermark("event_ts", st.LATE_DELAY))
        return st.run_upsert_stream(kpis, f"{base}/table", f"{base}/_ckpt", ["day_start"],
                                    F.date_format("day_start", "yyyy-MM"), available_now=False)

    come.through(s, start)
    table = ManifestTable(s, f"{base}/table")
    out = table.rows(table.latest())
    if out is None:
        return _empty(spark, "day_start timestamp_ntz, events bigint, purchases bigint, revenue double")
    return out.withColumn("day_start", F.col("day_start").cast("timestamp_ntz"))


SESSIONS_SQL = """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
  min(ts) AS first_event_ts, max(ts) AS last_event_ts
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) a) b
GROUP BY user_id, sid"""


def _closing(df, high):
    """An event behind all others, after which the watermark closes every session; its
    own session stays open and is never written."""
    if high is None:
        return df
    end = df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]).withColumns({
        "ts": F.timestamp_micros(F.lit(high)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"),
        "arrival": F.lit(ARRIVALS).cast("long")})
    return df.unionByName(end.select(*df.columns))


@register("str4_stream_sessions", SESSIONS_SQL)
def str4_stream_sessions(spark, sf_dir):
    """STR4 on a stream: 30-minute-gap sessions, written once the watermark closes them;
    each task merges its events to sessions before they are shuffled."""
    base, s = _scratch(spark, "str4"), st.stream_session(spark)
    high = spark.read.parquet(table_path(sf_dir, "events")).agg(
        F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    come = Arrivals(s, sf_dir, base, lambda df: _closing(df, high))

    def start(stream):
        sessions = st.sessionize(st.event_time(stream).withWatermark("event_ts", st.LATE_DELAY))
        return (sessions.writeStream.format("parquet").option("path", f"{base}/data")
                .option("checkpointLocation", f"{base}/_ckpt").outputMode("append").start())

    if not come.through(s, start):
        return _empty(spark, "user_id bigint, session_start timestamp_ntz, session_end timestamp_ntz, events bigint, "
                             "purchases bigint, first_event_ts timestamp_ntz, last_event_ts timestamp_ntz")
    out = s.read.parquet(f"{base}/data")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (
        "session_start", "session_end", "first_event_ts", "last_event_ts")})


@register("str4_sessionize", SESSIONS_SQL)
def str4_sessionize(spark, sf_dir):
    """STR4 (batch form of the streaming operator): 30-minute-gap sessions."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "ts", "event_type"])
    return st.sessionize(ev, ts_col="ts")
