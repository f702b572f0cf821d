"""Structured Streaming operators (STR1-STR5).

* STR1 ``file_stream`` + ``ingest_bronze``: explicit-schema file stream,
  audit columns, checkpointed parquet sink, ``availableNow`` trigger.
* STR2 ``dedupe_late``: event-time watermark (2 h) and replay removal with
  ``dropDuplicatesWithinWatermark`` (state bounded by the watermark).
* STR2 with nothing lost: ``run_late_split`` keeps late and replayed rows on sides
  of their own, by the watermark committed with each micro-batch.
* STR3 ``run_upsert_stream``: ``foreachBatch`` merge into a manifest table
  (``tables``): a micro-batch writes the partitions it touches and one manifest.
* STR4 ``sessionize``: per-user session windows with a 30-minute gap; in a
  ``stream_session`` a task's events are merged to sessions before the shuffle.
* STR5 ``daily_kpis``: tumbling 1-day windows.

The aggregations are plain DataFrame functions: they run unchanged on a
batch DataFrame (used for the batch = stream checks) and on a stream.
Event timestamps arrive as TIMESTAMP_NTZ; watermarks need TIMESTAMP, so
``event_time`` casts first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import split_late_into, upsert_into

LATE_DELAY = "2 hours"
SESSION_GAP = "30 minutes"


def file_stream(spark: SparkSession, directory: str, schema, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """STR1 source: schema-on-read file stream (no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def event_time(df: DataFrame, col: str = "ts", out: str = "event_ts") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("timestamp"))


def with_ingest_audit(df: DataFrame, source: str, layer: str = "bronze") -> DataFrame:
    """SNK6 on a stream: _ingest_ts, _source_table, _layer."""
    return df.withColumns({"_ingest_ts": F.current_timestamp(), "_source_table": F.lit(source),
                           "_layer": F.lit(layer)})


def dedupe_late(df: DataFrame, id_cols=("event_id",), ts_col: str = "event_ts",
                delay: str = LATE_DELAY) -> DataFrame:
    """STR2: drop events later than ``delay`` behind the max event time and
    replays of an id seen within the watermark."""
    w = df.withWatermark(ts_col, delay)
    if df.isStreaming:
        return w.dropDuplicatesWithinWatermark(list(id_cols))
    return df.dropDuplicates(list(id_cols))


def ingest_bronze(stream: DataFrame, sink_dir: str, checkpoint: str, source: str,
                  partition_cols=(), available_now: bool = True, every: str | None = "1 minute"):
    """STR1 sink: append to parquet with a checkpoint (exactly-once file sink), once over
    what is there or ``every`` so often (None: as soon as rows come)."""
    w = (with_ingest_audit(stream, source).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()


def sessionize(df: DataFrame, ts_col: str = "event_ts", gap: str = SESSION_GAP,
               user_col: str = "user_id") -> DataFrame:
    """STR4: sessions per user, closed after ``gap`` without events.

    On a batch, sessions are first built inside (user, day) and then stitched
    where a day's first goes on from the day before: a user's rows in one task are
    that user's sessions, not events. A stream keeps a user's open sessions as state.
    """
    if not df.isStreaming:
        return _sessionize_batch(df, ts_col, gap, user_col)
    return (df.groupBy(user_col, F.session_window(ts_col, gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"),
                 F.min(ts_col).alias("first_event_ts"), F.max(ts_col).alias("last_event_ts"))
            .select(user_col, F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), "events", "purchases",
                    "first_event_ts", "last_event_ts"))


def _sessionize_batch(df: DataFrame, ts_col: str, gap: str, user_col: str) -> DataFrame:
    parts = (df.groupBy(user_col, F.to_date(ts_col).alias("_day"), F.session_window(ts_col, gap).alias("_w"))
             .agg(F.count(F.lit(1)).alias("events"),
                  F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"),
                  F.min(ts_col).alias("first_event_ts"), F.max(ts_col).alias("last_event_ts")))
    w = Window.partitionBy(user_col).orderBy("first_event_ts")
    interval = F.expr(f"INTERVAL {gap}")
    before = F.lag("last_event_ts").over(w)
    opens = before.isNull() | (F.col("first_event_ts") >= before + interval)
    numbered = parts.withColumn("_opens", opens.cast("int")).withColumn("_no", F.sum("_opens").over(w))
    return (numbered.groupBy(user_col, "_no")
            .agg(F.sum("events").alias("events"), F.sum("purchases").alias("purchases"),
                 F.min("first_event_ts").alias("first_event_ts"), F.max("last_event_ts").alias("last_event_ts"))
            .select(user_col, F.col("first_event_ts").alias("session_start"),
                    (F.col("last_event_ts") + interval).alias("session_end"), "events", "purchases",
                    "first_event_ts", "last_event_ts"))


def daily_kpis(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """STR5: per calendar day events, purchases, revenue; state is one row per
    open day."""
    return (df.groupBy(F.window(ts_col, "1 day").alias("day"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"),
                 F.sum(F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,2)")))
                 .alias("revenue"))
            .select(F.col("day.start").alias("day_start"), "events", "purchases", "revenue"))


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application with a stream's own settings, so that the
    caller's stay as they are: event times as UTC, session windows merged inside each
    task before they are shuffled (a user with very many events then sends sessions, not
    events), and the number of state partitions where ``partitions`` names one."""
    s = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        v = spark.conf.get(k, None)
        if v is not None:
            s.conf.set(k, v)
    s.conf.set("spark.sql.session.timeZone", "UTC")
    s.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    if partitions:
        s.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return s


def run_upsert_stream(stream: DataFrame, base: str, checkpoint: str, keys, partition,
                      update_col: str | None = None, mode: str = "update", available_now: bool = True):
    """STR3: start a stream that upserts into the manifest table at ``base``."""
    w = (stream.writeStream.foreachBatch(upsert_into(base, keys, partition, update_col))
         .option("checkpointLocation", checkpoint).outputMode(mode))
    return (w.trigger(availableNow=True) if available_now else w).start()


def run_late_split(stream: DataFrame, base: str, checkpoint: str, id_cols=("event_id",), ts_col: str = "event_ts",
                   delay: str = LATE_DELAY, available_now: bool = True):
    """STR2: start a stream that keeps, replays and late rows apart at ``base``."""
    w = (stream.writeStream.foreachBatch(split_late_into(base, id_cols, ts_col, delay))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return (w.trigger(availableNow=True) if available_now else w).start()
