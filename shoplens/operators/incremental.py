"""Upserts, change feeds, as-of reads, watermarks and run logs on plain
DataFrames (MRG1-MRG14, FLT4, SNK7).

Plain Parquet has no MERGE, so every operator is ``before, batch -> after``;
the caller writes ``after`` to a *new* path (never the one being read).

Merge plan: the batch is the small side and is reduced to one row per key. The
target is streamed once through a left join with the batch, and once more, keys
only, to find which batch keys it holds; the insert side then works on batch-sized
data alone. AQE turns the joins into broadcast joins while the batch's runtime
size is under the broadcast threshold (a checked size), so the target is not
shuffled; beyond it they are sort-merge joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateKeyError(ValueError):
    pass


def assert_unique_keys(df: DataFrame, keys) -> None:
    """MRG1 precondition: a merge source must not repeat a key (one small
    action: the first duplicate, if any)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"merge source repeats key {dup[0].asDict()}")


def _s(c):
    return F.col(f"_src.{c}")


def _t(c):
    return F.col(f"_tgt.{c}")


def newest_per_key(source: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per key: the newest by ``order_col`` (nulls are oldest; of equally
    new rows the largest by the other columns, so the choice doesn't depend on
    how rows arrive). A partial aggregate: repeats are combined before the
    shuffle."""
    keys = list(keys)
    vals = [c for c in source.columns if c not in keys]
    best = F.max(F.struct(F.col(order_col).alias("_order"), F.struct(*vals).alias("_row")))
    return source.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, *[F.col(f"_best._row.{c}").alias(c) for c in vals]).select(*source.columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys, set_cols=None,
                 update_condition: Column | None = None, insert: bool = True,
                 delete_col: str | None = None, deleted_at_col: str | None = None,
                 order_col: str | None = None, check_unique: bool = True) -> DataFrame:
    """MRG1 / MRG2 / MRG3: upsert ``source`` into ``target`` on ``keys``.

    * ``set_cols``: columns taken from the source on match (default: all
      non-key columns present in both).
    * ``update_condition``: a predicate over ``_src.*`` / ``_tgt.*``; when
      false the target row is kept (e.g. ``_src.updated_at > _tgt.updated_at``).
    * ``delete_col``: a boolean source column; matched rows with it true are
      soft-deleted (``is_deleted`` = true, ``deleted_at`` = source value of
      ``deleted_at_col``) instead of updated; evaluated first.
    * ``insert``: unmatched source rows are appended (with target columns;
      ``is_deleted`` is false where the source has no such column).
    * ``order_col``: the batch is reduced to the newest row per key. Without it
      a batch that repeats a key is an error (``check_unique=False``: the caller
      guarantees distinct keys).
    """
    keys = list(keys)
    if order_col is not None:
        source = newest_per_key(source, keys, order_col)
    elif check_unique:
        assert_unique_keys(source, keys)
    tcols = target.columns
    if set_cols is None:
        set_cols = [c for c in tcols if c not in keys and c in source.columns]
    j = target.alias("_tgt").join(source.withColumn("_matched", F.lit(True)).alias("_src"), keys, "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    cond = matched & (update_condition if update_condition is not None else F.lit(True))
    is_del = matched & F.coalesce(_s(delete_col), F.lit(False)) if delete_col is not None else F.lit(False)
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
            continue
        v = F.when(cond & ~is_del, _s(c)).otherwise(_t(c)) if c in set_cols else _t(c)
        if delete_col is not None and c == "is_deleted":
            v = F.when(is_del, F.lit(True)).otherwise(v)
        elif delete_col is not None and c == "deleted_at" and deleted_at_col is not None:
            v = F.when(is_del, _s(deleted_at_col)).otherwise(v)
        out.append(v.alias(c))
    kept = j.select(*out)
    if not insert:
        return kept
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    new = source.join(present, keys, "left_anti")
    if delete_col is not None:
        new = new.filter(~F.coalesce(F.col(delete_col), F.lit(False)))

    def fresh(c):
        if c in new.columns:
            return F.col(c)
        empty = F.lit(False) if c == "is_deleted" else F.lit(None)
        return empty.cast(target.schema[c].dataType).alias(c)

    # Inserts are dealt anew: both sides come out of joins on the keys, and a union
    # of equally partitioned sides fails where their partitions were coalesced
    # differently at run time.
    return kept.unionByName(new.select(*map(fresh, tcols)).hint("rebalance"))


def conditional_update(df: DataFrame, predicate: Column, assignments: dict) -> DataFrame:
    """MRG4: UPDATE ... SET c = v WHERE predicate."""
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in assignments.items()})


def change_feed(before: DataFrame, after: DataFrame, keys, version: int | None = None,
                commit_ts: Column | None = None) -> DataFrame:
    """MRG5: row-level changes between two snapshots.

    insert / delete / update_preimage + update_postimage (rows compared
    null-safely on every non-key column). One full outer join on the keys.
    """
    keys = list(keys)
    vals = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*vals).alias("_b"), F.lit(True).alias("_in_b"))
    a = after.select(*keys, F.struct(*vals).alias("_a"), F.lit(True).alias("_in_a"))
    j = b.join(a, keys, "full")
    same = F.lit(True)
    for c in vals:
        same = same & F.col(f"_b.{c}").eqNullSafe(F.col(f"_a.{c}"))
    kind = (F.when(F.col("_in_b").isNull(), F.array(F.lit("insert")))
            .when(F.col("_in_a").isNull(), F.array(F.lit("delete")))
            .when(~same, F.array(F.lit("update_preimage"), F.lit("update_postimage"))))
    j = j.filter(kind.isNotNull()).select(*keys, "_b", "_a", F.explode(kind).alias("_change_type"))
    row = F.when(F.col("_change_type").isin("insert", "update_postimage"), F.col("_a")).otherwise(F.col("_b"))
    out = j.select(*keys, row.alias("_r"), "_change_type").select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in vals], "_change_type")
    if version is not None:
        out = out.withColumn("_commit_version", F.lit(version).cast("long"))
    if commit_ts is not None:
        out = out.withColumn("_commit_timestamp", commit_ts)
    return out


def change_counts(feed: DataFrame) -> DataFrame:
    """MRG13: true inserted / updated / deleted counts of a change feed."""
    return feed.agg(
        F.sum(F.when(F.col("_change_type") == "insert", 1).otherwise(0)).cast("long").alias("rows_inserted"),
        F.sum(F.when(F.col("_change_type") == "update_postimage", 1).otherwise(0)).cast("long")
        .alias("rows_updated"),
        F.sum(F.when(F.col("_change_type") == "delete", 1).otherwise(0)).cast("long").alias("rows_deleted"))


def snapshot_log(snapshot: DataFrame, version: int) -> DataFrame:
    """Version-0 change log of a full snapshot: every row an insert."""
    return snapshot.withColumns({"_change_type": F.lit("insert"),
                                 "_commit_version": F.lit(version).cast("long")})


def as_of(log: DataFrame, keys, version: int) -> DataFrame:
    """MRG6: table state at ``version`` from a change log: latest change per
    key with version <= v (partial ``max(struct)`` aggregate, no window),
    deletes dropped."""
    keys = list(keys)
    vals = [c for c in log.columns if c not in keys and c not in ("_change_type", "_commit_version",
                                                                 "_commit_timestamp")]
    rank = (F.when(F.col("_change_type") == "update_preimage", 0).otherwise(1))
    latest = (log.filter(F.col("_commit_version") <= version)
              .groupBy(*keys)
              .agg(F.max(F.struct(F.col("_commit_version").alias("_v"), rank.alias("_o"),
                                  F.col("_change_type").alias("_ct"), *vals)).alias("_m")))
    return (latest.filter(F.col("_m._ct") != "delete")
            .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in vals]))


def as_of_time(log: DataFrame, keys, ts: Column) -> DataFrame:
    """MRG6: table state at a time: at the last version committed by then (an
    empty table before the first). The version is one small aggregate of the
    log's two version columns."""
    version = (log.filter(F.col("_commit_timestamp") <= ts)
               .agg(F.max("_commit_version").alias("v")).first().v)
    return as_of(log, keys, -1 if version is None else version)


def version_diff(log: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """Number of change rows between two versions (time-travel diff)."""
    return (log.filter((F.col("_commit_version") > v_from) & (F.col("_commit_version") <= v_to))
            .groupBy("_change_type").agg(F.count(F.lit(1)).alias("rows")))


# --------------------------------------------------------------- watermarks
WATERMARK_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("timestamp_column", T.StringType()),
    T.StructField("last_processed_timestamp", T.TimestampNTZType()),
    T.StructField("last_update_time", T.TimestampNTZType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])
DEFAULT_START = "1900-01-01 00:00:00"
LOOKBACK = "2 hours"


def get_watermark(watermarks: DataFrame, source_table: str, default=DEFAULT_START,
                  lookback: str = LOOKBACK) -> DataFrame:
    """MRG7: one row ``watermark_start`` = last mark - lookback (default when
    none)."""
    m = (watermarks.filter((F.col("source_table") == source_table) & F.col("is_active"))
         .agg(F.max("last_processed_timestamp").alias("_m")))
    return m.select(F.coalesce(F.col("_m") - F.expr(f"INTERVAL {lookback}"),
                               F.lit(default).cast("timestamp_ntz")).alias("watermark_start"))


def stored_mark(watermarks: DataFrame, source_table: str) -> DataFrame:
    """One row ``stored``: the last mark as it stands (no lookback), or null."""
    return watermarks.filter((F.col("source_table") == source_table) & F.col("is_active")).agg(
        F.max("last_processed_timestamp").alias("stored"))


def new_high_water(batch: DataFrame, ts_col: str, stored: DataFrame) -> DataFrame:
    """MRG9: max timestamp of the batch, never below the stored mark. An empty
    batch leaves the mark where it is; without mark and rows there is no row."""
    return (batch.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("_mx")).crossJoin(stored)
            .select(F.greatest("_mx", F.col("stored").cast("timestamp_ntz")).alias("watermark_end"))
            .where("watermark_end IS NOT NULL"))


def update_watermark(watermarks: DataFrame, marks: DataFrame) -> DataFrame:
    """MRG8: upsert new marks (rows of WATERMARK_SCHEMA) into the control
    table on (source_table, timestamp_column)."""
    return merge_upsert(watermarks, marks, ["source_table", "timestamp_column"],
                        order_col="last_processed_timestamp")


def watermark_value(start: DataFrame):
    """The one watermark scalar (a single-row, single-column read)."""
    return start.first()[0]


def incremental_filter(df: DataFrame, ts_col: str, start) -> DataFrame:
    """FLT4: rows strictly after the watermark, compared as timestamps.

    ``start`` is a timestamp or the one-row frame of ``get_watermark``; it
    is turned into a literal so the predicate reaches the parquet scan
    (``PushedFilters``, row-group skipping, partition pruning on a date
    partition) instead of filtering after a full read.
    """
    wm = watermark_value(start) if isinstance(start, DataFrame) else start
    return df.filter(F.col(ts_col).cast("timestamp_ntz") > F.lit(wm).cast("timestamp_ntz"))


def with_audit(df: DataFrame, processed_at: Column | None = None,
               updated_col: str | None = None) -> DataFrame:
    """MRG14: processed_at, is_deleted=false, updated_at."""
    ts = processed_at if processed_at is not None else F.localtimestamp()
    return df.withColumns({
        "processed_at": ts,
        "is_deleted": F.lit(False),
        "updated_at": F.col(updated_col) if updated_col else ts,
    })


# ----------------------------------------------------------------- run log
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("pipeline_name", T.StringType()),
    T.StructField("source_table", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()), T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()), T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()), T.StructField("rows_deleted", T.LongType()),
    T.StructField("watermark_start", T.TimestampNTZType()),
    T.StructField("watermark_end", T.TimestampNTZType()),
    T.StructField("error_message", T.StringType()),
])


def run_event(spark: SparkSession, **fields) -> DataFrame:
    """MRG10: one run-log event (values go through the schema, never spliced
    into SQL text, so quotes in error messages are harmless)."""
    row = tuple(fields.get(f.name) for f in RUN_SCHEMA.fields)
    return spark.createDataFrame([row], RUN_SCHEMA)


def run_view(events: DataFrame) -> DataFrame:
    """Latest state per run: start time, end time, final status, counts."""
    g = events.groupBy("run_id").agg(
        F.min("event_time").alias("start_time"),
        F.max_by(F.struct(*[c for c in events.columns if c not in ("run_id",)]), "event_time").alias("_l"))
    out = g.select("run_id", "start_time", "_l.*").withColumnRenamed("event_time", "end_time")
    return out.withColumn("duration_seconds",
                          F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")))


def idempotency_diff(once: DataFrame, twice: DataFrame) -> DataFrame:
    """MRG12: rows that differ between one and two applications (both ways);
    empty means the load is idempotent."""
    return (once.exceptAll(twice).withColumn("_side", F.lit("only_once"))
            .unionByName(twice.exceptAll(once).withColumn("_side", F.lit("only_twice"))))


def idempotency_report(once: DataFrame, twice: DataFrame, keys) -> DataFrame:
    """MRG12 as one row: rows of both sides, keys on one side only, and keys whose
    rows differ. One full outer join on the keys."""
    keys = list(keys)
    vals = [c for c in once.columns if c not in keys]
    a = once.select(*keys, F.struct(*vals).alias("_a"))
    b = twice.select(*keys, F.struct(*[F.col(c) for c in vals]).alias("_b"))
    j = a.join(b, keys, "full")

    def n(cond):
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0).cast("long"))

    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return j.agg(n(has_a).alias("rows_once"), n(has_b).alias("rows_twice"), n(has_a & ~has_b).alias("only_once"),
                 n(has_b & ~has_a).alias("only_twice"),
                 n(has_a & has_b & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("rows_changed"))


def incremental_load(target: DataFrame, source: DataFrame, keys, ts_col: str,
                     watermarks: DataFrame, source_table: str, pipeline: str,
                     update_col: str = "updated_at", lookback: str = LOOKBACK):
    """MRG11: watermark -> filtered batch -> upsert-if-newer -> new watermark.

    Returns lazy ``(after, new_watermarks, start, end)``. The caller writes
    ``after`` first and the watermark second, so a crash replays the batch
    (at-least-once) and the newer-only merge makes the replay a no-op. A batch
    with several versions of a key counts by its newest.
    """
    start = get_watermark(watermarks, source_table, lookback=lookback)
    wm = watermark_value(start)
    start = start.sparkSession.createDataFrame([(wm,)], "watermark_start timestamp_ntz")
    batch = incremental_filter(source, ts_col, wm)
    after = merge_upsert(target, batch, keys, order_col=update_col,
                         update_condition=_s(update_col) > _t(update_col))
    end = new_high_water(batch, ts_col, stored_mark(watermarks, source_table))
    marks = end.select(F.lit(source_table).alias("source_table"), F.lit(ts_col).alias("timestamp_column"),
                       F.col("watermark_end").alias("last_processed_timestamp"),
                       F.col("watermark_end").alias("last_update_time"),
                       F.lit(pipeline).alias("pipeline_name"), F.lit(True).alias("is_active"))
    return after, update_watermark(watermarks, marks), start, end


def run_incremental_load(target: DataFrame, source: DataFrame, keys, ts_col: str, watermarks: DataFrame,
                         source_table: str, target_table: str, pipeline: str, run_id: str,
                         write_target, write_watermarks, log_event, **options) -> DataFrame:
    """MRG11 with its run log (MRG10): RUNNING, then SUCCESS with the rows read and
    truly changed, or FAILED with the error, which is raised again.

    ``write_target(df)`` and ``write_watermarks(df)`` write to a new place and
    return what they wrote, read back; ``log_event(df)`` appends one event. The
    watermark is written only after the target.
    """
    spark = target.sparkSession

    def log(status, **fields):
        now = spark.range(1).select(F.localtimestamp().alias("t")).first().t
        log_event(run_event(spark, run_id=run_id, pipeline_name=pipeline, source_table=source_table,
                            target_table=target_table, event_time=now, status=status, **fields))

    log("RUNNING")
    try:
        after, marks, start, end = incremental_load(target, source, keys, ts_col, watermarks, source_table,
                                                    pipeline, **options)
        begun = start.first()[0]
        rows_read = incremental_filter(source, ts_col, begun).count()
        after = write_target(after)
        counts = change_counts(change_feed(target, after, keys)).first().asDict()
        ended = end.first()
        write_watermarks(marks)
    except Exception as e:
        log("FAILED", error_message=f"{type(e).__name__}: {e}"[:2000])
        raise
    log("SUCCESS", rows_read=rows_read, watermark_start=begun, watermark_end=ended and ended[0],
        **{k: v or 0 for k, v in counts.items()})
    return after
