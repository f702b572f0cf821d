"""Registered incremental / history queries.

Two snapshots of an order table are derived from all line items (per order:
lines, total, last ship = updated_at). They differ by rules on the order key, so
the change grows with the data: v0 lacks every order with key % 10 = 3 (inserts);
v1 lacks key % 10 = 7 (deletes), has newer versions of key % 5 = 1 and older ones
of key % 5 = 2 (which a newer-only merge must not take).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import MONEY
from ..operators import incremental as inc
from ..operators import views
from ..session import scratch_path
from ..sources.driver import read_table
from .catalog import register
from .oracle_ctes import CTES

# --- fixed values: scenario dates ------------------------------------------
DELETED_AT = "2002-01-01"
STALE_BEFORE = "1998-07-01"
V0_COMMIT, V1_COMMIT = "2002-01-01", "2002-02-01"
BEHIND_DAYS = 365  # the stored mark lies so far behind the newest row of v0
# ---------------------------------------------------------------------------
KEYS = ["order_id"]


def order_snapshot(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount", "l_shipdate"])
    price = (F.col("l_extendedprice").cast("decimal(15,2)") *
             (F.lit(1).cast("decimal(15,2)") - F.col("l_discount").cast("decimal(15,2)"))).cast(MONEY)
    return (li.groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(price).cast(MONEY).alias("total_price"),
                 F.max("l_shipdate").alias("updated_at")))


CTES["snap"] = """
SELECT l_orderkey AS order_id, count(*) AS n_lines,
  CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(18,4)))
       AS DOUBLE) AS total_price, max(l_shipdate) AS updated_at
FROM lineitem GROUP BY l_orderkey"""
CTES["v0"] = "SELECT * FROM snap WHERE order_id % 10 <> 3"
CTES["v1"] = """
SELECT order_id, n_lines + CASE order_id % 5 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS n_lines, total_price,
  CASE order_id % 5 WHEN 1 THEN updated_at + INTERVAL 1 DAY WHEN 2 THEN updated_at - INTERVAL 1 DAY
    ELSE updated_at END AS updated_at
FROM snap WHERE order_id % 10 <> 7"""
CTES["feed"] = """
SELECT coalesce(v1.order_id, v0.order_id) AS order_id, 'insert' AS _change_type,
  v1.n_lines, v1.total_price, v1.updated_at FROM v1 LEFT JOIN v0 ON v0.order_id = v1.order_id
  WHERE v0.order_id IS NULL
UNION ALL
SELECT v0.order_id, 'delete', v0.n_lines, v0.total_price, v0.updated_at
  FROM v0 LEFT JOIN v1 ON v0.order_id = v1.order_id WHERE v1.order_id IS NULL
UNION ALL
SELECT v0.order_id, 'update_preimage', v0.n_lines, v0.total_price, v0.updated_at
  FROM v0 JOIN v1 ON v0.order_id = v1.order_id
  WHERE v0.n_lines IS DISTINCT FROM v1.n_lines OR v0.total_price IS DISTINCT FROM v1.total_price
     OR v0.updated_at IS DISTINCT FROM v1.updated_at
UNION ALL
SELECT v1.order_id, 'update_postimage', v1.n_lines, v1.total_price, v1.updated_at
  FROM v0 JOIN v1 ON v0.order_id = v1.order_id
  WHERE v0.n_lines IS DISTINCT FROM v1.n_lines OR v0.total_price IS DISTINCT FROM v1.total_price
     OR v0.updated_at IS DISTINCT FROM v1.updated_at"""

UPSERT_NEWER_SQL = """
SELECT v0.* FROM v0 LEFT JOIN b ON v0.order_id = b.order_id WHERE b.order_id IS NULL
UNION ALL
SELECT v0.order_id,
  CASE WHEN b.updated_at > v0.updated_at THEN b.n_lines ELSE v0.n_lines END,
  CASE WHEN b.updated_at > v0.updated_at THEN b.total_price ELSE v0.total_price END,
  CASE WHEN b.updated_at > v0.updated_at THEN b.updated_at ELSE v0.updated_at END
FROM v0 JOIN b ON v0.order_id = b.order_id
UNION ALL
SELECT b.* FROM b LEFT JOIN v0 ON v0.order_id = b.order_id WHERE v0.order_id IS NULL"""


def _snapshots(spark, sf_dir):
    snap = order_snapshot(spark, sf_dir)
    rule = F.col("order_id") % 5
    day = F.expr("INTERVAL 1 DAY")
    v1 = snap.filter(F.col("order_id") % 10 != 7).withColumns({
        "n_lines": F.col("n_lines") + F.when(rule == 1, 1).when(rule == 2, 2).otherwise(0),
        "updated_at": F.when(rule == 1, F.col("updated_at") + day).when(rule == 2, F.col("updated_at") - day)
        .otherwise(F.col("updated_at"))})
    return snap.filter(F.col("order_id") % 10 != 3), v1


@register("mrg5_change_feed", "SELECT *, CAST(1 AS BIGINT) AS _commit_version FROM feed")
def mrg5_change_feed(spark, sf_dir):
    """MRG5: insert / delete / update pre+post images between two snapshots."""
    v0, v1 = _snapshots(spark, sf_dir)
    return inc.change_feed(v0, v1, KEYS, version=1)


@register("mrg13_change_counts", """
SELECT CAST(count(CASE WHEN _change_type = 'insert' THEN 1 END) AS BIGINT) AS rows_inserted,
  CAST(count(CASE WHEN _change_type = 'update_postimage' THEN 1 END) AS BIGINT) AS rows_updated,
  CAST(count(CASE WHEN _change_type = 'delete' THEN 1 END) AS BIGINT) AS rows_deleted FROM feed""")
def mrg13_change_counts(spark, sf_dir):
    """MRG13: true inserted / updated / deleted counts."""
    v0, v1 = _snapshots(spark, sf_dir)
    return inc.change_counts(inc.change_feed(v0, v1, KEYS))


def _versions_of(v1):
    """A batch as it arrives: every key twice, its newest version and an older one."""
    older = v1.withColumns({"n_lines": F.lit(-1).cast("long"),
                            "updated_at": F.col("updated_at") - F.expr("INTERVAL 3 DAYS")})
    return v1.unionByName(older)


@register("mrg1_upsert_newer", "WITH b AS (SELECT * FROM v1)\n" + UPSERT_NEWER_SQL)
def mrg1_upsert_newer(spark, sf_dir):
    """MRG1 + MRG2: upsert a batch that holds two versions of each key of v1
    into v0: the newest version counts, and only when newer."""
    v0, v1 = _snapshots(spark, sf_dir)
    return inc.merge_upsert(v0, _versions_of(v1), KEYS, order_col="updated_at",
                            update_condition=F.col("_src.updated_at") > F.col("_tgt.updated_at"))


@register("mrg3_soft_delete", f"""
WITH t AS (SELECT *, false AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at FROM v0),
b AS (SELECT order_id, n_lines, total_price, updated_at, _change_type = 'delete' AS del
      FROM feed WHERE _change_type <> 'update_preimage')
SELECT t.* FROM t LEFT JOIN b ON t.order_id = b.order_id WHERE b.order_id IS NULL
UNION ALL
SELECT t.order_id, CASE WHEN b.del THEN t.n_lines ELSE b.n_lines END,
  CASE WHEN b.del THEN t.total_price ELSE b.total_price END,
  CASE WHEN b.del THEN t.updated_at ELSE b.updated_at END,
  CASE WHEN b.del THEN true ELSE t.is_deleted END,
  CASE WHEN b.del THEN TIMESTAMP '{DELETED_AT}' ELSE t.deleted_at END
FROM t JOIN b ON t.order_id = b.order_id
UNION ALL
SELECT b.order_id, b.n_lines, b.total_price, b.updated_at, false, CAST(NULL AS TIMESTAMP)
FROM b LEFT JOIN t ON t.order_id = b.order_id WHERE t.order_id IS NULL AND NOT b.del""")
def mrg3_soft_delete(spark, sf_dir):
    """MRG3: apply a change batch with deletes as soft deletes."""
    v0, v1 = _snapshots(spark, sf_dir)
    t = v0.withColumns({"is_deleted": F.lit(False), "deleted_at": F.lit(None).cast("timestamp_ntz")})
    feed = inc.change_feed(v0, v1, KEYS).filter(F.col("_change_type") != "update_preimage")
    b = feed.withColumns({"del": F.col("_change_type") == "delete",
                          "del_at": F.lit(DELETED_AT).cast("timestamp_ntz")}).drop("_change_type")
    return inc.merge_upsert(t, b, KEYS, set_cols=["n_lines", "total_price", "updated_at"],
                            delete_col="del", deleted_at_col="del_at", check_unique=False)


@register("mrg6_as_of_latest", "SELECT * FROM v1")
def mrg6_as_of_latest(spark, sf_dir):
    """MRG6: as-of read of version 1 from a v0 snapshot log + v0->v1 feed
    (property: as-of latest == current snapshot)."""
    v0, v1 = _snapshots(spark, sf_dir)
    log = inc.snapshot_log(v0, 0).unionByName(inc.change_feed(v0, v1, KEYS, version=1))
    return inc.as_of(log, KEYS, 1)


@register("mrg6_as_of_first", "SELECT * FROM v0")
def mrg6_as_of_first(spark, sf_dir):
    """MRG6: as-of read of version 0 from the same log."""
    v0, v1 = _snapshots(spark, sf_dir)
    log = inc.snapshot_log(v0, 0).unionByName(inc.change_feed(v0, v1, KEYS, version=1))
    return inc.as_of(log, KEYS, 0)


@register("mrg6_as_of_timestamp", "SELECT * FROM v0")
def mrg6_as_of_timestamp(spark, sf_dir):
    """MRG6: as-of read by time, half way between the two commits."""
    return inc.as_of_time(_log(spark, sf_dir), KEYS, F.lit("2002-01-15").cast("timestamp_ntz"))


@register("mrg6_version_diff", """
SELECT _change_type, count(*) AS rows FROM feed GROUP BY _change_type""")
def mrg6_version_diff(spark, sf_dir):
    """MRG6: change rows between the two versions, by kind."""
    return inc.version_diff(_log(spark, sf_dir), 0, 1)


def _log(spark, sf_dir):
    v0, v1 = _snapshots(spark, sf_dir)
    first = inc.snapshot_log(v0, 0).withColumn("_commit_timestamp", F.lit(V0_COMMIT).cast("timestamp_ntz"))
    return first.unionByName(inc.change_feed(v0, v1, KEYS, version=1,
                                             commit_ts=F.lit(V1_COMMIT).cast("timestamp_ntz")))


@register("mrg4_conditional_update", f"""
SELECT *, CASE WHEN updated_at < TIMESTAMP '{STALE_BEFORE}' THEN 'stale' ELSE 'active' END AS status FROM v1""")
def mrg4_conditional_update(spark, sf_dir):
    """MRG4: UPDATE status = 'stale' WHERE the last ship is before a date."""
    _, v1 = _snapshots(spark, sf_dir)
    return inc.conditional_update(v1.withColumn("status", F.lit("active")),
                                  F.col("updated_at") < F.lit(STALE_BEFORE).cast("timestamp_ntz"),
                                  {"status": F.lit("stale")})


def _load(spark, sf_dir):
    v0, v1 = _snapshots(spark, sf_dir)
    mark = F.col("m") - F.expr(f"INTERVAL {BEHIND_DAYS} DAYS")
    marks = v0.agg(F.max("updated_at").alias("m")).select(
        F.lit("lineitem").alias("source_table"), F.lit("updated_at").alias("timestamp_column"),
        mark.alias("last_processed_timestamp"), mark.alias("last_update_time"),
        F.lit("active_orders").alias("pipeline_name"), F.lit(True).alias("is_active"))
    return inc.incremental_load(v0, v1, KEYS, "updated_at", marks, "lineitem", "active_orders")


LOAD_SQL = f"""
WITH wm AS (SELECT max(updated_at) - INTERVAL {BEHIND_DAYS} DAY - INTERVAL 2 HOUR AS s FROM v0),
b AS (SELECT * FROM v1 WHERE updated_at > (SELECT s FROM wm))
""" + UPSERT_NEWER_SQL


@register("mrg11_incremental_load", LOAD_SQL)
def mrg11_incremental_load(spark, sf_dir):
    """MRG11 + MRG7 + FLT4 + MRG2: watermark-filtered batch upserted if newer."""
    return _load(spark, sf_dir)[0]


# --- fixed values: a returned line is taken back so many days after it was shipped, and
# the stored roll-up is of a day so many days before the last ----------------------
TAKEN_BACK_DAYS = 30
VIEW_BEHIND_DAYS = 90
# ------------------------------------------------------------------------------


def line_price():
    return (F.col("l_extendedprice").cast("decimal(15,2)") *
            (F.lit(1).cast("decimal(15,2)") - F.col("l_discount").cast("decimal(15,2)"))).cast(MONEY)


def lines_as_of(lines, day):
    """Lines that are there on ``day``: shipped, and not taken back yet."""
    back = (F.col("l_returnflag") == "R") & (F.col("l_shipdate") + F.expr(f"INTERVAL {TAKEN_BACK_DAYS} DAYS") <= F.lit(day))
    return lines.where((F.col("l_shipdate") <= F.lit(day)) & ~F.coalesce(back, F.lit(False)))


def line_changes(lines, after, upto):
    """What happened to lines after one day and up to another. Both days are literals and
    the conditions are on the bare column, so they reach the Parquet scan (FLT4)."""
    taken = F.expr(f"INTERVAL {TAKEN_BACK_DAYS} DAYS")
    came = lines.where((F.col("l_shipdate") > F.lit(after)) & (F.col("l_shipdate") <= F.lit(upto)))
    went = lines.where((F.col("l_returnflag") == "R") & (F.col("l_shipdate") > F.lit(after) - taken)
                       & (F.col("l_shipdate") <= F.lit(upto) - taken))
    return came.withColumn("_change_type", F.lit("insert")).unionByName(went.withColumn("_change_type", F.lit("delete")))


@register("mrg11_view_maintenance", f"""
SELECT l_orderkey AS order_id, count(*) AS n_lines,
  CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(18,4)))
       AS DOUBLE) AS total_price, max(l_shipdate) AS updated_at
FROM lineitem, (SELECT max(l_shipdate) AS day FROM lineitem) m
WHERE l_shipdate <= day AND NOT coalesce(l_returnflag = 'R' AND l_shipdate + INTERVAL {TAKEN_BACK_DAYS} DAY <= day, false)
GROUP BY l_orderkey""")
def mrg11_view_maintenance(spark, sf_dir):
    """MRG11 + FLT4 + MRG5: the order roll-up as it was stored 90 days ago, brought up to
    date by the lines that came and went since (those alone are scanned, with the filter in
    the Parquet scan); equal to the roll-up in full."""
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag"])
    last = lines.agg(F.max("l_shipdate").alias("m")).select(
        "m", (F.col("m") - F.expr(f"INTERVAL {VIEW_BEHIND_DAYS} DAYS")).alias("stored")).first()
    ask = {"count": "n_lines", "sums": {"total_price": line_price()}, "top": {"updated_at": "l_shipdate"}}
    path = scratch_path(spark, "stored-rollup")
    views.rollup(lines_as_of(lines, last.stored), ["l_orderkey"], **ask).withColumn(
        "total_price", F.col("total_price").cast("decimal(38,4)")).write.parquet(path)
    now = views.maintained(spark.read.parquet(path), line_changes(lines, last.stored, last.m), lines_as_of(lines, last.m),
                           ["l_orderkey"], **ask)
    return now.withColumnRenamed("l_orderkey", "order_id")


@register("mrg9_watermarks", f"""
SELECT 'lineitem' AS source_table, 'updated_at' AS timestamp_column, mark AS last_processed_timestamp,
  mark AS last_update_time, 'active_orders' AS pipeline_name, true AS is_active
FROM (SELECT greatest((SELECT max(updated_at) FROM v1 WHERE updated_at > stored - INTERVAL 2 HOUR), stored) AS mark
      FROM (SELECT max(updated_at) - INTERVAL {BEHIND_DAYS} DAY AS stored FROM v0) m) n""")
def mrg9_watermarks(spark, sf_dir):
    """MRG7 + MRG8 + MRG9: control table after the load (high-water mark
    never below the stored one)."""
    return _load(spark, sf_dir)[1]


@register("mrg12_idempotency", """
SELECT n AS rows_once, n AS rows_twice, CAST(0 AS BIGINT) AS only_once, CAST(0 AS BIGINT) AS only_twice,
  CAST(0 AS BIGINT) AS rows_changed
FROM (SELECT count(*) AS n FROM (SELECT order_id FROM v0 UNION SELECT order_id FROM v1) k) c""")
def mrg12_idempotency(spark, sf_dir):
    """MRG12: the batch applied once and twice, compared row by row. What one
    application made is written first, and the second starts from it."""
    v0, v1 = _snapshots(spark, sf_dir)
    path = scratch_path(spark, "merged-once")
    cond = F.col("_src.updated_at") > F.col("_tgt.updated_at")
    inc.merge_upsert(v0, v1, KEYS, update_condition=cond, check_unique=False).write.parquet(path)
    once = spark.read.parquet(path)
    twice = inc.merge_upsert(once, v1, KEYS, update_condition=cond, check_unique=False)
    return inc.idempotency_report(once, twice, KEYS)


@register("mrg14_batch_audit", "SELECT *, updated_at AS processed_at, false AS is_deleted FROM v1")
def mrg14_batch_audit(spark, sf_dir):
    """MRG14: batch audit columns (processed_at from the batch's own change
    time here, so the output is reproducible; is_deleted = false)."""
    _, v1 = _snapshots(spark, sf_dir)
    return inc.with_audit(v1, processed_at=F.col("updated_at"), updated_col="updated_at")
