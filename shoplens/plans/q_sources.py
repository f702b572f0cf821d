"""Registered source / sink round trips over data derived from the driver
tables (written to the session's shared folder, read back)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir
from ..sources import ingest, sinks
from ..sources.driver import read_table
from .catalog import register
from .worlds import ClickWorld, CommerceWorld


def _scratch(spark, name):
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@register("src1_csv_pageviews", """
SELECT website_pageview_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, website_session_id,
  pageview_url FROM pv""")
def src1_csv_pageviews(spark, sf_dir):
    """SRC1 + SRC2 + SNK1: pageviews written as header CSV, read back with
    the explicit bronze schema (PERMISSIVE, quarantine column), good rows."""
    pv = ClickWorld(spark, sf_dir).pageviews.select(
        "website_pageview_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        "website_session_id", "pageview_url")
    path = _scratch(spark, "src1")
    pv.write.mode("overwrite").option("header", True).csv(path)
    good, _bad = ingest.split_bad_rows(ingest.read_csv(spark, path, ingest.SCHEMAS["website_pageviews"]))
    return good


@register("src2_csv_quarantine", """
SELECT CASE WHEN website_pageview_id % 97 <> 0 THEN website_pageview_id END AS website_pageview_id,
  CASE WHEN website_pageview_id % 97 = 0 THEN 'x' || CAST(website_pageview_id AS VARCHAR) || ','
    || strftime(created_at, '%Y-%m-%d %H:%M:%S') || ',' || CAST(website_session_id AS VARCHAR) || ',' || pageview_url
    END AS raw_row, website_pageview_id % 97 = 0 AS quarantined FROM pv""")
def src2_csv_quarantine(spark, sf_dir):
    """SRC2: a CSV in which one id in 97 is not a number: good rows by their id,
    bad rows with their raw text; none is lost."""
    ident = F.col("website_pageview_id").cast("string")
    pv = ClickWorld(spark, sf_dir).pageviews.select(
        F.when(F.col("website_pageview_id") % 97 == 0, F.concat(F.lit("x"), ident)).otherwise(ident)
        .alias("website_pageview_id"), F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        "website_session_id", "pageview_url")
    path = _scratch(spark, "src2")
    pv.write.option("header", True).csv(path)
    good, bad = ingest.split_bad_rows(ingest.read_csv(spark, path, ingest.SCHEMAS["website_pageviews"]))
    none = F.lit(None)
    return (good.select("website_pageview_id", none.cast("string").alias("raw_row"), F.lit(False).alias("quarantined"))
            .unionByName(bad.select(none.cast("long").alias("website_pageview_id"),
                                    F.col(ingest.CORRUPT).alias("raw_row"), F.lit(True).alias("quarantined"))))


@register("snk8_clustered_items", """
SELECT CAST(item_year AS BIGINT) AS item_year, product_id, count(*) AS line_items,
  CAST(sum(CAST(price_usd AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM m_items WHERE item_year >= 1997 AND product_id BETWEEN 20 AND 39 GROUP BY 1, 2""")
def snk8_clustered_items(spark, sf_dir):
    """SNK8 + SNK5: items written partitioned by year and clustered by product,
    read back by year (whole partitions are skipped) and product (row groups)."""
    items = CommerceWorld(spark, sf_dir).items_enriched
    path = _scratch(spark, "snk8")
    sinks.clustered_write(items, path, ["product_id", "order_id"], partition_cols=["item_year"])
    back = spark.read.parquet(path).filter((F.col("item_year") >= 1997) & F.col("product_id").between(20, 39))
    return back.groupBy("item_year", "product_id").agg(F.count(F.lit(1)).alias("line_items"),
                                          F.sum(F.col("price_usd").cast("decimal(18,4)")).cast("double")
                                          .alias("revenue"))


# --- fixed values: what the selective read asks for ---------------------------
PART_RANGE = (100, 160)
# ------------------------------------------------------------------------------


@register("snk8_morton_items", f"""
SELECT l_partkey, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
  min(l_shipdate) AS first_shipped, max(l_shipdate) AS last_shipped
FROM lineitem WHERE l_partkey BETWEEN {PART_RANGE[0]} AND {PART_RANGE[1]} GROUP BY l_partkey""")
def snk8_morton_items(spark, sf_dir):
    """SNK8 on two columns: line items written in Morton order of ship date and part, then
    read by a range of the second."""
    path = scratch_path(spark, "morton-items")
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice"])
    sinks.morton_write(lines, path, ["l_shipdate", "l_partkey"], partitions=8)
    some = spark.read.parquet(path).where(F.col("l_partkey").between(*PART_RANGE))
    return some.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        F.min("l_shipdate").alias("first_shipped"), F.max("l_shipdate").alias("last_shipped"))


@register("snk7_reconciled_versions", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, CASE WHEN v = 0 THEN NULL ELSE l_returnflag END AS flag,
  CASE WHEN v = 0 THEN CAST(floor(l_quantity) AS DOUBLE) ELSE CAST(l_quantity AS DOUBLE) END AS quantity,
  CASE WHEN v = 2 THEN l_linestatus ELSE 'unknown' END AS status
FROM (SELECT *, l_orderkey % 3 AS v FROM lineitem) t""")
def snk7_reconciled_versions(spark, sf_dir):
    """SNK7: three written versions of a table (the second has one more column and a wider
    type, the third one more again, another name for the key, and lacks a column that was
    dropped) read under one schema."""
    path = scratch_path(spark, "versions")
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"])
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    of = [lines.where(key % 3 == v) for v in range(3)]
    sinks.write_table(of[0].select(key.alias("orderkey"), line.alias("line"), F.floor("l_quantity").cast("int").alias("quantity"),
                                   F.col("l_tax").alias("tax")), f"{path}/0")
    sinks.write_table(of[1].select(key.alias("orderkey"), line.cast("bigint").alias("line"), F.col("l_quantity").alias("quantity"),
                                   F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag")), f"{path}/1")
    sinks.write_table(of[2].select(key.alias("order_id"), line.alias("LINE"), F.col("l_quantity").alias("quantity"),
                                   F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")), f"{path}/2")
    return sinks.reconciled([spark.read.parquet(f"{path}/{v}") for v in range(3)], renamed={"orderkey": "order_id"},
                            defaults={"status": "unknown"}, dropped=["tax"])


@register("snk3_append_batches", """
SELECT CAST(year(l_shipdate) AS BIGINT) AS ship_year, count(*) AS lines FROM lineitem GROUP BY 1""")
def snk3_append_batches(spark, sf_dir):
    """SNK3: line items appended in two batches, each counted while it is written, then read
    back as one table."""
    path = scratch_path(spark, "appended")
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
    counts = [sinks.append_rows(lines.where(F.col("l_orderkey") % 2 == k), path) for k in range(2)]
    back = spark.read.parquet(path)
    if sum(counts) != back.count():
        raise RuntimeError("the counts observed while writing differ from the rows read back")
    return back.groupBy(F.year("l_shipdate").alias("ship_year")).agg(F.count(F.lit(1)).alias("lines"))


@register("snk4_ctas", """
WITH r AS (SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY 1, 2) SELECT * FROM r""")
def snk4_ctas(spark, sf_dir):
    """SNK4: a table made from a query with a common table expression."""
    name = f"ctas_{uuid.uuid4().hex}"
    read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus"]).createOrReplaceTempView(f"src_{name}")
    sql = f"WITH r AS (SELECT l_returnflag, l_linestatus, count(*) AS lines FROM src_{name} GROUP BY 1, 2) SELECT * FROM r"
    try:
        return sinks.ctas(spark, name, sql, scratch_path(spark, "ctas"))
    finally:
        spark.catalog.dropTempView(f"src_{name}")
        spark.catalog.dropTempView(name)
