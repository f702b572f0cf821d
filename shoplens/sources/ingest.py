"""Bronze ingest: explicit-schema CSV scans, bad-row quarantine, audit
columns (SRC1, SRC2, SRC6, SNK5, SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: bronze schemas (never inferred) -----------------------------
SCHEMAS = {
    "website_sessions": _schema(("website_session_id", L), ("created_at", S), ("user_id", L),
                                ("is_repeat_session", I), ("utm_source", S), ("utm_campaign", S),
                                ("utm_content", S), ("device_type", S), ("http_referer", S)),
    "website_pageviews": _schema(("website_pageview_id", L), ("created_at", S),
                                 ("website_session_id", L), ("pageview_url", S)),
    "orders": _schema(("order_id", L), ("created_at", S), ("website_session_id", L), ("user_id", L),
                      ("primary_product_id", I), ("items_purchased", I), ("price_usd", D), ("cogs_usd", D)),
    "order_items": _schema(("order_item_id", L), ("created_at", S), ("order_id", L), ("product_id", I),
                           ("is_primary_item", I), ("price_usd", D), ("cogs_usd", D)),
    "order_item_refunds": _schema(("order_item_refund_id", L), ("created_at", S), ("order_item_id", L),
                                  ("order_id", L), ("refund_amount_usd", D)),
    "products": _schema(("product_id", I), ("created_at", S), ("product_name", S)),
}
CORRUPT = "_corrupt_record"
NULL_TEXT = "NULL"
# -------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: T.StructType, quarantine: bool = True) -> DataFrame:
    """SRC1: header CSV with an explicit schema in PERMISSIVE mode; literal
    'NULL' text reads as NULL; with ``quarantine`` a ``_corrupt_record``
    column keeps the raw text of rows that did not fit the schema."""
    sch = T.StructType(schema.fields + [T.StructField(CORRUPT, S, True)]) if quarantine else schema
    r = (spark.read.schema(sch).option("header", True).option("mode", "PERMISSIVE")
         .option("nullValue", NULL_TEXT))
    if quarantine:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    return r.csv(path)


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC2: (good, bad) by the corrupt-record column. Cache-free: each side
    is a filter of the same scan (Spark re-reads, which is cheaper than
    caching a whole bronze table)."""
    bad = F.col(CORRUPT).isNotNull()
    # Spark refuses scans that read only the corrupt-record column (e.g. a
    # bare count); the predicate also touches the first data column so the
    # parser always materialises a real field.
    first = df.columns[0]
    touch = (F.length(F.concat_ws("", F.col(CORRUPT), F.col(first).cast("string")))
             >= F.coalesce(F.length(F.col(CORRUPT)), F.lit(0)))
    return df.filter(~bad & touch).drop(CORRUPT), df.filter(bad & touch)


def with_audit(df: DataFrame, source_table: str, layer: str = "bronze") -> DataFrame:
    """SNK6: _ingest_ts, _source_table, _layer."""
    return df.withColumns({"_ingest_ts": F.current_timestamp(), "_source_table": F.lit(source_table),
                           "_layer": F.lit(layer)})
