"""Registered data-quality queries: the 18-check suite over the canonical
bronze tables derived from the driver data, and its reports."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException

from ..operators import quality as dq
from ..session import scratch_path
from ..sources import adapters as ad
from ..sources.driver import read_table
from .catalog import register
from .oracle_ctes import CTES, _pct
from .worlds import ClickWorld, CommerceWorld


# --- fixed values: date bounds, such that most rows of the data lie inside ------
CLICK_DATES = ("2024-01-01", "2024-01-29")
ORDER_DATES = ("1995-03-01", "2002-01-01")
# ---------------------------------------------------------------------------


def suite(spark, sf_dir):
    """DQ1-DQ7 over: sessions / pageviews / orders from events; items,
    refunds, products and parent orders from the star schema."""
    c, m = ClickWorld(spark, sf_dir), CommerceWorld(spark, sf_dir)

    def silver(df, name, *columns):
        path, df = scratch_path(spark, f"dq-{name}"), df.select(*columns)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # Tables with several checks are derived once, with the columns that are checked.
    s = silver(c.raw_sessions, "sessions", "website_session_id", "user_id", "created_at", "utm_source", "device_type")
    o = silver(c.raw_orders, "orders", "order_id", "website_session_id", "created_at", "price_usd")
    it = silver(m.items, "items", "order_id", "line_number", "created_at", "price_usd", "is_refunded",
                "product_id")
    pv = c.pageviews
    rf, pr = it.filter("is_refunded"), ad.commerce_products(it)
    mo = read_table(spark, sf_dir, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "order_id")
    customers = read_table(spark, sf_dir, "customer", ["c_custkey"])
    # single-pass checks: one aggregate (one scan) per table
    checks = [
        dq.table_checks(s, "website_sessions", [
            dq.null_spec("website_session_id"), dq.date_spec("created_at", *CLICK_DATES),
            dq.cardinality_spec("utm_source"), dq.domain_spec("device_type")]),
        dq.table_checks(pv, "website_pageviews", [dq.null_spec("website_pageview_id")]),
        dq.table_checks(o, "orders", [dq.null_spec("order_id"), dq.date_spec("created_at", *CLICK_DATES),
                                      dq.range_spec("price_usd", *dq.ORDER_PRICE_RANGE)]),
        dq.table_checks(it, "order_items", [dq.null_spec("order_id"), dq.date_spec("created_at", *ORDER_DATES),
                                            dq.range_spec("price_usd", lo=0, strict_lo=True,
                                                          severity="CRITICAL")]),
        dq.table_checks(rf, "order_item_refunds", [dq.null_spec("order_id")]),
        dq.table_checks(pr, "products", [dq.null_spec("product_id")]),
    ]
    # checks that need a join or a grouping of their own
    checks.append(dq.referential_integrity(o, "website_session_id", s, "website_session_id", "orders"))
    checks.append(dq.referential_integrity(it, "order_id", mo, "order_id", "order_items"))
    checks.append(dq.referential_integrity(customers, "c_custkey", s, "user_id", "customers", severity="INFO"))
    checks.append(dq.duplicate_keys(s, "website_sessions", ["website_session_id"]))
    checks.append(dq.duplicate_keys(o, "orders", ["order_id"]))
    checks.append(dq.duplicate_keys(it, "order_items", ["order_id", "line_number"]))
    return dq.score_checks(dq.run_checks(checks))


# ------------------------------------------------------------------ oracle SQL
def _res(check, table, column, checked, failed, severity, definition, sample="CAST(NULL AS VARCHAR)",
         src=""):
    col = f"'{column}'" if column is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, {col} AS column_name, "
            f"CAST(coalesce({checked}, 0) AS BIGINT) AS records_checked, "
            f"CAST(coalesce({failed}, 0) AS BIGINT) AS records_failed, '{severity}' AS severity, "
            f"'bronze' AS pipeline_stage, '{definition}' AS check_definition, {sample} AS error_sample {src}")


def _sample(q):
    return f"(SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM ({q} ORDER BY k LIMIT 5) z)"


def _null(table, src, col):
    return _res("null_rate_check", table, col, "count(*)", f"count(*) - count({col})", "CRITICAL",
                f"{col} IS NULL", src=f"FROM {src}")


def _ri(table, child, fk, parent, pk, severity="CRITICAL"):
    orphans = (f"SELECT c.{fk} AS k FROM {child} c WHERE c.{fk} IS NOT NULL "
               f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")
    return _res("referential_integrity_check", table, fk,
                f"(SELECT count({fk}) FROM {child})", f"(SELECT count(*) FROM ({orphans}) y)", severity,
                f"{fk} NOT IN parent.{pk}", _sample(orphans))


def _date(table, src, col, bounds):
    d, (lo, hi) = f"CAST({col} AS DATE)", bounds
    bad = f"({d} < DATE '{lo}' OR {d} >= DATE '{hi}')"
    return _res("date_range_validation", table, col, "count(*)", f"sum(CASE WHEN {bad} THEN 1 ELSE 0 END)",
                "WARNING", f"{col} in [{lo}, {hi})",
                f"'min=' || CAST(min({d}) AS VARCHAR) || ', max=' || CAST(max({d}) AS VARCHAR)", f"FROM {src}")


def _dup(table, src, keys):
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    key_str = " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in keys) if len(keys) > 1 else keys[0]
    g = f"SELECT {k}, count(*) AS c FROM {src} WHERE {nn} GROUP BY {k}"
    name = ",".join(keys)
    return _res("duplicate_detection", table, name, f"(SELECT sum(c) FROM ({g}) a)",
                f"(SELECT sum(c - 1) FROM ({g}) b)", "CRITICAL", f"COUNT(*) > 1 GROUP BY {name}",
                _sample(f"SELECT {key_str} AS k FROM ({g}) d WHERE c > 1"))


CTES["dq_raw"] = " UNION ALL ".join([
    _null("website_sessions", "sess_raw", "website_session_id"),
    _null("website_pageviews", "pv", "website_pageview_id"),
    _null("orders", "c_orders_raw", "order_id"),
    _null("order_items", "m_lines", "l_orderkey").replace("'l_orderkey'", "'order_id'")
    .replace("l_orderkey IS NULL", "order_id IS NULL"),
    _null("order_item_refunds", "(SELECT l_orderkey FROM m_lines WHERE l_returnflag = 'R') r", "l_orderkey")
    .replace("'l_orderkey'", "'order_id'").replace("l_orderkey IS NULL", "order_id IS NULL"),
    _null("products", "m_products", "product_id"),
    _ri("orders", "c_orders_raw", "website_session_id", "sess_raw", "website_session_id"),
    _ri("order_items", "(SELECT l_orderkey AS order_id FROM m_lines)", "order_id",
        "(SELECT o_orderkey AS order_id FROM orders)", "order_id"),
    _ri("customers", "customer", "c_custkey", "sess_raw", "user_id", "INFO"),
    _date("website_sessions", "sess_raw", "created_at", CLICK_DATES),
    _date("orders", "c_orders_raw", "created_at", CLICK_DATES),
    _date("order_items", "m_lines", "o_orderdate", ORDER_DATES).replace("'o_orderdate'", "'created_at'")
    .replace("o_orderdate in [", "created_at in ["),
    _res("revenue_sanity_check", "orders", "price_usd", "count(price_usd)",
         "sum(CASE WHEN price_usd IS NOT NULL AND NOT (price_usd >= 1.0 AND price_usd <= 500.0) THEN 1 ELSE 0 END)",
         "WARNING", "price_usd >= 1.0 AND price_usd <= 500.0", src="FROM c_orders_raw"),
    _res("revenue_sanity_check", "order_items", "price_usd", "count(price_usd)",
         "sum(CASE WHEN price_usd IS NOT NULL AND NOT (price_usd > 0) THEN 1 ELSE 0 END)",
         "CRITICAL", "price_usd > 0", src="FROM m_lines"),
    _dup("website_sessions", "sess_raw", ["website_session_id"]),
    _dup("orders", "c_orders_raw", ["order_id"]),
    _dup("order_items", "(SELECT l_orderkey AS order_id, l_linenumber AS line_number FROM m_lines)",
         ["order_id", "line_number"]),
    _res("cardinality_validation", "website_sessions", "utm_source", "count(DISTINCT utm_source)",
         "CASE WHEN count(DISTINCT utm_source) > 20 THEN count(DISTINCT utm_source) ELSE 0 END",
         "WARNING", "COUNT(DISTINCT utm_source) <= 20", src="FROM sess_raw"),
    _res("cardinality_validation", "website_sessions", "device_type", "count(*)",
         "sum(CASE WHEN lower(device_type) NOT IN ('desktop', 'mobile', 'tablet') THEN 1 ELSE 0 END)",
         "WARNING", "LOWER(device_type) IN (desktop, mobile, tablet)", src="FROM sess_raw"),
])

CTES["dq_scored"] = f"""
SELECT *, check_name || ':' || table_name || ':' || coalesce(column_name, '') AS check_id,
  CASE WHEN severity = 'CRITICAL' THEN failure_rate_pct <= 1.0
       WHEN severity = 'WARNING' THEN failure_rate_pct <= 5.0 ELSE true END AS passed
FROM (SELECT *, CASE WHEN records_checked > 0 THEN {_pct('records_failed', 'records_checked')} ELSE 0.0 END
        AS failure_rate_pct FROM dq_raw) r"""

CTES["dq_card"] = f"""
SELECT severity, count(*) AS total_checks, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed_checks,
  CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS failed_checks,
  {_pct('sum(CASE WHEN passed THEN 1 ELSE 0 END)', 'count(*)')} AS pass_rate_pct,
  CAST(CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 3 ELSE 4 END AS BIGINT)
    AS severity_order
FROM dq_scored GROUP BY severity"""


_STORES: dict[tuple[str, str], str] = {}


def store(spark, sf_dir):
    """The store of this application's runs over a data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    return _STORES.setdefault(key, scratch_path(spark, "dq-runs"))


def new_run(spark, sf_dir):
    """Run the suite and append its results to the store."""
    return dq.append_run(suite(spark, sf_dir), store(spark, sf_dir), uuid.uuid4().hex)


def latest_run(spark, sf_dir):
    """Results of the latest run, of which reports read what was written; the suite runs
    where it hasn't yet."""
    try:
        return dq.read_run(spark, store(spark, sf_dir))
    except AnalysisException:
        return new_run(spark, sf_dir)


RUN_COLUMNS = ("run_id", "run_timestamp")


@register("dq_results", "SELECT * FROM dq_scored")
def dq_results(spark, sf_dir):
    """DQ1-DQ8 (+ JN6, SO5, FLT3, AG14): 19 checks scored in one run, appended to the store."""
    return new_run(spark, sf_dir).drop(*RUN_COLUMNS)


@register("dq9_scorecard", "SELECT * FROM dq_card")
def dq9_scorecard(spark, sf_dir):
    """DQ9: pass rate by severity of one run, the latest."""
    return dq.scorecard(latest_run(spark, sf_dir))


@register("dq10_health_score", """
SELECT *, CASE WHEN health_score >= 95 THEN 'EXCELLENT' WHEN health_score >= 85 THEN 'GOOD'
    WHEN health_score >= 70 THEN 'FAIR' ELSE 'POOR' END AS health_status,
  CASE WHEN health_score >= 95 THEN 'GREEN' WHEN health_score >= 85 THEN 'GREEN'
    WHEN health_score >= 70 THEN 'AMBER' ELSE 'RED' END AS health_colour
FROM (SELECT coalesce(sum(pass_rate_pct * w) / NULLIF(sum(w), 0), 0.0) AS health_score,
        CAST(sum(total_checks) AS BIGINT) AS total_checks, CAST(sum(failed_checks) AS BIGINT) AS failed_checks
      FROM (SELECT *, CASE severity WHEN 'CRITICAL' THEN CAST(0.5 AS DOUBLE) WHEN 'WARNING' THEN CAST(0.3 AS DOUBLE)
                 WHEN 'INFO' THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS w FROM dq_card) a) b""")
def dq10_health_score(spark, sf_dir):
    """DQ10 + PRJ16: weighted health score with status and colour."""
    return dq.health_score(dq.scorecard(latest_run(spark, sf_dir)))


@register("dq11_failed_checks", """
SELECT *, CAST(CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 3 ELSE 4 END
  AS BIGINT) AS severity_order
FROM dq_scored WHERE NOT passed""")
def dq11_failed_checks(spark, sf_dir):
    """DQ11 + SO2: failed checks, most severe first."""
    return dq.failed_checks(latest_run(spark, sf_dir)).drop(*RUN_COLUMNS)


@register("dq13_source_distribution", f"""
SELECT utm_source, count(*) AS records, {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total
FROM sess_raw GROUP BY utm_source""")
def dq13_source_distribution(spark, sf_dir):
    """DQ13 + WN13: value distribution with share of total."""
    return dq.value_distribution(ClickWorld(spark, sf_dir).raw_sessions, "utm_source")
