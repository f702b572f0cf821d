"""Data-quality checks as DataFrames (DQ1-DQ13, SO5, JN6, FLT3, AG14).

Every check is one aggregate over its table that yields one row
``(check_name, table_name, column_name, records_checked, records_failed,
severity, pipeline_stage, check_definition, error_sample)``; a run is the
union of those rows, scored by ``score_checks`` — no driver loop and no
write per check. Error samples are the 5 smallest failing keys: a
``limit(5)`` after a sort (bounded), never a collect of all failures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import col_, pct, ratio
from ..functions.labels import health_colour, health_status

# --- fixed values -------------------------------------------------------------
CRITICAL_FAILURE_THRESHOLD = 0.01
WARNING_FAILURE_THRESHOLD = 0.05
DATA_START_DATE = "2012-01-01"
DATA_END_DATE = "2016-01-01"
ORDER_PRICE_RANGE = (1.0, 500.0)
MAX_SOURCE_CARDINALITY = 20
VALID_DEVICES = ("desktop", "mobile", "tablet")
SEVERITY_WEIGHTS = {"CRITICAL": 0.50, "WARNING": 0.30, "INFO": 0.20}
SEVERITY_ORDER = {"CRITICAL": 1, "WARNING": 2, "INFO": 3}
# ------------------------------------------------------------------------------

RESULT_COLUMNS = ["check_name", "table_name", "column_name", "records_checked",
                  "records_failed", "severity", "pipeline_stage", "check_definition",
                  "error_sample"]


def _row(agg: DataFrame, check, table, column, severity, stage, definition,
         sample: DataFrame | None = None) -> DataFrame:
    """Shape a one-row aggregate (``checked``, ``failed``) as a result row."""
    out = agg.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.coalesce(F.col("checked"), F.lit(0)).cast("long").alias("records_checked"),
        F.coalesce(F.col("failed"), F.lit(0)).cast("long").alias("records_failed"),
        F.lit(severity).alias("severity"), F.lit(stage).alias("pipeline_stage"),
        F.lit(definition).alias("check_definition"),
        (F.col("sample") if "sample" in agg.columns else F.lit(None).cast("string")).alias("_s"))
    if sample is not None:
        out = out.drop("_s").crossJoin(sample.select(F.col("sample").alias("_s")))
    return out.withColumnRenamed("_s", "error_sample")


def sample_keys(failing: DataFrame, key: str, n: int = 5) -> DataFrame:
    """SO5: the ``n`` smallest failing keys as 'k1,k2,...' (one row, bounded)."""
    top = failing.select(F.col(key).alias("k")).orderBy("k").limit(n)
    keys = F.array_sort(F.collect_list("k"))
    joined = F.array_join(F.transform(keys, lambda x: x.cast("string")), ",")
    return top.agg(F.when(F.size(keys) > 0, joined).alias("sample"))


class Spec:
    """A single-pass check: aggregate expressions for records checked /
    failed (and an optional sample) over one table."""

    def __init__(self, check, column, severity, definition, checked, failed, sample=None):
        self.check, self.column, self.severity, self.definition = check, column, severity, definition
        self.checked, self.failed, self.sample = checked, failed, sample


def null_spec(column, severity="CRITICAL") -> Spec:
    return Spec("null_rate_check", column, severity, f"{column} IS NULL", F.count(F.lit(1)),
                F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)))


def date_spec(column, start=DATA_START_DATE, end=DATA_END_DATE, severity="WARNING") -> Spec:
    d = F.to_date(F.col(column))
    bad = (d < F.lit(start).cast("date")) | (d >= F.lit(end).cast("date"))
    sample = F.concat(F.lit("min="), F.min(d).cast("string"), F.lit(", max="), F.max(d).cast("string"))
    return Spec("date_range_validation", column, severity, f"{column} in [{start}, {end})",
                F.count(F.lit(1)), F.sum(F.when(bad, 1).otherwise(0)), sample)


def range_spec(column, lo=None, hi=None, strict_lo=False, severity="WARNING") -> Spec:
    v = F.col(column)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((v > lo) if strict_lo else (v >= lo))
    if hi is not None:
        ok = ok & (v <= hi)
    rule = f"{column} {'>' if strict_lo else '>='} {lo}" if lo is not None else ""
    if hi is not None:
        rule += f"{' AND ' if rule else ''}{column} <= {hi}"
    return Spec("revenue_sanity_check", column, severity, rule, F.count(v),
                F.sum(F.when(v.isNotNull() & ~ok, 1).otherwise(0)))


def cardinality_spec(column, limit=MAX_SOURCE_CARDINALITY, severity="WARNING") -> Spec:
    n = F.countDistinct(column)
    return Spec("cardinality_validation", column, severity, f"COUNT(DISTINCT {column}) <= {limit}",
                n, F.when(n > limit, n).otherwise(0))


def domain_spec(column, allowed=VALID_DEVICES, severity="WARNING") -> Spec:
    bad = ~F.lower(F.col(column)).isin(*allowed)
    return Spec("cardinality_validation", column, severity,
                f"LOWER({column}) IN ({', '.join(allowed)})", F.count(F.lit(1)),
                F.sum(F.when(bad, 1).otherwise(0)))


def table_checks(df: DataFrame, table: str, specs, stage="bronze") -> DataFrame:
    """All single-pass checks of one table in ONE aggregate (one scan), the
    aggregate row exploded into one result row per check."""
    aggs = []
    for i, sp in enumerate(specs):
        aggs += [sp.checked.alias(f"_c{i}"), sp.failed.alias(f"_f{i}"),
                 (sp.sample if sp.sample is not None else F.lit(None).cast("string")).alias(f"_s{i}")]
    row = df.agg(*aggs)
    rows = [F.struct(F.lit(sp.check).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(sp.column).cast("string").alias("column_name"),
                     F.coalesce(F.col(f"_c{i}"), F.lit(0)).cast("long").alias("records_checked"),
                     F.coalesce(F.col(f"_f{i}"), F.lit(0)).cast("long").alias("records_failed"),
                     F.lit(sp.severity).alias("severity"), F.lit(stage).alias("pipeline_stage"),
                     F.lit(sp.definition).alias("check_definition"),
                     F.col(f"_s{i}").cast("string").alias("error_sample"))
            for i, sp in enumerate(specs)]
    return row.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def null_rate(df: DataFrame, table: str, columns, severity="CRITICAL", stage="bronze") -> list:
    """DQ1: NULL count per key column — all columns of a table in one pass."""
    return [table_checks(df, table, [null_spec(c, severity) for c in columns], stage)]


def referential_integrity(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                          table: str, severity="CRITICAL", stage="bronze") -> DataFrame:
    """DQ2 + JN6: non-NULL foreign keys without a parent (left anti join)."""
    c = child.select(F.col(fk).alias("_k")).filter(F.col("_k").isNotNull())
    p = parent.select(F.col(pk).alias("_k"))
    orphans = c.join(p, "_k", "left_anti")
    agg = c.agg(F.count(F.lit(1)).alias("checked")).crossJoin(
        orphans.agg(F.count(F.lit(1)).alias("failed")))
    return _row(agg, "referential_integrity_check", table, fk, severity, stage,
                f"{fk} NOT IN parent.{pk}", sample_keys(orphans, "_k"))


def date_range(df: DataFrame, table: str, column: str, start=DATA_START_DATE,
               end=DATA_END_DATE, severity="WARNING", stage="bronze") -> DataFrame:
    """DQ3: values outside [start, end); NULL dates count as valid."""
    return table_checks(df, table, [date_spec(column, start, end, severity)], stage)


def value_range(df: DataFrame, table: str, column: str, lo=None, hi=None,
                strict_lo=False, severity="WARNING", stage="bronze") -> DataFrame:
    """DQ4: numeric sanity bounds (``lo``/``hi`` inclusive unless strict)."""
    return table_checks(df, table, [range_spec(column, lo, hi, strict_lo, severity)], stage)


def duplicate_keys(df: DataFrame, table: str, keys, severity="CRITICAL", stage="bronze") -> DataFrame:
    """DQ5 + FLT3 + AG14: rows beyond the first per key; NULL keys excluded
    (DQ1 owns them). Groups once by key (partial aggregation), then sums."""
    keys = list(keys)
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    g = df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    agg = g.agg(F.sum("_c").alias("checked"), F.sum(F.col("_c") - 1).alias("failed"))
    name = ",".join(keys)
    dup = g.filter(F.col("_c") > 1)
    sample_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if len(keys) > 1 else F.col(keys[0])
    return _row(agg, "duplicate_detection", table, name, severity, stage,
                f"COUNT(*) > 1 GROUP BY {name}",
                sample_keys(dup.select(sample_key.alias("_k")), "_k"))


def max_cardinality(df: DataFrame, table: str, column: str, limit=MAX_SOURCE_CARDINALITY,
                    severity="WARNING", stage="bronze") -> DataFrame:
    """DQ6: distinct values above ``limit`` fail all-or-nothing."""
    return table_checks(df, table, [cardinality_spec(column, limit, severity)], stage)


def domain(df: DataFrame, table: str, column: str, allowed=VALID_DEVICES,
           severity="WARNING", stage="bronze") -> DataFrame:
    """DQ7: case-insensitive controlled vocabulary."""
    return table_checks(df, table, [domain_spec(column, allowed, severity)], stage)


def score_checks(results: DataFrame, critical=CRITICAL_FAILURE_THRESHOLD,
                 warning=WARNING_FAILURE_THRESHOLD, run_id: Column | str | None = None,
                 run_ts: Column | None = None) -> DataFrame:
    """DQ8: failure rate, pass/fail by severity, deterministic check id."""
    rate = F.when(F.col("records_checked") > 0,
                  pct("records_failed", "records_checked")).otherwise(F.lit(0.0))
    sev = F.col("severity")
    out = results.withColumn("failure_rate_pct", rate)
    passed = (F.when(sev == "CRITICAL", F.col("failure_rate_pct") <= critical * 100)
              .when(sev == "WARNING", F.col("failure_rate_pct") <= warning * 100)
              .otherwise(F.lit(True)))
    out = out.withColumns({
        "passed": passed,
        "check_id": F.concat_ws(":", "check_name", "table_name", F.coalesce("column_name", F.lit(""))),
    })
    if run_id is not None:
        out = out.withColumn("run_id", col_(run_id) if not isinstance(run_id, str) else F.lit(run_id))
    if run_ts is not None:
        out = out.withColumn("run_timestamp", run_ts)
    return out


def run_checks(checks: list) -> DataFrame:
    """Union the one-row check frames into one result frame (SE1)."""
    return reduce(lambda a, b: a.unionByName(b), checks).select(*RESULT_COLUMNS)


def _severity_rank(c="severity"):
    s = F.col(c)
    expr = None
    for k, v in SEVERITY_ORDER.items():
        expr = F.when(s == k, v) if expr is None else expr.when(s == k, v)
    return expr.otherwise(len(SEVERITY_ORDER) + 1)


def scorecard(scored: DataFrame) -> DataFrame:
    """DQ9: totals and pass rate per severity (rows of one run)."""
    g = scored.groupBy("severity").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.sum(F.when(F.col("passed"), 1).otherwise(0)).cast("long").alias("passed_checks"),
        F.sum(F.when(~F.col("passed"), 1).otherwise(0)).cast("long").alias("failed_checks"))
    return g.withColumns({"pass_rate_pct": pct("passed_checks", "total_checks"),
                          "severity_order": _severity_rank()})


def health_score(card: DataFrame, weights=SEVERITY_WEIGHTS) -> DataFrame:
    """DQ10 + PRJ16: weighted pass rate renormalised over the severities
    present, with status and colour bands."""
    w = None
    for k, v in weights.items():
        w = F.when(F.col("severity") == k, F.lit(v)) if w is None else w.when(F.col("severity") == k, F.lit(v))
    c = card.withColumn("_w", w.otherwise(F.lit(0.0)))
    h = c.agg(F.coalesce(ratio(F.sum(F.col("pass_rate_pct") * F.col("_w")), F.sum("_w")),
                         F.lit(0.0)).alias("health_score"),
              F.sum("total_checks").alias("total_checks"),
              F.sum("failed_checks").alias("failed_checks"))
    return h.withColumns({"health_status": health_status("health_score"),
                          "health_colour": health_colour("health_score")})


def failed_checks(scored: DataFrame) -> DataFrame:
    """DQ11 + SO2: failed checks, most severe first."""
    return (scored.filter(~F.col("passed")).withColumn("severity_order", _severity_rank())
            .orderBy("severity_order", F.col("failure_rate_pct").desc(), "check_id"))


def critical_failures(scored: DataFrame) -> DataFrame:
    return scored.filter((F.col("severity") == "CRITICAL") & ~F.col("passed"))


class QualityGateError(RuntimeError):
    pass


def assert_gate(scored: DataFrame) -> None:
    """DQ12: block promotion when any CRITICAL check failed (one tiny action)."""
    bad = critical_failures(scored).select("check_id").collect()  # a row per check
    if bad:
        raise QualityGateError("critical data-quality checks failed: " +
                               ", ".join(r.check_id for r in bad))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """DQ13 + WN13: value counts with % of total (a one-row total joined to
    the groups, so a high-cardinality column never lands in one task)."""
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("records"))
    total = g.agg(F.sum("records").alias("_total"))       # one-row aggregate of the same groups
    return g.crossJoin(total).withColumn("pct_of_total", pct("records", "_total")).drop("_total")


# ----------------------------------------------------------------- runs
def append_run(scored: DataFrame, store: str, run_id: str) -> DataFrame:
    """DQ8: append the results of one run to the store, under its run id and time. The
    store is only ever appended to; a run that is written again after a failure replaces
    its own folder alone. Returns the run as written."""
    run = scored.withColumn("run_timestamp", F.localtimestamp())
    run.coalesce(1).write.mode("overwrite").parquet(f"{store}/run_id={run_id}")  # a row per check
    return read_run(scored.sparkSession, store, run_id)


def run_history(spark: SparkSession, store: str) -> DataFrame:
    """All runs of the store."""
    return spark.read.parquet(store).withColumn("run_id", F.col("run_id").cast("string"))


def read_run(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """DQ9: the results of one run, the latest if none is named. Only that run's folder is
    read."""
    runs = run_history(spark, store)
    if run_id is None:
        run_id = runs.groupBy("run_id").agg(F.max("run_timestamp").alias("t")).orderBy(
            F.desc("t"), F.desc("run_id")).first().run_id
    return runs.where(F.col("run_id") == run_id)


def run_trend(spark: SparkSession, store: str) -> DataFrame:
    """DQ9: pass rate and failed checks of every run, oldest first."""
    return run_history(spark, store).groupBy("run_id").agg(
        F.min("run_timestamp").alias("run_timestamp"), F.count(F.lit(1)).alias("total_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        pct(F.count_if("passed"), F.count(F.lit(1))).alias("pass_rate_pct")).orderBy("run_timestamp", "run_id")
