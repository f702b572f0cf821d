"""Table writers (SNK1-SNK4, SNK7, SNK8).

Writes go to a path (or catalog name); counts are taken with an
``Observation`` during the write, so the plan does not run twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_cols=(),
                fmt: str = "parquet", merge_schema: bool = False, clustered: bool = False) -> int:
    """SNK1 / SNK2 / SNK3: write and return the row count observed while
    writing (one job, no recount). Rows of one table partition are brought
    together first, in tasks of even size, so that a partition isn't a small file
    of every task (``clustered``: the caller has dealt them)."""
    if partition_cols and not clustered:
        df = df.hint("rebalance", *partition_cols)
    obs = Observation("rows")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    w.save(path)
    return int(obs.get["n"])


def append_rows(df: DataFrame, path: str) -> int:
    """SNK3: append (audit rows, run log)."""
    return write_table(df, path, mode="append")


def ctas(spark: SparkSession, name: str, select_sql: str, path: str) -> DataFrame:
    """SNK4: ``CREATE OR REPLACE ... AS <CTE query>`` for path tables: run the
    SQL, write it to ``path``, expose it as a temp view ``name``."""
    df = spark.sql(select_sql)
    write_table(df, path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """SNK7: read all versions of a table whose files gained columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def add_columns(df: DataFrame, new_cols: dict) -> DataFrame:
    """SNK7: schema evolution by adding columns (existing rows get the
    given default expressions)."""
    return df.withColumns(new_cols)


def clustered_write(df: DataFrame, path: str, cols, partitions: int | None = None, partition_cols=()) -> int:
    """SNK8: range-partition and sort by ``cols`` before writing, so parquet
    row-group min/max statistics let later filters on ``cols`` skip data
    (the user-level form of Z-ordering)."""
    keys = [*partition_cols, *cols]  # a task then writes few partitions, each in one file
    d = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return write_table(d.sortWithinPartitions(*keys), path, partition_cols=partition_cols, clustered=True)


#: Quantile buckets of each column of a Morton key, as a power of two.
MORTON_BITS = 5


def morton_key(df: DataFrame, cols, bits: int = MORTON_BITS) -> Column:
    """A number whose bits are those of the columns' quantile buckets in turn: rows near to
    each other in all columns have near keys. Buckets are of equal size, however the values
    are spread (cut points by approximate percentiles, one small row); nulls are in the
    first. Columns are numbers, dates or timestamps."""
    def number(c):
        kind = df.schema[c].dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        return F.col(c).cast("double")

    n = 1 << bits
    shares = [k / n for k in range(1, n)]
    cuts = df.agg(*[F.percentile_approx(number(c), shares, 1000).alias(str(i)) for i, c in enumerate(cols)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        points = sorted(set(cuts[i] or []))
        bucket = F.lit(0).cast("long")
        # the highest cut point not above the value, found by halving
        def search(lo, hi):
            if lo == hi:
                return F.lit(lo).cast("long")
            mid = (lo + hi) // 2
            return F.when(number(c) < F.lit(points[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

        if points:
            bucket = F.when(F.col(c).isNull(), F.lit(0).cast("long")).otherwise(search(0, len(points)))
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(bucket, b).bitwiseAND(F.lit(1).cast("long")), b * len(cols) + i))
    return key


def morton_write(df: DataFrame, path: str, cols, partitions: int | None = None, bits: int = MORTON_BITS) -> int:
    """SNK8 on several columns: rows in the order of a Morton key, so that files and row
    groups have narrow ranges of every one of ``cols`` and a filter on any of them skips
    most (a sort by the columns in turn does so for the first alone)."""
    keyed = df.withColumn("_morton", morton_key(df, cols, bits))
    d = keyed.repartitionByRange(partitions, "_morton") if partitions else keyed.repartitionByRange("_morton")
    return write_table(d.sortWithinPartitions("_morton").drop("_morton"), path, clustered=True)


#: Types by width; a column takes the widest of its versions', text if they have no order.
_WIDTH = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both."""
    if a == b:
        return a
    if a in _WIDTH and b in _WIDTH:
        both = max(a, b, key=_WIDTH.index)
        return "double" if both == "float" and {a, b} & {"int", "bigint"} else both
    if {a, b} == {"date", "timestamp_ntz"} or {a, b} == {"date", "timestamp"}:
        return max(a, b, key=len)
    return "string"


def reconciled(versions: list[DataFrame], renamed: dict[str, str] | None = None, defaults: dict | None = None,
               dropped=()) -> DataFrame:
    """SNK7: versions of a table under one schema. Columns are matched by name (without
    case), old names of ``renamed`` taken as the new ones; each has the widest type of its
    versions; a version without it has the default, or null. ``dropped`` columns go, also
    where old versions have them."""
    renamed, defaults = {k.lower(): v for k, v in (renamed or {}).items()}, defaults or {}
    gone = {c.lower() for c in dropped}
    frames, types, names = [], {}, {}
    for df in versions:
        cols = [(c, renamed.get(c.lower(), c)) for c in df.columns]
        df = df.select(*[F.col(f"`{c}`").alias(names.setdefault(new.lower(), new)) for c, new in cols if new.lower() not in gone])
        for f in df.schema.fields:
            kind = f.dataType.simpleString()
            types[f.name] = wider(types[f.name], kind) if f.name in types else kind
        frames.append(df)
    out = [df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(defaults.get(c))).cast(t).alias(c) for c, t in types.items()])
           for df in frames]
    return reduce(lambda a, b: a.unionByName(b), out)
