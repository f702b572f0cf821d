"""Two-pass external shuffle into shards, with DataFrame operations only.

Pass 1 scatters the rows uniformly into buckets of about ``bucket_bytes`` by a
seeded hash of the whole row. Pass 2 takes each bucket into memory, shuffles it
(Spark's ``shuffle`` is a Fisher-Yates shuffle) and writes it. The buckets one
after the other are the shuffled order; shard s is its s-th part, so shard sizes
differ by one row at most, and a bucket's rows go to one or two shards.

Before the passes the rows' hashes alone are grouped: their counts give the
buckets' sizes and starting places. A row that occurs in more than a ten
thousandth of all rows, with all its columns equal (there are fewer than 10,000
such rows, so their hashes can be sent to every task), would fill a bucket with
its copies; it is taken out once, and its copies are scattered by their number.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import work_columns, written

SHARDS = 40
#: Text of one bucket; a task holds a few times as much while it shuffles one.
BUCKET_BYTES = 16 << 20
#: A row is hot above this share of all rows, and above this many copies.
HOT_SHARE, HOT_COPIES = 10_000, 1000


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(16)).cast("bigint")


def _copies(df: DataFrame, n: Column, copy: str) -> DataFrame:
    return df.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"))))


def shuffle_to_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 42, text_col: str = "text",
                      bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the rows of ``docs``, in shuffled order, as Parquet under ``path``, a
    folder ``shard=...`` for each shard, and return them read back: all columns
    and ``shard``, ``slot`` (place in the shard, gapless from 0). A column of
    ``docs`` with one of these names is an error.

    Null and empty texts are rows like any other, as are rows without an id;
    repeated rows stay repeated. Which bucket a row goes to depends on its
    content and the seed alone. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    if {"shard", "slot"} & {c.lower() for c in docs.columns}:
        raise ValueError("docs has a column named shard or slot")
    work = work_columns(docs, h=None, n=None, bucket=None, at=None, rows=None, copy=None)
    h, n, bucket, copy, at, rows = (work[k] for k in ("h", "n", "bucket", "copy", "at", "rows"))
    hashed = docs.withColumn(h, F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns]))
    size = row_bytes(F.col(f"`{text_col}`"))
    stats = written(hashed.groupBy(h).agg(F.count("*").alias(n), F.sum(size).alias("size")), "row-hashes")
    total, all_bytes = stats.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-all_bytes // bucket_bytes))
    limit = max(HOT_COPIES, total // HOT_SHARE)
    hot = written(stats.where(F.col(n) > limit).select(h, n), "hot-rows")

    plain = F.pmod(F.col(h), F.lit(buckets))
    salted = F.pmod(F.xxhash64(F.lit(seed), F.col(h), F.col(copy)), F.lit(buckets))

    # Where each bucket starts in the shuffled order.
    counts = (stats.where(F.col(n) <= limit).select(plain.alias(bucket), n)
              .unionByName(_copies(hot, F.col(n), copy).select(salted.alias(bucket), F.lit(1).alias(n)))
              .groupBy(bucket).agg(F.sum(n).alias("n")))
    starts = written(counts.select(bucket, F.expr(f"sum(n) OVER (ORDER BY `{bucket}`) - n").alias(at)), "bucket-starts")

    # Pass 1: scatter.
    known = F.broadcast(hot.select(h))
    rest = hashed.join(known, h, "left_anti").withColumn(bucket, plain)
    fewer = hashed.join(known, h, "left_semi").dropDuplicates([h])
    spread = _copies(fewer.join(hot, h), F.col(n), copy).withColumn(bucket, salted)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    scattered = rest.select(bucket, F.struct(*columns).alias(rows)).unionByName(
        spread.select(bucket, F.struct(*columns).alias(rows)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(buckets, 100_000))
    # Pass 2: shuffle each bucket, number its rows, write.
    shuffled = (scattered.repartition(tasks, bucket).groupBy(bucket)
                .agg(F.shuffle(F.collect_list(rows), F.lit(seed)).alias(rows)).join(starts, bucket)
                .select(at, F.posexplode(rows).alias("pos", "row")))
    place = F.col(at) + F.col("pos")
    # Exact in integers: shard s holds the places from ceil(s * total / shards) on.
    shard = F.expr(f"cast((`{at}` + pos) * {shards}L div {max(total, 1)}L as int)")
    first = F.expr(f"(cast(shard as bigint) * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    out = (shuffled.select("row", place.alias("place"), shard.alias("shard"))
           .select("row.*", (F.col("place") - first).alias("slot"), "shard"))
    out.write.mode("overwrite").partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def shards_path(spark) -> str:
    return scratch_path(spark, "shards")


def law_holds(sharded: DataFrame, shards: int) -> DataFrame:
    """One row: whether shard sizes are at most one apart and slots are gapless."""
    per = sharded.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"),
                                       F.min("slot").alias("low"), F.max("slot").alias("high"))
    gapless = functools.reduce(operator.and_, [F.col("n") == F.col("slots"), F.col("low") == 0,
                                               F.col("high") == F.col("n") - 1])
    return per.agg((F.max("n") - F.min("n") <= 1).alias("even"), F.min(gapless).alias("gapless"),
                   (F.count("*") <= shards).alias("in_range"))
