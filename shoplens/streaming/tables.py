"""A Parquet table of partition folders and manifests, written by micro-batches.

A batch writes new folders only for the partitions it touches; what other partitions
hold stays where it is. Then one manifest, named by the batch id, lists the folders of
the whole table. It is written aside and renamed, so readers see the table before or
after a batch and nothing between. A batch whose manifest is there has been committed
and is not applied again; one that failed half way is written anew over its folders.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.incremental import assert_unique_keys, merge_upsert, newest_per_key


def safe_name(value: Column) -> Column:
    """A partition's folder name; values that share a name share a folder."""
    return F.coalesce(F.regexp_replace(value.cast("string"), "[^A-Za-z0-9_.-]", "_"), F.lit("none"))


class ManifestTable:
    """``base``/data/batch=<id>/... and ``base``/manifests/<id>.json, reached through the
    Hadoop file system of the path. The driver handles names, never rows."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._read_all = jvm.org.apache.commons.io.IOUtils.toString
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8

    def _file(self, batch: int):
        return self._path(f"{self.base}/manifests/{batch}.json")

    def batches(self) -> list[int]:
        folder = self._path(f"{self.base}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def committed(self, batch: int) -> bool:
        return self._fs.exists(self._file(batch))

    def latest(self, upto: int | None = None) -> dict | None:
        """The newest manifest (of batches up to ``upto``)."""
        found = [b for b in self.batches() if upto is None or b <= upto]
        if not found:
            return None
        stream = self._fs.open(self._file(found[-1]))
        try:
            return json.loads(self._read_all(stream, self._utf8))
        finally:
            stream.close()

    def commit(self, batch: int, folders: dict[str, list[str]], schema: StructType, **more) -> None:
        text = json.dumps({"batch": batch, "folders": folders, "schema": schema.jsonValue()} | more)
        aside = self._path(f"{self.base}/manifests/.{batch}.tmp")
        out = self._fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(aside, self._file(batch)) and not self.committed(batch):
            raise OSError(f"manifest of batch {batch} couldn't be put in place")

    def folder(self, batch: int, *parts: str) -> str:
        return "/".join([self.base, "data", f"batch={batch}", *parts])

    def write(self, df: DataFrame, batch: int, *by: str) -> None:
        """Write a batch's rows into folders by the columns ``by``; rows of one folder are
        brought together first, in tasks of even size."""
        df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(self.folder(batch))

    def rows(self, manifest: dict | None, only=None) -> DataFrame | None:
        """Rows of the table, or of the named partitions; None if there are none."""
        if manifest is None:
            return None
        paths = [p for name, folders in sorted(manifest["folders"].items()) if only is None or only(name) for p in folders]
        schema = StructType.fromJson(manifest["schema"])
        if not paths:
            return None
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/data/{p}" for p in paths])


def upsert_into(base: str, keys, partition: Column, update_col: str | None = None):
    """STR3: ``foreachBatch`` handler that merges micro-batches into a manifest table.

    ``partition`` is an expression over the keys, so a key stays in its partition. Only
    partitions with rows in the batch are read and written anew (copy on write). With
    ``update_col`` a row is replaced by one that is as new or newer; without it the
    batch's row counts.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        table = ManifestTable(batch.sparkSession, base)
        if table.committed(batch_id):
            return
        before = table.latest(batch_id - 1)
        folders = dict(before["folders"]) if before else {}
        batch = batch.persist()  # read for the partitions' names, and for the merge
        try:
            touched = {r[0] for r in batch.select(safe_name(partition)).distinct().collect()}
            if touched:
                old = table.rows(before, lambda name: name in touched)
                condition = (F.col(f"_src.{update_col}") >= F.col(f"_tgt.{update_col}")) if update_col else None
                if old is not None:
                    after = merge_upsert(old, batch, keys, update_condition=condition, order_col=update_col)
                elif update_col:
                    after = newest_per_key(batch, keys, update_col)
                else:
                    assert_unique_keys(batch, keys)
                    after = batch
                table.write(after.withColumn("_partition", safe_name(partition)), batch_id, "_partition")
                folders |= {name: [f"batch={batch_id}/_partition={name}"] for name in touched}
            table.commit(batch_id, folders, batch.schema, touched=sorted(touched))
        finally:
            batch.unpersist()

    return handle


def split_late_into(base: str, id_cols, ts_col: str, delay: str):
    """STR2: ``foreachBatch`` handler that keeps every row of the stream on one of three
    sides, day by day: ``kept``, ``replay`` and ``late``.

    A row is late if its event time lies before the committed watermark: the largest event
    time of the batches before, less ``delay``. Of the others it is a replay if its id was
    kept before with an event time not older than the watermark less ``delay``, or if the
    batch has another row of that id that comes first by event time. Rows without an event
    time are never late, rows without an id never a replay. Rows read = kept + replay + late; the
    counts and the watermark are in the manifest.
    """
    ids = list(id_cols)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = ManifestTable(spark, base)
        if table.committed(batch_id):
            return
        before = table.latest(batch_id - 1)
        # the batch is written first: row numbers then stay the same if a task runs again
        staged = f"{table.base}/staged/batch={batch_id}"
        batch.withColumn("_row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(StructType([*batch.schema.fields, StructField("_row", LongType())])).parquet(staged)
        mark = F.lit(before["watermark"]).cast("timestamp") if before and before["watermark"] else F.lit(None).cast("timestamp")
        ts, wait = F.col(ts_col).cast("timestamp"), F.expr(f"INTERVAL {delay}")
        rows = rows.withColumn("_late", F.coalesce(ts < mark, F.lit(False)))
        first = (rows.where("NOT _late").groupBy(*ids).agg(F.min(F.struct(ts.alias("t"), "_row")).alias("_f"))
                 .select(F.col("_f._row").alias("_row"), F.lit(True).alias("_first")))
        out = rows.join(first, "_row", "left")
        known = F.lit(False)
        if before and before["watermark"]:
            since = before["watermark_day"]
            old = table.rows(before, lambda name: name.startswith("kept/") and name[5:] >= since)
            if old is not None:
                seen = old.where(F.coalesce(ts >= mark - wait, F.lit(True))).select(*ids).distinct().withColumn("_known", F.lit(True))
                out = out.join(seen, ids, "left")
                known = F.coalesce("_known", F.lit(False))
        named = reduce(and_, [F.col(c).isNotNull() for c in ids])
        outcome = F.when(F.col("_late"), "late").when(named & (known | F.col("_first").isNull()), "replay").otherwise("kept")
        day = F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("none"))  # 'none' sorts behind all days
        table.write(out.select(*batch.columns, outcome.alias("_outcome"), day.alias("_day")), batch_id, "_outcome", "_day")
        done = spark.read.parquet(table.folder(batch_id)) if batch_has_files(table, batch_id) else None
        folders = {k: list(v) for k, v in before["folders"].items()} if before else {}
        counts = {"kept": 0, "replay": 0, "late": 0}
        if done is not None:
            for r in done.groupBy("_outcome", F.col("_day").cast("string").alias("_day")).count().collect():  # a row a day
                counts[r._outcome] += r["count"]
                folders.setdefault(f"{r._outcome}/{r._day}", []).append(f"batch={batch_id}/_outcome={r._outcome}/_day={r._day}")
        top = rows.agg(F.max(ts).alias("t")).select(F.greatest(F.col("t") - wait, mark).alias("m")).select(
            F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.date_format(F.col("m") - wait, "yyyy-MM-dd")).first()
        table.commit(batch_id, folders, batch.schema, watermark=top[0], watermark_day=top[1], read=sum(counts.values()), **counts)

    return handle


def batch_has_files(table: ManifestTable, batch: int) -> bool:
    """Whether a batch wrote any partition folder (an empty one writes none)."""
    folder = table._path(table.folder(batch))
    return table._fs.exists(folder) and any(s.isDirectory() for s in table._fs.listStatus(folder))


def side(table: ManifestTable, name: str, manifest: dict | None = None) -> DataFrame | None:
    """Rows of one side (kept, replay, late) of a split stream."""
    return table.rows(manifest or table.latest(), lambda n: n.startswith(name + "/"))
