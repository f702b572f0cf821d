"""Writers, the medallion job and the stream sink's replay safety."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from given_data import SF_SMALL
from shoplens.plans import medallion
from shoplens.sources import sinks
from shoplens.streaming import tables


def test_medallion_job_matches_registry(spark, tmp_path):
    out = medallion.run(spark, SF_SMALL, str(tmp_path))
    assert out["silver"]["orders_enriched"] == E.queries()["silver_orders_commerce"](spark, SF_SMALL).count()
    gold = spark.read.parquet(str(tmp_path / "gold" / "executive_kpis"))
    ref = E.queries()["gd21_executive_kpis"](spark, SF_SMALL)
    assert gold.select("total_orders", "total_gross_revenue").collect() == \
        ref.select("total_orders", "total_gross_revenue").collect()
    parts = os.listdir(tmp_path / "silver" / "sessions_enriched")
    assert any(p.startswith("session_year=") for p in parts)


def test_writers(spark, tmp_path):
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    assert sinks.write_table(df, str(tmp_path / "t")) == 10
    assert sinks.append_rows(df.limit(2), str(tmp_path / "t")) == 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 12
    sinks.write_table(sinks.add_columns(df, {"extra": F.lit("x")}), str(tmp_path / "t"), mode="append")
    ev = sinks.read_evolving(spark, str(tmp_path / "t"))
    assert "extra" in ev.columns and ev.filter("extra IS NULL").count() == 12
    spark.range(5).createOrReplaceTempView("src5")
    t = sinks.ctas(spark, "sq", "WITH a AS (SELECT id * id AS sq FROM src5) SELECT * FROM a", str(tmp_path / "c"))
    assert sorted(r.sq for r in spark.table("sq").collect()) == [0, 1, 4, 9, 16] and t.count() == 5
    assert sinks.clustered_write(df, str(tmp_path / "z"), ["g", "id"], partitions=3) == 10


def _files(folder):
    return sorted((os.path.join(d, n), os.path.getmtime(os.path.join(d, n)))
                  for d, _, names in os.walk(folder) for n in names)


def test_stream_sink_writes_touched_partitions_only(spark, tmp_path):
    base = str(tmp_path / "tbl")
    h = tables.upsert_into(base, ["k"], F.col("k") % 3)
    h(spark.createDataFrame([(1, "a"), (2, "b"), (3, "x")], "k long, v string"), 0)
    table = tables.ManifestTable(spark, base)
    before, files = table.latest(), _files(base + "/data")
    h(spark.createDataFrame([(2, "c"), (5, "d")], "k long, v string"), 1)
    after = table.latest()
    assert after["touched"] == ["2"]
    assert {p: after["folders"][p] for p in ("0", "1")} == {p: before["folders"][p] for p in ("0", "1")}
    assert after["folders"]["2"] != before["folders"]["2"]
    assert set(files) <= set(_files(base + "/data"))  # nothing written before has changed
    assert not any("/batch=1/_partition=0" in f or "/batch=1/_partition=1" in f for f, _ in _files(base + "/data"))
    want = [(1, "a"), (2, "c"), (3, "x"), (5, "d")]
    assert sorted(map(tuple, table.rows(after).collect())) == want
    assert sorted(map(tuple, table.rows(before).collect())) == [(1, "a"), (2, "b"), (3, "x")]  # a reader's view stays


def test_stream_sink_replay_is_idempotent(spark, tmp_path):
    base = str(tmp_path / "tbl")
    h = tables.upsert_into(base, ["k"], F.col("k") % 2)
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b1 = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    h(b0, 0)
    # a batch that failed before its manifest: its folders are written anew
    spark.createDataFrame([(9, "half")], "k long, v string").write.parquet(base + "/data/batch=1/_partition=0")
    table = tables.ManifestTable(spark, base)
    assert sorted(map(tuple, table.rows(table.latest()).collect())) == [(1, "a"), (2, "b")]
    h(b1, 1)
    first, manifest = sorted(table.rows(table.latest()).collect()), table.latest()
    h(b1, 1)                                   # replay of a batch that was committed
    assert table.latest() == manifest
    assert first == sorted(table.rows(table.latest()).collect())
    assert [tuple(r) for r in first] == [(1, "a"), (2, "c"), (3, "d")]


def test_stream_sink_keeps_the_newer_row(spark, tmp_path):
    base = str(tmp_path / "tbl")
    h = tables.upsert_into(base, ["k"], F.col("k"), update_col="t")
    h(spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k long, t long, v string"), 0)
    h(spark.createDataFrame([(1, 6, "old"), (2, 2, "new"), (None, 1, "n")], "k long, t long, v string"), 1)
    h(spark.createDataFrame([], "k long, t long, v string"), 2)
    table = tables.ManifestTable(spark, base)
    assert sorted(map(tuple, table.rows(table.latest()).collect()), key=repr) == [(1, 7, "b"), (2, 2, "new"), (None, 1, "n")]
    assert table.batches() == [0, 1, 2] and table.latest()["touched"] == []
