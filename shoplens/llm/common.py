"""Helpers shared by the text operators: code shipping, written intermediates."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application, so that
    functions used inside tasks import on machines that have no checkout."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.basename(package)
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{top}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(top, os.path.relpath(full, package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and fixes generated row ids."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def work_columns(df: DataFrame, **roles: str | None) -> dict[str, str]:
    """For each role a column name that ``df`` doesn't have, so that columns an
    operator adds never clash with the caller's own (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for role in roles:
        name = f"_{role}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out[role] = name
    return out
