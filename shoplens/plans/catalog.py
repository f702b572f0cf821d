"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL).

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the whole
driver tables. Output columns are normalised (integers -> BIGINT,
decimals/floats -> DOUBLE, DATE -> 'yyyy-MM-dd' text) so both engines agree on
types and on how values are rendered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle_ctes import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ORACLE_BODY: dict[str, str] = {}


def normalise_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    """Decorator: register a builder and (optionally) its oracle SQL body;
    CTEs referenced by the body are prepended automatically."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalise_types(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
            ORACLE_BODY[name] = sql
        return fn

    return deco
