"""Local stand-in for the driver's Spark-vs-DuckDB comparison."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def frame_rows(df: pd.DataFrame, digits):
    cols = sorted(df.columns)
    rows = []
    for r in df[cols].itertuples(index=False):
        rows.append(tuple(_norm(x if not (isinstance(x, float) and math.isnan(x)) else None, digits)
                          for x in r))
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    try:
        rows.sort(key=key)
    except TypeError:
        rows.sort(key=lambda t: repr(t))
    return cols, rows


SPARK_FAMILY = {"bigint": "int", "double": "float", "string": "str", "boolean": "bool",
                "timestamp_ntz": "ts"}
DUCK_FAMILY = {"BIGINT": "int", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool",
               "TIMESTAMP": "ts"}


def type_diff(spark_df, sql: str, con) -> dict:
    """Columns whose type family differs between the engines."""
    s = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    d = {r[0]: DUCK_FAMILY.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}


def compare(spark_df, sql: str, con) -> dict:
    tdiff = type_diff(spark_df, sql, con)
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    res = {"rows_spark": len(s), "rows_oracle": len(d), "types_match": not tdiff}
    if tdiff:
        res["type_diff"] = tdiff
    sc, dc = sorted(s.columns), sorted(d.columns)
    res["columns_match"] = sc == dc
    if sc != dc:
        res["only_spark"] = sorted(set(sc) - set(dc))
        res["only_oracle"] = sorted(set(dc) - set(sc))
        return res
    s = s.astype(object).where(pd.notna(s), None)
    d = d.astype(object).where(pd.notna(d), None)
    _, rs = frame_rows(s, None)
    _, rd = frame_rows(d, None)
    res["exact"] = rs == rd
    if not res["exact"]:
        _, rs9 = frame_rows(s, 9)
        _, rd9 = frame_rows(d, 9)
        res["approx9"] = rs9 == rd9
        if not res["approx9"]:
            for a, b in zip(rs9, rd9):
                if a != b:
                    res["first_diff"] = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y][:6]
                    break
    return res
