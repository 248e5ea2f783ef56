"""Run a Spark query and its DuckDB oracle on the same parquet tables and
compare row count, column names and the multiset of rows (order-insensitive,
columns sorted by name) -- the same shape of check the driver records."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


_DUCK_OF_SPARK = {
    "IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "FloatType()": "FLOAT",
    "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP",
    "ShortType()": "SMALLINT", "ByteType()": "TINYINT", "ArrayType(StringType(), True)": "VARCHAR[]",
    "ArrayType(StringType(), False)": "VARCHAR[]",
    "ArrayType(DoubleType(), True)": "DOUBLE[]", "ArrayType(DoubleType(), False)": "DOUBLE[]",
}


def type_mismatches(spark_df, con, sql: str) -> list:
    """Columns whose Spark type does not map to the DuckDB result type."""
    d_types = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in spark_df.schema.fields:
        want = _DUCK_OF_SPARK.get(repr(f.dataType), repr(f.dataType))
        if f.name in d_types and d_types[f.name] != want:
            out.append((f.name, repr(f.dataType), d_types[f.name]))
    return out


def compare(spark_df, con, sql: str, show: int = 5) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    try:
        tm = type_mismatches(spark_df, con, sql)
    except Exception as e:  # DESCRIBE of a complex statement
        tm = [f"describe failed: {str(e)[:80]}"]
    if tm:
        out["type_mismatches"] = tm
    if not out["columns_match"]:
        out["spark_columns"] = sorted(s_cols)
        out["oracle_columns"] = sorted(d_cols)
        out["match"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = a == b
    if not out["match"]:
        out["only_spark"] = list((a - b).elements())[:show]
        out["only_oracle"] = list((b - a).elements())[:show]
        out["columns"] = sorted(s_cols)
    return out
