"""Spark-vs-DuckDB comparison used by the tests and by ``tools/check_oracle.py``.

Rows are compared order-insensitively after normalising values to text, the
way a value hash would see them.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def rows_hash(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


DUCK_TO_SPARK = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
                 "TIMESTAMP": "timestamp_ntz", "DECIMAL(38,9)": "decimal(38,9)", "DOUBLE": "double"}


def compare(df, con, sql: str) -> dict:
    s_cols = df.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    s_n, s_h = rows_hash(s_cols, s_rows)
    d_n, d_h = rows_hash(d_cols, d_rows)
    out = {"rows_spark": s_n, "rows_oracle": d_n, "columns_match": sorted(s_cols) == sorted(d_cols),
           "types_match": s_types == d_types, "hash_match": s_h == d_h}
    if not out["hash_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ss = {"\x1f".join(_norm(r[i]) for i in order_s) for r in s_rows}
        dd = {"\x1f".join(_norm(r[i]) for i in order_d) for r in d_rows}
        out["only_spark"] = sorted(ss - dd)[:3]
        out["only_oracle"] = sorted(dd - ss)[:3]
        out["columns"] = sorted(s_cols)
        out["oracle_columns"] = sorted(d_cols)
    return out
