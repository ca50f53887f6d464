"""Run a registered query in Spark and its SQL in DuckDB; compare as multisets."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def _rows(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None, digits: int | None = 6):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.execute(oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_match"]:
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
        res["match"] = False
        return res
    a, b = _rows(s_cols, s_rows, digits), _rows(d_cols, d_rows, digits)
    res["match"] = a == b
    res["exact"] = _rows(s_cols, s_rows, None) == _rows(d_cols, d_rows, None)
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_duck"] = [x for x in b if x not in sa][:3]
        res["cols"] = sorted(s_cols)
    return res
