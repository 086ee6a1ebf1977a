"""Spark query vs DuckDB SQL comparison used by the tests (mirrors the driver's
row-count + column names + order-insensitive value check)."""

import math

import duckdb

from ferrule.sources.tables import TABLES


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x, digits) for x in v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), digits)
    except Exception:
        pass
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def _spark_kind(t):
    n = t.typeName()
    if n in ("byte", "short", "integer", "long"):
        return "int"
    if n in ("float", "double", "decimal"):
        return "float"
    return {"string": "str", "boolean": "bool", "timestamp_ntz": "timestamp"}.get(n, n)


def _duck_kind(t):
    n = str(t).upper()
    if n in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if n in ("FLOAT", "DOUBLE") or n.startswith("DECIMAL"):
        return "float"
    return {"VARCHAR": "str", "BOOLEAN": "bool"}.get(n, n.lower())


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_kinds = {f.name: _spark_kind(f.dataType) for f in spark_df.schema.fields}
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_kinds = {c[0]: _duck_kind(c[1]) for c in res.description}
    d_rows = rows_of(d_cols, res.fetchall())
    problems = []
    kind_diff = {c: (s_kinds[c], d_kinds.get(c)) for c in s_kinds if d_kinds.get(c) not in (None, s_kinds[c])}
    if kind_diff:
        problems.append(f"types differ (spark, duck): {kind_diff}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if not problems and s_rows != d_rows:
        bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems
