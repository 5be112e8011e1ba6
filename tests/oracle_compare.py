"""Local stand-in for the driver's correctness gate.

Runs ``queries()[name]`` on Spark and ``oracle_sql()[name]`` on DuckDB over
the same parquet tables and compares row count, column names and an
order-insensitive value hash.  Usage::

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)  # pandas turns whole numbers with nulls into floats
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, pd.Timestamp):
        return str(v.date()) if v == v.normalize() else str(v)
    return v if isinstance(v, (int, str, bool)) else str(v)


def frame_hash(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def _spark_class(t: str) -> str:
    t = t.lower()
    for k, v in (("bigint", "int64"), ("long", "int64"), ("int", "int32"), ("smallint", "int16"), ("double", "float64"),
                 ("float", "float32"), ("decimal", "decimal"), ("string", "str"), ("boolean", "bool"),
                 ("timestamp", "timestamp"), ("date", "date"), ("array", "list")):
        if t.startswith(k):
            return v
    return t


def _duck_class(t: str) -> str:
    t = t.upper()
    for k, v in (("BIGINT", "int64"), ("HUGEINT", "int128"), ("INTEGER", "int32"), ("SMALLINT", "int16"),
                 ("DOUBLE", "float64"), ("FLOAT", "float32"), ("DECIMAL", "decimal"), ("VARCHAR", "str"),
                 ("BOOLEAN", "bool"), ("TIMESTAMP", "timestamp"), ("DATE", "date")):
        if t.startswith(k):
            return v
    return "list" if t.endswith("[]") else t.lower()


def type_mismatches(spark_schema, rel) -> dict:
    """Column type classes that differ between the Spark schema and the DuckDB result."""
    duck_types = {d[0]: _duck_class(str(d[1])) for d in rel.description}
    out = {}
    for f in spark_schema.fields:
        s = _spark_class(f.dataType.simpleString())
        d = duck_types.get(f.name)
        if d is not None and d != s:
            out[f.name] = (s, d)
    return out


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # pragma: no cover - reporting only
            results[name] = ("spark-error", str(e)[:500])
            print(name, "SPARK ERROR", str(e)[:800])
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = ("rows-only", len(sdf))
            if verbose:
                print(f"{name}: rows-only {len(sdf)} rows ({ts:.1f}s)")
            continue
        try:
            ddf = con.execute(sql[name]).df()
        except Exception as e:
            results[name] = ("sql-error", str(e)[:500])
            print(name, "SQL ERROR", str(e)[:800])
            continue
        a, b = frame_hash(sdf), frame_hash(ddf)
        types = type_mismatches(qs[name](spark, sf_dir).schema, con.execute(sql[name]))
        ok = a == b and not types
        if types and verbose:
            print(f"   type mismatches: {types}")
        results[name] = ("ok" if ok else "MISMATCH", a[0], b[0])
        if verbose:
            print(f"{name}: {'ok' if ok else 'MISMATCH'} spark={a[0]} rows {a[1]} duck={b[0]} rows {b[1]} ({ts:.1f}s)")
            if not ok:
                _diff(sdf, ddf)
    return results


def _diff(sdf: pd.DataFrame, ddf: pd.DataFrame, k: int = 5) -> None:
    cols = sorted(set(sdf.columns) & set(ddf.columns))
    sa = {repr(tuple(_norm(r[c]) for c in cols)) for r in sdf.to_dict("records")}
    sb = {repr(tuple(_norm(r[c]) for c in cols)) for r in ddf.to_dict("records")}
    print("   cols:", cols)
    print("   spark-only:", sorted(sa - sb)[:k])
    print("   duck-only: ", sorted(sb - sa)[:k])


if __name__ == "__main__":
    from hirelens.session import build_session, checkpoint_dir
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, app_name="oracle-compare")
    checkpoint_dir(spark)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("SUMMARY", len(res), "queries,", len(bad), "not ok:", bad)
