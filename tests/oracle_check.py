"""Run registered queries against their DuckDB twins and compare.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
Compares column names, row counts and values (order-insensitive; doubles
with a relative tolerance of 1e-9), and prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if not isinstance(v, (list, tuple, dict)) and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int,)):
        return v
    if isinstance(v, float):
        return v
    if hasattr(v, "isoformat"):
        return str(v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    return v


def _key(row):
    out = []
    for v in row:
        if v is None:
            out.append((0, ""))
        elif isinstance(v, float):
            out.append((1, float(f"{v:.9g}")))
        elif isinstance(v, int):
            out.append((1, v))
        else:
            out.append((2, str(v)))
    return tuple((k, v if k == 1 else 0, v if k == 2 else "") for k, v in out)


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        if a == b:
            return True
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
          "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(spark_df, con, sql):
    """Columns whose Spark type and DuckDB type differ."""
    st = dict(spark_df.dtypes)
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(c, st[c], dt.get(c)) for c in st if _TYPES.get(st[c], st[c]) != dt.get(c)]


def compare(sdf, ddf):
    scols, dcols = sorted(sdf.columns), sorted(ddf.columns)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(sdf) != len(ddf):
        return False, f"rows differ: spark={len(sdf)} duck={len(ddf)}"
    srows = sorted((tuple(_norm(v) for v in r) for r in sdf[scols].itertuples(index=False)), key=_key)
    drows = sorted((tuple(_norm(v) for v in r) for r in ddf[dcols].itertuples(index=False)), key=_key)
    bad = 0
    first = None
    for a, b in zip(srows, drows):
        if not all(_close(x, y) for x, y in zip(a, b)):
            bad += 1
            if first is None:
                first = (a, b)
    if bad:
        return False, f"{bad} rows differ; first: spark={first[0]} duck={first[1]}"
    return True, f"{len(sdf)} rows"


def run(sf_dir, prefixes=()):
    import __spark_entry__ as E
    from vigil.session import get_session, checkpoint_dir
    spark = get_session("local[8]", shuffle_partitions=8, app="oracle-check")
    checkpoint_dir(spark)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    results = {}
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"spark error: {str(e)[:300]}")
            print(f"FAIL {name}: {results[name][1]}", flush=True)
            continue
        if name not in sqls:
            results[name] = (True, f"{len(sdf)} rows (no oracle)")
            print(f"ROWS {name}: {len(sdf)} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"duck error: {str(e)[:300]}")
            print(f"FAIL {name}: {results[name][1]}", flush=True)
            continue
        ok, msg = compare(sdf, ddf)
        results[name] = (ok, msg)
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} ({time.time() - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:])
    n_ok = sum(1 for ok, _ in res.values() if ok)
    print(f"{n_ok}/{len(res)} ok")
