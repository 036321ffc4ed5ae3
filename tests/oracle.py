"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        # toPandas turns nullable ints into floats; compare integral values as ints
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "rows": len(spdf), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    dpdf = con.execute(sql).fetchdf()
    if sorted(spdf.columns) != sorted(dpdf.columns):
        res["status"] = f"COLUMNS spark={sorted(spdf.columns)} duck={sorted(dpdf.columns)}"
        return res
    if len(spdf) != len(dpdf):
        res["status"] = f"ROWCOUNT spark={len(spdf)} duck={len(dpdf)}"
        return res
    a, b = rows_of(spdf), rows_of(dpdf)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES first diffs: {diff}"
        return res
    res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from vitalis.session import get_spark
    from vitalis.plans.registry import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark(shuffle_partitions=8)
    qs, sq = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, sf_dir, name, qs[name], sq.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print('RESULT', r, flush=True)
    print(f"RESULT failures: {bad} of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
