"""Compare registered queries with their SQL twins: python tests/check_oracle.py [sf] [name...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "asDict"):
        return tuple(cell(x) for x in v)
    if isinstance(v, dict):
        return tuple(cell(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    if hasattr(v, "tolist"):
        return cell(v.tolist())
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf_dir)
    rows = df.collect()
    columns = sorted(df.columns)
    got = [tuple(cell(r[c]) for c in columns) for r in rows]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want_rows = res.fetchall()
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = [tuple(cell(r[i]) for i in at) for r in want_rows]
    key = lambda r: tuple((x is None, str(type(x).__name__ in ("int", "float")), x if isinstance(x, (int, float)) else 0, str(x)) for x in r)
    got.sort(key=key)
    want.sort(key=key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {columns}: {bad[0]}"
    types = [type(x).__name__ for x in (got[0] if got else [])], [type(x).__name__ for x in (want[0] if want else [])]
    if types[0] != types[1]:
        return f"types differ {columns} {types}"
    return None


def main():
    import importlib

    from conftest import make_session

    entry = importlib.import_module("__spark_entry__")
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    wanted = args[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed, start = [], time.time()
    for name, fn in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, name, fn, sql[name], sf_dir)
            else:
                rows = fn(spark, sf_dir).count()
                problem = None if rows >= 0 else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed {failed}; {len(queries)} queries, {len(sql)} with SQL; {time.time() - start:.0f}s")


if __name__ == "__main__":
    main()
