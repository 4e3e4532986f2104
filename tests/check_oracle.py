"""Runs registered queries and their oracle SQL side by side and reports what differs.

    python tests/check_oracle.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(v):
    import decimal
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", float(v))
    if isinstance(v, float):
        return ("f", f"{v:.9g}")
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if v is None:
        return ("n", "")
    if isinstance(v, str):
        return ("s", v)
    return (type(v).__name__, str(v))


def connect(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name, fn, sql):
    t0 = time.time()
    df = fn(spark, folder)
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return f"rows {len(rows)}", t1 - t0, 0.0
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLUMNS {sorted(set(names) ^ set(cols))}", t1 - t0, 0
    idx = [names.index(c) for c in cols]
    other = [tuple(norm(r[i]) for i in idx) for r in cur.fetchall()]
    t2 = time.time()
    a, b = sorted(rows), sorted(other)
    if a == b:
        return f"ok {len(a)}", t1 - t0, t2 - t1
    from collections import Counter
    ca, cb = Counter(a), Counter(b)
    only_a, only_b = list((ca - cb).elements()), list((cb - ca).elements())
    out = f"DIFF spark={len(a)} duck={len(b)} only_spark={len(only_a)} only_duck={len(only_b)} cols={cols}"
    for x in sorted(only_a)[:2]:
        out += f"\n      spark {[v for _, v in x]} {[k for k, _ in x]}"
    for x in sorted(only_b)[:2]:
        out += f"\n      duck  {[v for _, v in x]} {[k for k, _ in x]}"
    return out, t1 - t0, t2 - t1


def main(argv):
    import __spark_entry__ as e
    from obolus.session import local_session
    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            res, ts, td = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as ex:  # noqa: BLE001
            res, ts, td = f"ERROR {str(ex)[:1500]}", 0, 0
        bad += not res.startswith(("ok", "rows"))
        print(f"{name:45s} {ts:6.2f}s {td:6.2f}s {res}", flush=True)
    print("bad:", bad, "of", len(qs))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
