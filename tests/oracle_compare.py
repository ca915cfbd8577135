"""Run registered queries and their DuckDB oracles; compare as multisets.

Usable from tests and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(columns)


def compare(spark, sf_dir: str, names=None, con=None, verbose=False) -> dict:
    from tagweave.plans.contract import oracle_sql, queries

    con = con or duck(sf_dir)
    qs, oracle = queries(), oracle_sql()
    report = {}
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        s_rows, s_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
        spark_sec = time.time() - t
        entry = {"spark_rows": len(s_rows), "spark_sec": round(spark_sec, 2)}
        if name in oracle:
            res = con.execute(oracle[name])
            o_cols = [d[0] for d in res.description]
            o_rows, o_cols = rows_of(o_cols, res.fetchall())
            entry.update(
                oracle_rows=len(o_rows),
                columns_match=s_cols == o_cols,
                values_match=Counter(s_rows) == Counter(o_rows),
            )
            if not entry["columns_match"]:
                entry["columns"] = (s_cols, o_cols)
            elif not entry["values_match"]:
                diff_s = Counter(s_rows) - Counter(o_rows)
                diff_o = Counter(o_rows) - Counter(s_rows)
                entry["only_spark"] = list(diff_s)[:3]
                entry["only_oracle"] = list(diff_o)[:3]
        report[name] = entry
        if verbose:
            ok = entry.get("values_match", True) and entry.get("columns_match", True)
            print("OK  " if ok else "FAIL", name, entry, flush=True)
    return report


if __name__ == "__main__":
    from tagweave.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    rep = compare(spark, sf, sys.argv[2:] or None, verbose=True)
    bad = sum(not (v.get("values_match", True) and v.get("columns_match", True)) for v in rep.values())
    print("failures:", bad)
