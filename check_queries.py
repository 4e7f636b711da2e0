"""Run registered queries next to their SQL: ``python check_queries.py [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

from arealis.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
            return ("f", float(v))
        if isinstance(v, bool):
            return ("b", v)
        if isinstance(v, int):
            return ("i", v)
        return (type(v).__name__, v)

    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr
    )


def main(names: list[str]) -> int:
    import workbench

    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    failed = []
    for name in names or list(workbench.QUERIES):
        start = time.time()
        try:
            df = workbench.QUERIES[name](spark, sf)
            mine = normalised(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            sql = workbench.ORACLES.get(name)
            if sql is None:
                print(f"rows  {name} {len(mine[1])} {took:.2f}s")
                continue
            cur = con.execute(sql)
            theirs = normalised([d[0] for d in cur.description], cur.fetchall())
            if mine == theirs and mine[1]:
                print(f"ok    {name} {len(mine[1])} {took:.2f}s")
                continue
            failed.append(name)
            print(f"DIFF  {name} {mine[0]} {theirs[0]} rows {len(mine[1])} {len(theirs[1])}")
            only = [r for r in mine[1] if r not in theirs[1]][:2]
            other = [r for r in theirs[1] if r not in mine[1]][:2]
            print("   mine  ", str(only)[:1200])
            print("   theirs", str(other)[:1200])
        except Exception as e:
            failed.append(name)
            print(f"ERROR {name}: {type(e).__name__} {str(e)[:700]}")
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
