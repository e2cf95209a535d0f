"""Run registered queries beside their SQL statements and compare values: ``python -m registry.check DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.10g}")
    return value


def key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(record[i]) for i in order) for record in records), key=key)


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(root).glob("*.parquet")):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


def compare(spark, con, root, name, run, sql):
    """One line of outcome for one query."""
    start = time.time()
    df = run(spark, root)
    got = [tuple(row) for row in df.collect()]
    spent = time.time() - start
    if sql is None:
        return f"ROWS  {name}: {len(got)} rows, {spent:.1f}s", True
    start = time.time()
    relation = con.sql(sql)
    expected = relation.fetchall()
    other = time.time() - start
    if sorted(df.columns) != sorted(relation.columns):
        return f"FAIL  {name}: columns {sorted(df.columns)} against {sorted(relation.columns)}", False
    left, right = rows_of(got, df.columns), rows_of(expected, relation.columns)
    if left == right:
        return f"ok    {name}: {len(left)} rows, {spent:.1f}s against {other:.1f}s", True
    names = sorted(df.columns)
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    detail = "".join(f"\n   spark {dict(zip(names, r))}" for r in only_left)
    detail += "".join(f"\n   sql   {dict(zip(names, r))}" for r in only_right)
    return f"FAIL  {name}: {len(left)} rows against {len(right)}{detail}", False


def main() -> int:
    from registry import ORACLE, QUERIES
    from shelfweek.session import get_session

    root, names = sys.argv[1], sys.argv[2:]
    spark = get_session("check", "local[8]", spark__ui__enabled="false", spark__driver__memory="12g",
                        spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    bad = []
    for name in names or QUERIES:
        try:
            line, good = compare(spark, con, root, name, QUERIES[name], ORACLE.get(name))
        except Exception as error:
            line, good = f"ERROR {name}: {str(error)[:700]}", False
        print(line, flush=True)
        if not good:
            bad.append(name)
    print(f"{len(bad)} bad: {' '.join(bad)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
