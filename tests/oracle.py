"""Run registered queries and their SQL side by side: `python -m tests.oracle [folder] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

from tidegate.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.10g}")
    if isinstance(value, int):
        return value
    return value


def _kind(name: str) -> str:
    name = name.lower()
    if name in ("bigint", "int", "integer", "smallint", "long"):
        return "int"
    if name in ("string", "varchar"):
        return "text"
    return name


def compare(spark, folder: str, run, sql: str | None, con) -> tuple[bool, str]:
    df = run(spark, folder)
    columns = sorted(df.columns)
    got = [tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    result = con.sql(sql)
    wanted_columns = sorted(result.columns)
    if columns != wanted_columns:
        return False, f"columns {columns} <> {wanted_columns}"
    spark_kinds = [_kind(df.schema[c].dataType.simpleString()) for c in columns]
    duck = dict(zip(result.columns, [str(t) for t in result.types]))
    duck_kinds = [_kind(duck[c]) for c in columns]
    names = ", ".join(f'"{c}"' for c in columns)
    wanted = [tuple(_plain(v) for v in row) for row in con.sql(f"SELECT {names} FROM ({sql}) q").fetchall()]
    a, b = Counter(got), Counter(wanted)
    if a != b:
        return False, f"{len(got)} vs {len(wanted)} rows; only spark {list((a - b))[:2]} only sql {list((b - a))[:2]}"
    if spark_kinds != duck_kinds:
        return False, f"types {dict(zip(columns, zip(spark_kinds, duck_kinds)))}"
    return True, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or sorted(queries):
        started = time.time()
        try:
            ok, note = compare(spark, folder, queries[name], sql.get(name), con)
        except Exception as problem:
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:32s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
