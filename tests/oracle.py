"""Runs every registered query beside its SQL twin and compares the results."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(plain, key=repr)


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    want_cols, want = _rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; got {got[:2]} want {want[:2]}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"row {a} != {b}"
    if any(t.startswith(("array", "map", "struct")) for _, t in spark_df.dtypes):
        return "nested output column"
    return ""


def main(folder: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from corpusgate.session import get_session

    spark = get_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                tag = "ok"
            else:
                problem, tag = "", f"rows-only {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        bad += bool(problem)
        print(f"{'BAD ' + problem if problem else tag} {name} {time.time() - t0:.1f}s", flush=True)
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
