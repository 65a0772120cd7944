"""Run registered queries next to their SQL twins: python tests/check_sql.py FOLDER [NAME ...]"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = [p for p in ("region nation customer supplier part orders lineitem events documents embeddings pages "
                      "benchmark labels conversations").split()]
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def sql_rows(folder: str, sql: str):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cursor = c.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    return names, kinds, cursor.fetchall()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=repr)


def difference(spark_df, folder: str, sql: str) -> str | None:
    """None when names, types and values agree, else what differs."""
    names, kinds, rows = sql_rows(folder, sql)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    spark_kinds = {n: KINDS.get(t, t) for n, t in spark_df.dtypes}
    wrong = {n: (spark_kinds[n], k) for n, k in zip(names, kinds) if spark_kinds[n] != k}
    if wrong:
        return f"types {wrong}"
    ours, theirs = ordered(spark_df.columns, spark_df.collect()), ordered(names, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from stayflow.session import session

    spark = session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder, only = sys.argv[1], sys.argv[2:]
    oracle = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            result = difference(df, folder, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {type(e).__name__} {str(e)[:600]}"
        verdict = "ok" if result is None else result
        failed += verdict != "ok" and not verdict.startswith("rows only")
        print(f"{name:32s} {time.time() - began:7.2f}s  {verdict[:900]}", flush=True)
    print("failed", failed)
