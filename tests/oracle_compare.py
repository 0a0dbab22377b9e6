"""Compare a Spark result with the result of the same question in DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return (2, "nan")
        return (3, f"{float(v) + 0.0:.6f}")
    return (4, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} vs {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first: {[x[1] for x in wrong[0][0]]} vs {[x[1] for x in wrong[0][1]]}")
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for n, t in spark_types.items():
        if duck_types.get(n) != same.get(t, t):
            out.append(f"type of {n}: {t} vs {duck_types.get(n)}")
    return out


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = e.oracle_sql()
    bad = 0
    for name, q in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q(spark, sf_dir)
            found = differences(df, con, oracle[name]) if name in oracle else [] if df.collect() is not None else []
            note = "ok" if not found else "; ".join(found)
            if name not in oracle:
                note += " (rows only)"
        except Exception as ex:  # report every query
            found, note = ["error"], f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += bool(found)
        print(f"{name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
