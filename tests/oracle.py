"""Compare a registered query with its SQL in DuckDB: columns, types, rows.

As a script: ``python -m tests.oracle [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def session() -> SparkSession:
    return (SparkSession.builder.master("local[8]").appName("checks")
            .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
            .config("spark.ui.showConsoleProgress", "false").getOrCreate())


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    names = sorted(df.columns)
    out = con.execute(sql)
    types = {d[0]: str(d[1]) for d in out.description}
    if sorted(types) != names:
        return f"columns {names} and {sorted(types)}"
    mine = {n: TYPES.get(t, t) for n, t in df.dtypes}
    wrong = {n: (mine[n], types[n]) for n in names if mine[n] != types[n]}
    at = [[d[0] for d in out.description].index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in at) for row in out.fetchall())
    ours = Counter(tuple(row) for row in df.select(*names).collect())
    if ours != theirs:
        return (f"rows {sum(ours.values())} and {sum(theirs.values())}; only Spark {list((ours - theirs).items())[:3]}"
                f"; only SQL {list((theirs - ours).items())[:3]}")
    return f"types {wrong}" if wrong else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as E
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = session(), database(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, fn in E.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            sql = E.oracle_sql().get(name)
            if sql is None:
                rows = df.collect()
                problem, note = (None if rows else "no rows"), f"rows only: {len(rows)} {str(rows[:1])[:160]}"
            else:
                problem, note = difference(df, con, sql), ""
        except Exception as error:  # a report over all queries; each failure is one line
            problem, note = f"{type(error).__name__}: {str(error)[:600].splitlines()[0]}", ""
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {note}{problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
