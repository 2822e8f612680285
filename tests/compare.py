"""Run registered queries against their SQL twins in DuckDB.

``python -m tests.compare 0.01 [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tidemill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


# Spark type -> DuckDB type of a result column.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, con, sql) -> str | None:
    left = {c: TYPES.get(t, t) for c, t in df.dtypes}
    right = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return None if left == right else f"types {left} vs {right}"


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def spark_result(df):
    return table_of(df.columns, df.collect())


def sql_result(con, sql):
    cur = con.execute(sql)
    return table_of([c[0] for c in cur.description], cur.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"values {a!r} vs {b!r}"[:600]
    return None


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{argv[0]}"
    spark, con = session(), oracle(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        try:
            df = fn(spark, folder)
            left = spark_result(df)
            took = time.time() - began
            if name not in sqls:
                note = "no sql"
            else:
                note = type_difference(df, con, sqls[name]) or difference(left, sql_result(con, sqls[name]))
        except Exception as error:  # noqa: BLE001
            took, note, left = time.time() - began, f"{type(error).__name__}: {error}"[:1500], ([], [])
        bad += note not in (None, "no sql")
        print(f"{'ok' if note in (None, 'no sql') else 'BAD'} {name} rows={len(left[1])} {took:.2f}s {note or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
