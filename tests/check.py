"""Compare every named query with its SQL counterpart on DuckDB.

Usage: python tests/check.py SF_DIR [QUERY ...]
"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, pd.Timestamp):
            v = v.to_pydatetime()
        return "NULL" if v is None else repr(v)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    rel = con.sql(sql)
    names, expected = rel.columns, rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    want = canonical(expected, names)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return f"{len(different)} of {len(got)} rows differ, e.g. {different[0]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries), set(sqls) - set(queries)
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sqls:
                result = compare(df, con, sqls[name])
            else:
                result = None if df.collect() else "no rows"
        except Exception as error:  # keep going, report at the end
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if result is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s "
              f"{result or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
