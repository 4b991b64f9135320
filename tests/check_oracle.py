"""Run registered queries beside their SQL: python tests/check_oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


FAMILIES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {df.columns} / {columns}"
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    wrong = {n: (t, kinds[n]) for n, t in df.dtypes if FAMILIES.get(t) != kinds[n]}
    if wrong:
        return False, f"types {wrong}"
    mine, theirs = rows_of(df.columns, [tuple(r) for r in got]), rows_of(columns, expected)
    if mine != theirs:
        extra, missing = [r for r in mine if r not in set(theirs)][:3], [r for r in theirs if r not in set(mine)][:3]
        return False, f"{len(mine)} / {len(theirs)} rows; only here {extra}; only SQL {missing}"
    return True, f"{len(mine)} rows, {took:.1f}s"


def main() -> None:
    from cellmart.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, entry.queries()[name], sqls.get(name), sf_dir)
        except Exception as error:  # show and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "BAD ", name, note, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    spark.stop()


if __name__ == "__main__":
    main()
