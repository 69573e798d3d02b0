"""Compare the registered queries with their SQL, as multisets of rows."""

from __future__ import annotations

import collections
import glob
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of_spark(df) -> tuple[list[str], collections.Counter]:
    names = sorted(df.columns)
    return names, collections.Counter(tuple(r) for r in df.select(*names).collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], collections.Counter]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = collections.Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def difference(spark_rows: collections.Counter, sql_rows: collections.Counter) -> list:
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    return [("spark", *only_spark.most_common(2)), ("sql", *only_sql.most_common(2))] if (
        only_spark or only_sql
    ) else []


def main() -> None:
    import __spark_entry__ as e

    from sensorloom.session import telemetry_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:] or list(e.queries())
    spark = telemetry_session(
        "oracle",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), e.oracle_sql()
    for name in chosen:
        start = time.time()
        try:
            names, rows = rows_of_spark(e.queries()[name](spark, sf_dir))
            spent = time.time() - start
            sql_names, sql_rows = rows_of_sql(con, sql[name])
            diff = difference(rows, sql_rows) if names == sql_names else [names, sql_names]
        except Exception as error:  # noqa: BLE001
            print(f"{name:26} ERROR {str(error)[:500]}", flush=True)
            continue
        count = sum(rows.values())
        print(f"{name:26} {'OK  ' if not diff else 'DIFF'} rows={count} {spent:.1f}s", flush=True)
        for line in diff:
            print("    ", str(line)[:700])


if __name__ == "__main__":
    main()
