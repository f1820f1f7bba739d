"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


TIMES: dict[str, float] = {}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both results agree, else a short account of how they differ."""
    start = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    TIMES[name] = time.time() - start
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    expected = found.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(columns)}"
    left, right = bag(df.columns, rows), bag(columns, expected)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{name}: {len(rows)} rows, expected {len(expected)}; "
        f"only Spark {str(next(iter(only_left), None))[:600]}; only SQL {str(next(iter(only_right), None))[:600]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from newsloom import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            if sql is None:
                print(f"{name}: rows only, {query(spark, sf_dir).count()} rows, {time.time() - start:.1f}s", flush=True)
                continue
            problem = difference(spark, con, name, query, sql, sf_dir)
            n = "" if problem else f"{con.execute(f'SELECT count(*) FROM ({sql})').fetchone()[0]} rows"
            print(problem or f"{name}: ok {n} spark {TIMES[name]:.1f}s all {time.time() - start:.1f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{name}: FAILED {str(error)[:1500]}", flush=True)


if __name__ == "__main__":
    main()
