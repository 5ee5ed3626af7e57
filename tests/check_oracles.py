"""Compare every registered query with its SQL oracle: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

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


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime64"):
            frame[column] = frame[column].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), kind="stable", ignore_index=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if the two hold the same rows, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    try:
        pd.testing.assert_frame_equal(
            canonical(spark_frame), canonical(sql_frame), check_dtype=False, check_exact=True
        )
    except AssertionError as error:
        return str(error)[:600]
    return None


def main() -> int:
    import __spark_entry__ as contract
    from sensorstream.session import session_builder

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        session_builder("oracles")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        got = query(spark, sf_dir).toPandas()
        took = time.time() - begun
        if name not in oracles:  # checked by tests instead
            print(f"{name:28s} {len(got):8d} rows {took:6.2f}s  no SQL", flush=True)
            continue
        problem = differences(got, con.sql(oracles[name]).df())
        failed += problem is not None
        print(f"{name:28s} {len(got):8d} rows {took:6.2f}s  {problem or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
