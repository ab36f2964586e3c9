"""Run a registered query on Spark and its SQL on DuckDB, and compare types and values."""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def make_session(cores: int = 8, partitions: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("etlkit-tests")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(path: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    return str(t)


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def rows_of(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(str(cell(v)) for v in row) for row in zip(*columns)) if columns else Counter()


def compare(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    problems = []
    a = {f.name: kind(f.type) for f in spark_table.schema}
    b = {f.name: kind(f.type) for f in sql_table.schema}
    if a != b:
        problems.append(f"schema: spark-only {sorted(set(a.items()) - set(b.items()))} sql-only {sorted(set(b.items()) - set(a.items()))}")
    if spark_table.num_rows != sql_table.num_rows:
        problems.append(f"rows: {spark_table.num_rows} vs {sql_table.num_rows}")
    if set(a) == set(b):
        x, y = rows_of(spark_table), rows_of(sql_table)
        if x != y:
            problems.append(f"values: spark-only {list((x - y).items())[:3]} sql-only {list((y - x).items())[:3]}")
    return problems


def check(spark, con, path: str, name: str):
    """(problems, rows, seconds) of one query; without SQL only that it runs."""
    from etlkit.plans.catalogue import ORACLES, QUERIES

    start = time.time()
    result = QUERIES[name](spark, path).toArrow()
    seconds = time.time() - start
    if name not in ORACLES:
        return [], result.num_rows, seconds
    return compare(result, con.sql(ORACLES[name]).to_arrow_table()), result.num_rows, seconds


if __name__ == "__main__":
    from etlkit.plans.catalogue import ORACLES, QUERIES

    path = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    wanted = [q for q in QUERIES if any(q == w or (w.endswith("*") and q.startswith(w[:-1])) for w in wanted)] if sys.argv[2:] else wanted
    import os

    session, db, bad = make_session(partitions=int(os.environ.get("PARTITIONS", "8"))), connect(path), 0
    for name in wanted:
        try:
            problems, rows, seconds = check(session, db, path, name)
        except Exception as error:  # noqa: BLE001
            problems, rows, seconds = [f"{type(error).__name__}: {str(error)[:900]}"], -1, 0.0
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name:32s} rows={rows:8d} {seconds:6.2f}s {'' if name in ORACLES else '(rows only)'}", flush=True)
        for p in problems:
            print("      ", p[:1500], flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
