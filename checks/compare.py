"""Compare every query with its SQL: python -m checks.compare [folder] [names...]"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES, tuned


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def value(cell):
    if isinstance(cell, float):
        return "nan" if math.isnan(cell) else repr(cell)
    if isinstance(cell, datetime.datetime):
        return cell.isoformat()
    return cell


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    result = tuned(QUERIES[name])(spark, sf_dir)
    rows = result.collect()
    seconds = time.time() - start
    found = connection.execute(ORACLE[name])
    names = [column[0] for column in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(result.columns):
        return False, f"columns {sorted(result.columns)} != {sorted(names)}"
    ours, theirs = bag(rows, result.columns), bag(expected, names)
    if ours == theirs:
        return True, f"{len(rows)} rows, {seconds:.1f} s"
    extra, missing = ours - theirs, theirs - ours
    sample = f"only ours {list(extra)[:2]} only SQL {list(missing)[:2]}"
    return False, f"{len(rows)}/{len(expected)} rows, {sum(extra.values())} differ: {sample}"[:1500]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            same, note = compare(spark, connection, sf_dir, name)
        except Exception as error:
            same, note = False, f"{type(error).__name__}: {str(error)[:1200]}"
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
