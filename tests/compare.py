"""Run registered queries against DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value

    return Counter(tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, build, sql: str) -> str | None:
    """None when both engines return the same columns and the same multiset of typed rows."""
    df = build(spark, sf_dir)
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} vs {sorted(result.columns)}"
    ours = bag(df.columns, [tuple(row) for row in df.collect()])
    theirs = bag(result.columns, result.fetchall())
    if ours == theirs:
        return None
    extra, lacking = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; +{extra} -{lacking}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract
    from stratalake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", extra={"spark.sql.shuffle.partitions": "8",
                                      "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, build in contract.queries().items():
        if argv[1:] and not any(part in name for part in argv[1:]):
            continue
        begun = time.time()
        try:
            if name in oracles:
                outcome = differences(spark, con, sf_dir, build, oracles[name])
            else:
                outcome = f"rows only: {build(spark, sf_dir).count()}"
        except Exception as error:
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad = outcome is not None and not outcome.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {time.time() - begun:6.2f}s {name} {outcome or ''}",
              flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
