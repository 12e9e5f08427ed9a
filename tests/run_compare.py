"""Compare all (or the named) queries with their oracle: ``run_compare.py FOLDER [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from footfall.session import build  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, bad = connect(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            rows, problem = difference(run(spark, folder), connection, oracle[name])
        except Exception as error:  # report and go on with the next query
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} rows={rows:7d} {time.time() - began:6.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
