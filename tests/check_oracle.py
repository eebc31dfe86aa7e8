"""Run registered queries against DuckDB from the command line.

    python tests/check_oracle.py [folder] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as registry  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    link = connect(folder)
    oracle = registry.oracle_sql()
    failed = 0
    for name, query in registry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            frame = query(spark, folder)
            if name in oracle:
                problem = difference(frame, link, oracle[name])
            else:
                problem = None
                print("  rows only:", frame.count())
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
