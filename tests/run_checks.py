"""Run registered queries against their SQL: python tests/run_checks.py FOLDER [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                problem = differences(df, con, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        checked = "" if name in sql else " (rows only)"
        print(f"{time.time() - start:6.1f}s {name}{checked}: {problem or 'ok'}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
