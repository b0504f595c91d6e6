"""Run registered queries against their oracles: check.py SF_DIR [name ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from tripflow.session import build_session  # noqa: E402


def main(sf_dir, *names):
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = spark_entry.queries(), spark_entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = differences(df, con, sql[name]) if name in sql else f"(no oracle) {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and not problem.startswith("(no")
        print(f"{'ok ' if not problem else '-- '} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} problems")


main(*sys.argv[1:])
