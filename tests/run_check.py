"""Run every query (or those named) beside its SQL: python tests/run_check.py [folder] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowsmith.plans.registry import all_queries, all_sql  # noqa: E402
from rowsmith.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), all_sql(), 0
    for name, build in all_queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sql:
                built = time.time() - start
                problems = compare(df, con, sql[name])
            else:
                built = time.time() - start
                problems = []
                print("   ", [r.asDict() for r in df.limit(12).collect()])
        except Exception as error:  # report and go on with the next query
            built, problems = 0.0, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else "ok" if name in sql else "rows"
        print(f"{mark:4} {name} {time.time() - start:.1f}s (build {built:.1f}s) {' | '.join(problems)}", flush=True)
    print(f"{failed} failed")
