"""Script: compare registered queries with their SQL. Usage: run_compare.py SF_DIR [NAME...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402
from corpuslink.session import local_session  # noqa: E402
from tests.compare import differences, duck  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8, 8)
    con = duck(sf_dir)
    sqls = entry_module.oracle_sql()
    for name, query in entry_module.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                verdict = differences(df, con, sqls[name]) or "ok"
                verdict += f" rows={df.count()}"
            else:
                verdict = f"rows={df.count()} (no SQL)"
        except Exception as error:  # report and go on
            verdict = f"ERROR {str(error)[:1500]}"
        print(f"{name}: {verdict} [{time.time() - began:.1f}s]", flush=True)


if __name__ == "__main__":
    main()
