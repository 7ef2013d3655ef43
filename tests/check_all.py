"""Run every query against its SQL twin: ``python -m tests.check_all <sf_dir> [names]``."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from tests.compare import assert_same, connect
from tests.conftest import make_session


def main(sf_dir: str, names: list[str]) -> int:
    spark = make_session()
    con, sql = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            rows = assert_same(df, con, sql[name]) if name in sql else df.count()
            outcome = f"ok {rows} rows" if name in sql else f"no SQL, {rows} rows"
        except Exception as error:  # report and go on with the next
            failed += 1
            outcome = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {time.time() - started:6.2f}s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
