"""Run every registered query against its DuckDB oracle.

Usage: python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from rosterline.plans import registry  # noqa: E402
from rosterline.session import build_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    if not only:  # the training-data queries have tests of their own
        qs = registry.queries()
    bad = ran = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        ran += 1
        t = time.time()
        df = fn(spark, sf_dir)
        if name in sqls:
            try:
                ok, msg = compare(df, con, sqls[name])
            except Exception as e:  # noqa: BLE001
                ok, msg = False, f"error: {e!r}"[:2000]
        else:
            n = df.count()
            ok, msg = True, f"{n} rows (no oracle)"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{ran - bad}/{ran} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
