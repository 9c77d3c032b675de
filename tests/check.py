"""python -m tests.check [--sf 0.01] [name ...]: compare queries with their SQL and time them."""

from __future__ import annotations

import argparse
import sys
import time
import traceback

from tests.compare import compare, connect
from tidemark.queries.registry import ORACLE, QUERIES, load_all
from tidemark.session import session


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--explain", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    load_all()
    spark = session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    names = [n for n in QUERIES if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if args.explain:
                df.explain()
            if name in ORACLE:
                ok, note = compare(df, ORACLE[name], con)
            else:
                ok, note = True, f"{df.count()} rows, no SQL"
        except Exception:
            ok, note = False, traceback.format_exc(limit=4)[-1800:]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.2f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
