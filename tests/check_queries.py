"""Command line: compare registered queries with their SQL.

    python tests/check_queries.py [--sf DIR] [names or prefixes...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from oracle import compare, connect  # noqa: E402

from delaykit.plans import CATALOG  # noqa: E402
from delaykit.session import local_session  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--types", action="store_true")
    args = ap.parse_args()
    spark, con = local_session(8), connect(args.sf)
    bad = 0
    for name, entry in CATALOG.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = entry.run(spark, args.sf)
            if entry.sql is None:
                verdict = f"rows only: {df.count()}"
            else:
                verdict = compare(df, con, entry.sql) or "ok"
                if verdict == "ok" and args.types:
                    types = dict((d[0], str(d[1])) for d in con.execute(entry.sql).description)
                    verdict += f" {[(c, t, types[c]) for c, t in df.dtypes]}"
        except Exception as e:  # noqa: BLE001 - the tool reports whatever failed
            verdict = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        good = verdict.startswith(("ok", "rows only"))
        bad += not good
        print(f"{'  ' if good else '! '}{name:34s} {time.time() - start:6.2f}s {verdict}", flush=True)
        spark.catalog.clearCache()
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
