"""Run or inspect a registered query.

    python -m tarmac list
    python -m tarmac delay_by_airline /root/testdata/sf0.01 [--rows 20] [--explain] [--sql]
    python -m tarmac delay_by_airline /data/sf --save /data/results/by_airline [--format csv]

The scratch tables of the run are deleted at its end.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tarmac")
    ap.add_argument("query", help="query name, or 'list'")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    ap.add_argument("--sql", action="store_true", help="print the oracle SQL instead of running")
    ap.add_argument("--save", metavar="FOLDER", help="write the result there instead of showing rows (overwrites)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "json"])
    args = ap.parse_args(argv)

    from tarmac.plans.catalog import ORACLE, QUERIES
    if args.query == "list":
        for name in QUERIES:
            print(f"{name:30s} {'oracle' if name in ORACLE else 'rows-only'}")
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; try 'list'", file=sys.stderr)
        return 2
    if args.sql:
        print(ORACLE.get(args.query, "-- no oracle SQL (rows-only query)"))
        return 0

    from tarmac.session import local_session
    spark = local_session()
    from tarmac.sources.flights import save_table
    from tarmac.sources.store import release_tables
    try:
        df = QUERIES[args.query](spark, args.sf_dir)
        if args.explain:
            df.explain("formatted")
        if args.save:
            save_table(df, args.save, fmt=args.format)
        else:
            df.show(args.rows, truncate=False)
    finally:
        release_tables(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
