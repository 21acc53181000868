"""Command line: list, show or publish a registered report.

    python -m closetops --list
    python -m closetops q_ageing_bins /root/testdata/sf0.01 --show 20
    python -m closetops q_unit_usage /root/testdata/sf0.1 --out /shared/reports/unit_usage --partition-by order_type
"""

from __future__ import annotations

import argparse
import sys

from .registry import QUERIES


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="closetops")
    ap.add_argument("query", nargs="?")
    ap.add_argument("sf_dir", nargs="?")
    ap.add_argument("--list", action="store_true", help="list registered queries")
    ap.add_argument("--show", type=int, default=0, help="print the first N rows")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    ap.add_argument("--out", help="publish the result to this path (parquet, overwrite)")
    ap.add_argument("--partition-by", nargs="*", default=None)
    a = ap.parse_args(argv)
    if a.list or not a.query:
        print("\n".join(sorted(QUERIES)))
        return 0
    if a.query not in QUERIES or not a.sf_dir:
        ap.error("give a registered query name and a data directory")
    from pyspark.sql import SparkSession

    from .session import build_session
    spark = SparkSession.getActiveSession() or build_session()
    df = QUERIES[a.query](spark, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    if a.out:
        from .sources.sinks import publish
        publish(df, path=a.out, partition_by=a.partition_by)
    if a.show:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
