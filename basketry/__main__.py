"""Command line: ``python -m basketry all --data-dir raw --out out --as-of 2024-06-30``.

The steps can also run one by one on the same --out folder.
"""

from __future__ import annotations

import argparse

from .plans import bronze, daily_job
from .session import build_session
from .sources.staging import drop_staged
from .sources.tables import publish


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="basketry", description=__doc__)
    parser.add_argument("step", choices=["all", "load", "build", "dq", "rfm", "clusters", "cohorts", "reports", "publish"])
    parser.add_argument("--data-dir", default="data/raw", help="folder of the raw CSV files")
    parser.add_argument("--out", default="data", help="folder for tables/ and outputs/")
    parser.add_argument("--as-of", help="reporting date, today by default")
    parser.add_argument("--mode", choices=["snapshot", "upsert"], default="snapshot", help="how marts treat rows of earlier runs")
    parser.add_argument("--truncate", action="store_true", help="replace the raw tables instead of adding to them")
    parser.add_argument("--database", default="retail", help="catalog database for publish")
    parser.add_argument("--master", help="Spark master, the environment's by default")
    args = parser.parse_args(arguments)
    spark = build_session(args.master)
    root, exports = f"{args.out}/tables", f"{args.out}/outputs"
    steps = {
        "all": lambda: daily_job.run_all(spark, args.data_dir, args.out, args.as_of, args.mode, args.truncate),
        "load": lambda: bronze.load_raw(spark, args.data_dir, root, args.truncate),
        "build": lambda: daily_job.build_marts(spark, root, args.as_of, args.mode),
        "dq": lambda: daily_job.quality(spark, root).show(100, truncate=False),
        "rfm": lambda: daily_job.score_customers(spark, root, exports),
        "clusters": lambda: daily_job.group_customers(spark, root, exports),
        "cohorts": lambda: daily_job.follow_cohorts(spark, root, exports),
        "reports": lambda: daily_job.reports(spark, root, exports),
        "publish": lambda: publish(spark, root, args.database),
    }
    try:
        steps[args.step]()
    finally:
        drop_staged(spark)


if __name__ == "__main__":
    main()
