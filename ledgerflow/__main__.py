"""Command line: run the pipeline, show a report.

    python -m ledgerflow run    --store DIR --sf-dir DIR [--landing DIR] [--jdbc-url URL]
    python -m ledgerflow report --store DIR NAME [--limit N | --out PATH]
    python -m ledgerflow list

``run`` loads every active registry table (relational tables from the
driver's parquet mapping, or over JDBC with ``--jdbc-url``; file feeds from
``--landing``/<source_path> CSV folders) and rebuilds the gold marts.
``report`` runs one report or widget query over the stored marts and prints
all its rows as CSV (the first N with ``--limit``), or writes them as CSV files.
"""

from __future__ import annotations

import argparse
import csv
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--store", required=True)
    r.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    r.add_argument("--landing", default=None)
    r.add_argument("--jdbc-url", default=None)
    r.add_argument("--master", default="local[8]")
    q = sub.add_parser("report")
    q.add_argument("--store", required=True)
    q.add_argument("name")
    q.add_argument("--limit", type=int)
    q.add_argument("--out")
    q.add_argument("--master", default="local[8]")
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from .plans import reports

    if args.cmd == "list":
        print("\n".join(sorted(reports.REPORTS)))
        return 0

    from .plans.pipeline import Pipeline
    from .session import build_session, checkpoint_dir
    from .sources.store import TableStore

    spark = build_session(master=args.master)
    checkpoint_dir(spark, shared=f"{args.store}/_checkpoints")
    store = TableStore(spark, args.store)
    if args.cmd == "run":
        from .sources import testdata
        from .streaming.csv_feed import csv_stream

        if args.jdbc_url:
            from .sources.jdbc import jdbc_extractor

            relational = jdbc_extractor(spark, args.jdbc_url)
        else:
            ents = testdata.silver_tables(spark, args.sf_dir)

            def relational(cfg):
                return ents[cfg.table_name]

        extractors = {"oracledb": relational, "sqlserver": relational}
        if args.landing:
            extractors["blob"] = lambda cfg: csv_stream(spark, f"{args.landing}/{cfg.source_path}")
        else:
            ents = testdata.silver_tables(spark, args.sf_dir)
            extractors["blob"] = lambda cfg: ents[cfg.table_name]
        run_id = Pipeline(spark, store, extractors).run()
        print(f"run {run_id} complete")
        return 0

    fn, _reads = reports.REPORTS[args.name]
    marts = Pipeline(spark, store, {}).marts()
    found = fn(marts)
    if args.out:
        found.write.option("header", True).csv(args.out)
        return 0
    if args.limit is not None:
        found = found.limit(args.limit)
    out = csv.writer(sys.stdout)
    out.writerow(found.columns)
    out.writerows(found.toLocalIterator())  # a partition at a time
    return 0


if __name__ == "__main__":
    sys.exit(main())
