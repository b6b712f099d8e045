"""Command line: the operational steps of the pipeline.

  python -m vatio.cli load      --landing ROOT --table generacion_real --date 2026-05-19 --raw RAW
  python -m vatio.cli stream    --landing ROOT --table generacion_real --raw RAW --checkpoint CK
  python -m vatio.cli run       --raw RAW --out OUT [--start S --end E] [--schema NAME]   (or --testdata SF_DIR)
  python -m vatio.cli test      --models OUT
  python -m vatio.cli files     --landing ROOT --source cen --date 2026-05-19
  python -m vatio.cli count     --raw RAW --table generacion_real --date 2026-05-19
  python -m vatio.cli metrics   --models OUT --metric generacion_sistema_total --grain month [--by ...]

``run`` and ``test`` end with status 1 if a data test fails (a warning is no failure).
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from .session import get_session


def _verdict(results) -> int:
    """Exit status of a set of test results: 1 if one of them failed."""
    counts = {r["status"]: r["count"] for r in results.groupBy("status").count().collect()}
    print(", ".join(f"{s}: {counts[s]}" for s in sorted(counts)))
    return int(counts.get("fail", 0) > 0)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="vatio")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("--landing", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--date", required=True)
    a.add_argument("--raw", required=True)
    a = sub.add_parser("stream")
    a.add_argument("--landing", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--raw", required=True)
    a.add_argument("--checkpoint", required=True)
    a = sub.add_parser("run")
    a.add_argument("--raw")
    a.add_argument("--testdata")
    a.add_argument("--out", required=True)
    a.add_argument("--start")
    a.add_argument("--end")
    a.add_argument("--schema", help="register the written tables under this schema of the catalog")
    a = sub.add_parser("test")
    a.add_argument("--models", required=True)
    a = sub.add_parser("files")
    a.add_argument("--landing", required=True)
    a.add_argument("--source", default="cen")
    a.add_argument("--date", required=True)
    a = sub.add_parser("count")
    a.add_argument("--raw", required=True)
    a.add_argument("--table", default="generacion_real")
    a.add_argument("--date", required=True)
    a = sub.add_parser("metrics")
    a.add_argument("--models", required=True)
    a.add_argument("--metric", action="append", required=True)
    a.add_argument("--grain")
    a.add_argument("--by", action="append", default=[])
    p.add_argument("--master")
    args = p.parse_args(argv)
    spark = get_session(args.master)

    if args.cmd == "load":
        from .sources.landing import load_landing
        out = load_landing(spark, args.landing, args.table, args.date, f"{args.raw.rstrip('/')}/{args.table}")
        print(f"{args.table}: {out.count()} rows in table")
    elif args.cmd == "stream":
        from .streaming import stream_landing
        stream_landing(spark, args.landing, args.table, f"{args.raw.rstrip('/')}/{args.table}",
                       args.checkpoint).awaitTermination()
    elif args.cmd == "run":
        from .plans.pipeline import run_pipeline
        if args.testdata:
            from .sources.testdata import raw_tables
            raw = raw_tables(spark, args.testdata)
        else:
            from .sources.stored import StoredRawTables
            now = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
            raw = StoredRawTables(spark, args.raw, args.start, args.end, as_of=now)
        return _verdict(run_pipeline(spark, raw, args.out, schema=args.schema))
    elif args.cmd == "test":
        from .operators.quality import run_checks
        from .plans.pipeline import MODEL_ORDER
        from .plans.tests_declared import CHECKS
        tables = {n: spark.read.parquet(f"{args.models.rstrip('/')}/{n}") for n in MODEL_ORDER}
        results = run_checks(tables, CHECKS).persist()    # one row for each declared test
        results.orderBy("test_id").show(100, truncate=False)
        return _verdict(results)
    elif args.cmd == "files":
        from .sources.landing import inventory
        inventory(spark, args.landing, args.source, args.date).show(truncate=False)
    elif args.cmd == "count":
        from .sources.catalog import SOURCES, day_scan, rows_for_day
        src = SOURCES[args.table]
        df = day_scan(spark, f"{args.raw.rstrip('/')}/{args.table}", src.time_column, args.date)
        rows_for_day(df, src.time_column, args.date).show()
    elif args.cmd == "metrics":
        from .operators.metrics import METRICS, query_metrics
        models = {METRICS[m].model for m in args.metric}
        if any(k.startswith("central__") for k in args.by):  # attributes of the plant entity
            models.add("plants_geo")
        tables = {n: spark.read.parquet(f"{args.models.rstrip('/')}/{n}") for n in models}
        query_metrics(tables, args.metric, args.by, args.grain).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
