"""Command line: run the incremental sensor job, or look at a table.

    python -m tidepool pipeline --source DIR --root DIR [--start-over] [--cluster]
                                [--max-files-per-trigger N] [--timestamp-format FMT]
    python -m tidepool history --table DIR
    python -m tidepool detail  --table DIR

With ``spark-submit`` the session (master, memory, ``spark.checkpoint.dir``)
comes from the launcher; nothing here overrides it.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidepool")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("pipeline", help="raw CSV → bronze → silver, new files only")
    p.add_argument("--source", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--start-over", action="store_true",
                   help="reset checkpoints and both tables together, then replay")
    p.add_argument("--cluster", action="store_true",
                   help="finish with ZORDER BY (MeasurementDateTime): rewrites silver")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--timestamp-format")
    for name in ("history", "detail"):
        q = sub.add_parser(name)
        q.add_argument("--table", required=True)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tidepool").getOrCreate()
    from tidepool.session import ensure_checkpoint_dir
    from tidepool.sources.table import ParquetTable
    ensure_checkpoint_dir(spark)
    if args.command == "pipeline":
        from tidepool.streaming.pipeline import run_sensor_pipeline
        silver = run_sensor_pipeline(spark, args.source, args.root,
                                     start_over=args.start_over, cluster=args.cluster,
                                     max_files_per_trigger=args.max_files_per_trigger,
                                     timestamp_format=args.timestamp_format)
        print(json.dumps({"silver": silver.root, "version": silver.version(),
                          "rows": silver.read().count()}))
    elif args.command == "history":
        for r in ParquetTable.open(spark, args.table).history().collect():
            print(json.dumps(r.asDict()))
    else:
        print(json.dumps(ParquetTable.open(spark, args.table).detail()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
