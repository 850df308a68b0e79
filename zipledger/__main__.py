"""Command line: ``python -m zipledger export ...`` and ``python -m zipledger cleanup ...``.

The options mirror the original tool's flags; the ledger is a Parquet table.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from . import constants as C


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="zipledger")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("export", help="export the ledger's pending items into ZIP archives")
    e.add_argument("--job-id", required=True)
    e.add_argument("--ledger", required=True, help="ledger table path (Parquet)")
    body = e.add_mutually_exclusive_group(required=True)
    body.add_argument("--api-key-env", help="name of the environment variable holding the API key")
    body.add_argument("--content", help="content table path (Parquet: archive_id, content)")
    e.add_argument("--output-dir", default="./storage")
    e.add_argument("--workers", type=int, default=C.DEFAULT_WORKERS)
    e.add_argument("--zip-slots", type=int, default=0)
    e.add_argument("--max-zip-size-mb", type=int, default=C.DEFAULT_MAX_ZIP_MB)
    e.add_argument("--batch-size", type=int, default=C.DEFAULT_BATCH_SIZE)
    e.add_argument("--flush-batch", type=int, default=C.DEFAULT_FLUSH_BATCH)
    e.add_argument("--archive-base-url", default="")
    e.add_argument("--log-dir", default=None, help="audit log directory")
    c = sub.add_parser("cleanup", help="delete old archives and ledger copies")
    c.add_argument("--storage-dir", default="./storage")
    c.add_argument("--max-age-days", type=int, default=C.DEFAULT_MAX_AGE_DAYS)
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--protect", nargs="*", default=[], help="job directories never removed")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"zipledger-{args.cmd}").getOrCreate()
    if args.cmd == "export":
        from .plans.export import run_export
        from .schema import ExportConfig
        from .sources.fetch import http_fetcher_factory
        from .sources.manifest import read_manifest
        ledger = read_manifest(spark, args.ledger)
        cfg = ExportConfig(job_id=args.job_id, workers=args.workers, zip_slots=args.zip_slots,
                           max_zip_mb=args.max_zip_size_mb, batch_size=args.batch_size,
                           flush_batch=args.flush_batch, archive_base_url=args.archive_base_url)
        kw = {"content": spark.read.parquet(args.content)} if args.content else \
            {"fetcher_factory": http_fetcher_factory(os.environ[args.api_key_env])}
        res = run_export(spark, ledger, cfg, args.output_dir, audit_dir=args.log_dir, **kw)
        print(json.dumps(res.report.first().asDict(), default=str))
    else:
        from .plans.retention import run_retention
        from .schema import RetentionConfig
        res = run_retention(spark, args.storage_dir, RetentionConfig(max_age_days=args.max_age_days,
                                                                     dry_run=args.dry_run,
                                                                     protect=tuple(args.protect)))
        print(json.dumps(res.summary.first().asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
