"""Continuous export: new ledger files are exported as they arrive.

A file stream of ledger rows; every micro-batch is staged once (a
``foreachBatch`` input may be recomputed) and exported with ``run_export``.
Archive numbering resumes from the archives already in the job directory, and
each batch commits the ledger of its own rows to ``<ledger>/batch_id=<b>/``,
so a replayed batch overwrites exactly its own output. The stream's ledger is
the union of the committed batch directories (``read_stream_ledger``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.report import job_report
from ..schema import LEDGER, ExportConfig
from ..session import qualified, staging_path
from ..sinks import fs as fsx
from ..sinks.ledger import committed_versions
from ..sinks.zip_source import ZipArchives
from ..sources.inventory import list_any
from .manifest_stream import stream_manifest


def run_export_stream(spark: SparkSession, source: str, cfg: ExportConfig, out_dir: str, checkpoint: str, *,
                      content: DataFrame | None = None, fetcher_factory=None, now=None,
                      max_files_per_trigger: int = 1, available_now: bool = True,
                      timeout_seconds: float | None = None, audit_dir: str | None = None) -> StreamingQuery:
    from ..plans.export import run_export

    out_dir = qualified(spark, out_dir)
    ledger_dir = os.path.join(out_dir, cfg.job_id, "ledger-stream")

    def export_batch(batch: DataFrame, batch_id: int) -> None:
        if committed_versions(os.path.join(ledger_dir, f"batch_id={batch_id}")):
            return  # replayed after its ledger was committed: already exported
        staged = staging_path(spark, f"stream-batch-{batch_id}")
        batch.write.parquet(staged)
        run_export(spark, spark.read.schema(LEDGER).parquet(staged), cfg, out_dir, content=content,
                   fetcher_factory=fetcher_factory, now=now,
                   ledger_root=os.path.join(ledger_dir, f"batch_id={batch_id}"),
                   audit_dir=audit_dir, audit_run=f"{cfg.job_id}-batch-{batch_id}")

    # a stream runs in a copy of the session made at its start, and Spark looks formats up in that copy
    spark.dataSource.register(ZipArchives)
    rows = stream_manifest(spark, source, LEDGER, max_files_per_trigger)
    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(export_batch)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
    if available_now:
        if q.awaitTermination(timeout_seconds) is False:
            q.stop()
            raise TimeoutError(f"the stream did not finish in {timeout_seconds} seconds")
        if q.exception():
            raise q.exception()
    return q


def read_stream_ledger(spark: SparkSession, out_dir: str, job_id: str) -> DataFrame:
    """Union of the committed per-batch ledgers of a continuous export."""
    d = fsx.join(qualified(spark, out_dir), job_id, "ledger-stream")
    roots = [fsx.join(d, n) for n in fsx.list_dir(d, files=False, dirs=True) if n.startswith("batch_id=")]
    paths = [fsx.join(r, f"version={done[-1]}") for r in roots if (done := committed_versions(r))]
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)


def stream_report(spark: SparkSession, out_dir: str, cfg: ExportConfig) -> DataFrame:
    """The one-row job report of a continuous export: its committed ledgers and its archives so far."""
    job_dir = fsx.join(qualified(spark, out_dir), cfg.job_id)
    return job_report(read_stream_ledger(spark, out_dir, cfg.job_id), list_any(spark, job_dir), cfg.job_id,
                      job_dir, cfg.archive_base_url)
