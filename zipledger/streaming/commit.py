"""Streaming status commits as merge-on-read: a ledger base plus an update log.

Each micro-batch appends only its own update rows to ``<log>/batch_id=<b>``
(overwriting just that directory, so a replayed batch is idempotent); the
ledger is never rewritten per batch. The current ledger is the base snapshot
with the winning update per id applied (one aggregate + one join), and
``compact`` folds the log into a new base version now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_timestamp
from ..operators.ledger import apply_updates, completion_updates
from ..schema import UPDATES
from ..sinks import fs as fsx
from ..sinks.ledger import committed_versions, folded_batch, read_ledger_snapshot, write_ledger_snapshot

LOG_SCHEMA = "archive_id string, export_status string, error_log string, seq long, updated_at timestamp_ntz"


def commit_completions(spark: SparkSession, completions: DataFrame, log_root: str, checkpoint: str,
                       now=None, available_now: bool = True, timeout_seconds: float | None = None) -> StreamingQuery:
    """``completions`` (a stream with ``archive_id``) -> COMPLETED rows in the update log.

    Within the log, later batches win (``seq`` = batch id); each row carries
    its commit time as ``updated_at``."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        ups = completion_updates(batch.select("archive_id"), seq=F.lit(batch_id)) \
            .withColumn("updated_at", as_timestamp(now))
        ups.write.mode("overwrite").parquet(fsx.join(log_root, f"batch_id={batch_id}"))

    w = completions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(commit)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        if q.awaitTermination(timeout_seconds) is False:
            q.stop()
            raise TimeoutError(f"the stream did not finish in {timeout_seconds} seconds")
        if q.exception():
            raise q.exception()
    return q


def _log_batches(log_root: str) -> list[int]:
    return sorted(int(n.split("=", 1)[1]) for n in fsx.list_dir(log_root, files=False, dirs=True)
                  if n.startswith("batch_id="))


def read_update_log(spark: SparkSession, log_root: str, after_batch: int = -1,
                    last_batch: int | None = None) -> DataFrame:
    batches = [b for b in _log_batches(log_root) if b > after_batch and (last_batch is None or b <= last_batch)]
    if not batches:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(*[fsx.join(log_root, f"batch_id={b}") for b in batches])


def current_ledger(spark: SparkSession, ledger_root: str, log_root: str) -> DataFrame:
    """Base snapshot + every logged batch not yet folded into it."""
    base_version, folded = _base(ledger_root)
    base = read_ledger_snapshot(spark, ledger_root, base_version)
    return apply_updates(base, read_update_log(spark, log_root, folded))


def _base(ledger_root: str) -> tuple[int, int]:
    version = committed_versions(ledger_root)[-1]
    return version, folded_batch(ledger_root, version)


def compact(spark: SparkSession, ledger_root: str, log_root: str) -> int:
    """Fold the update log into a new base version; returns the new version. The commit marker
    names the last folded batch, and later batches are not read, so none is applied twice or lost."""
    base_version, folded = _base(ledger_root)
    last = max([folded, *_log_batches(log_root)])
    new = apply_updates(read_ledger_snapshot(spark, ledger_root, base_version),
                        read_update_log(spark, log_root, folded, last))
    return write_ledger_snapshot(new, ledger_root, folded=last)


__all__ = ["commit_completions", "current_ledger", "compact", "read_update_log", "UPDATES"]
