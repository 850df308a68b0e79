"""Ledger state operators. Each returns a new ledger version; nothing is updated in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import as_timestamp, failure_reason, is_eligible, parse_location
from ..schema import CLAIM_COLUMNS, LEDGER_COLUMNS
from .ordering import with_global_rank

CLAIM_ORDER = ("archive_time", "archive_id")


def claim_order() -> list[Column]:
    # The original claims with LIMIT and no ORDER BY; a total order makes runs repeatable.
    return [F.col("archive_time").asc_nulls_first(), F.col("archive_id").asc()]


def eligible(ledger: DataFrame) -> DataFrame:
    """Rows still to export, projected to the four columns a claim needs."""
    return ledger.where(is_eligible("export_status")).select(*CLAIM_COLUMNS)


def reset_stale(ledger: DataFrame, now=None) -> DataFrame:
    """PROCESSING rows left by an interrupted run go back to PENDING (updated_at = now)."""
    stale = F.col("export_status") == C.PROCESSING
    ts = as_timestamp(now)
    return ledger.select(*[
        F.when(stale, F.lit(C.PENDING)).otherwise(F.col(c)).alias(c) if c == "export_status" else
        F.when(stale, ts).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c)
        for c in ledger.columns
    ])


def progress_stats(ledger: DataFrame) -> DataFrame:
    """(completed, failed, total) in one pass."""
    s = F.col("export_status")
    return ledger.agg(
        F.count_if(s == C.COMPLETED).alias("completed"),
        F.count_if(s == C.FAILED).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def claim_batches(ledger: DataFrame, batch_size: int = C.DEFAULT_BATCH_SIZE,
                  num_partitions: int | None = None) -> DataFrame:
    """Every eligible row with its claim position and batch: batch ``b`` holds positions
    ``b*N+1 .. (b+1)*N`` of the claim order. Equivalent to claiming N rows at a time."""
    ranked = with_global_rank(eligible(ledger), claim_order(), "claim_seq", num_partitions=num_partitions)
    return ranked.withColumn("batch_id", F.floor((F.col("claim_seq") - 1) / F.lit(batch_size)).cast("long"))


def claim_first_batch(ledger: DataFrame, batch_size: int = C.DEFAULT_BATCH_SIZE) -> DataFrame:
    """The next claim: the first N eligible rows in claim order (a per-partition top-N)."""
    return eligible(ledger).orderBy(*claim_order()).limit(batch_size)


def mark_claimed(ledger: DataFrame, claimed: DataFrame, now=None) -> DataFrame:
    """Ledger after a claim: claimed ids become PROCESSING."""
    ups = claimed.select("archive_id", F.lit(C.PROCESSING).alias("export_status"),
                         F.lit(None).cast("string").alias("error_log"), F.lit(0).cast("long").alias("seq"))
    return apply_updates(ledger, ups, now=now, keep_error=True)


def split_valid(claimed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows with a ``loc`` struct, parse rejects as FAILED update rows)."""
    parsed = claimed.withColumn("loc", parse_location("archive_location"))
    valid = parsed.where(F.col("loc.valid"))
    rejects = parsed.where(~F.col("loc.valid")).select(
        "archive_id",
        F.lit(C.FAILED).alias("export_status"),
        failure_reason(F.lit("parse")).alias("error_log"),
    )
    return valid, rejects


def completion_updates(ids: DataFrame, seq: Column | None = None) -> DataFrame:
    """COMPLETED with the error cleared."""
    return ids.select("archive_id", F.lit(C.COMPLETED).alias("export_status"),
                      F.lit(None).cast("string").alias("error_log"),
                      (seq if seq is not None else F.lit(0)).cast("long").alias("seq"))


def failure_updates(rows: DataFrame, reason: Column | str = "error_log", seq: Column | None = None,
                    status: Column | str | None = None) -> DataFrame:
    """FAILED (or any given status) with a reason."""
    r = F.col(reason) if isinstance(reason, str) else reason
    s = F.lit(C.FAILED) if status is None else (F.lit(status) if isinstance(status, str) else status)
    return rows.select("archive_id", s.alias("export_status"), r.cast("string").alias("error_log"),
                       (seq if seq is not None else F.lit(0)).cast("long").alias("seq"))


def latest_updates(updates: DataFrame) -> DataFrame:
    """One winning update per id: highest seq (ties broken by status, then error text).

    max(struct) is a partial aggregate, so a hot id is combined map-side. An
    ``updated_at`` column on the updates (their commit time) travels along."""
    fields = [F.col("seq"), F.col("export_status"), F.col("error_log")]
    if "updated_at" in updates.columns:
        fields.append(F.col("updated_at"))
    return updates.groupBy("archive_id").agg(F.max(F.struct(*fields)).alias("_u"))


def apply_updates(ledger: DataFrame, updates: DataFrame, now=None, keep_error: bool = False) -> DataFrame:
    """Keyed UPDATE: ids not in the ledger are ignored, rows are never inserted.

    A left join on archive_id; the winning update replaces status and error (a
    NULL error overwrites), and updated_at becomes ``now``."""
    u = latest_updates(updates)
    hit = F.col("_u").isNotNull()
    ts = F.col("_u.updated_at") if "updated_at" in updates.columns else as_timestamp(now)
    cols = []
    for c in ledger.columns:
        if c == "export_status":
            cols.append(F.when(hit, F.col("_u.export_status")).otherwise(F.col(c)).alias(c))
        elif c == "error_log" and not keep_error:
            cols.append(F.when(hit, F.col("_u.error_log")).otherwise(F.col(c)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(hit, ts).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return ledger.join(u, "archive_id", "left").select(*cols)


__all__ = ["eligible", "reset_stale", "progress_stats", "claim_batches", "claim_first_batch", "mark_claimed",
           "split_valid", "completion_updates", "failure_updates", "latest_updates", "apply_updates",
           "claim_order", "LEDGER_COLUMNS"]
