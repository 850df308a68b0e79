"""Job report and audit events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import base_name, format_size, portal_link


def is_zip_name(path: Column | str = "path") -> Column:
    """Archive-size rule: the file name ends in .zip, any letter case."""
    return F.lower(base_name(path)).endswith(C.ARCHIVE_NAME_SUFFIX)


def total_archive_size(inventory: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Sum of sizes of ``*.zip`` files (any case, any depth), per group if given."""
    z = inventory.where(is_zip_name("path") & ~F.coalesce(F.col("is_dir"), F.lit(False))) \
        if "is_dir" in inventory.columns else inventory.where(is_zip_name("path"))
    agg = F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("zip_bytes")
    return z.groupBy(*group_cols).agg(agg) if group_cols else z.agg(agg)


def job_report(ledger: DataFrame, inventory: DataFrame, job: str, job_prefix: str, base_url: str) -> DataFrame:
    """One row: job, total, completed, failed, pending, archive bytes and text,
    portal link, and whether failures need attention.

    Ledger counts and archive bytes come from one aggregate over a union of the
    two inputs (no join between them)."""
    s = F.col("export_status")
    led = ledger.select(F.lit(1).alias("_src"), s.alias("_status"), F.lit(None).cast("long").alias("_len"))
    inside = F.col("path").startswith(job_prefix.rstrip("/") + "/")
    files = inventory.where(inside & is_zip_name("path")).select(
        F.lit(2).alias("_src"), F.lit(None).cast("string").alias("_status"), F.col("length").cast("long").alias("_len"))
    src = F.col("_src")
    agg = led.unionByName(files).agg(
        F.count_if(src == 1).alias("total"),
        F.count_if((src == 1) & (F.col("_status") == C.COMPLETED)).alias("completed"),
        F.count_if((src == 1) & (F.col("_status") == C.FAILED)).alias("failed"),
        F.coalesce(F.sum(F.when(src == 2, F.col("_len"))), F.lit(0)).cast("long").alias("zip_bytes"),
    )
    return agg.select(
        F.lit(job).alias("job"), "total", "completed", "failed",
        (F.col("total") - F.col("completed") - F.col("failed")).alias("pending"),
        "zip_bytes", format_size("zip_bytes").alias("zip_size"),
        portal_link(F.lit(base_url), F.lit(job)).alias("link"),
        (F.col("failed") > 0).alias("has_failures"),
    )


AUDIT_COLUMNS = ["channel", "event", "archive_id", "detail"]


def audit_events(failures: DataFrame | None = None, archived: DataFrame | None = None,
                 general: DataFrame | None = None) -> DataFrame:
    """Audit rows routed to channels: per-record failures to ``errors``, archived
    records to ``process``, job-level events to ``general``."""
    parts = []
    if failures is not None:
        parts.append(failures.select(F.lit(C.CHANNEL_ERRORS).alias("channel"),
                                     F.when(F.col("error_log").startswith("Parse"), "parse_failed")
                                     .otherwise("fetch_failed").alias("event"),
                                     "archive_id", F.col("error_log").alias("detail")))
    if archived is not None:
        extra = ["progress"] if "progress" in archived.columns else []
        parts.append(archived.select(F.lit(C.CHANNEL_PROCESS).alias("channel"), F.lit("archived").alias("event"),
                                     "archive_id", F.col("archive_path").alias("detail"), *extra))
    if general is not None:
        parts.append(general.select(F.lit(C.CHANNEL_GENERAL).alias("channel"), "event",
                                    F.lit(None).cast("string").alias("archive_id"), "detail"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
