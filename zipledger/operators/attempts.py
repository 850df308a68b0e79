"""Relational form of the fetch retry loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import backoff_seconds, failure_reason


def fold_attempts(attempts: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """One outcome per archive_id from its attempt rows.

    Success is the first attempt (within ``max_attempts``) whose status is
    exactly 200; anything else (204, 404, 5xx, no response) is retried. With
    no success the last attempt decides: a status gives an API failure, no
    status a network failure. All aggregates are partial, so even an id with
    a huge number of rows is combined map-side.
    """
    a = attempts.where((F.col("attempt") >= 1) & (F.col("attempt") <= max_attempts))
    g = a.groupBy("archive_id").agg(
        F.min(F.when(F.col("http_status") == C.HTTP_OK, F.col("attempt"))).alias("_first_ok"),
        F.max("attempt").alias("_last"),
        F.max_by(F.struct("http_status", "error"), "attempt").alias("_end"),
    )
    ok = F.col("_first_ok").isNotNull()
    return g.select(
        "archive_id",
        ok.alias("fetch_ok"),
        F.coalesce(F.col("_first_ok"), F.col("_last")).cast("int").alias("attempts_used"),
        F.when(ok, F.lit(C.HTTP_OK)).otherwise(F.col("_end.http_status")).cast("int").alias("http_status"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.col("_end.error")).alias("fetch_error"),
    )


def outcome_reason(fold: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """Adds ``error_log``: the failure text for failed outcomes, NULL for successes."""
    kind = (F.when(F.col("fetch_ok"), F.lit(None))
            .when(F.col("http_status").isNotNull(), F.lit("api"))
            .otherwise(F.lit("network")))
    if "failure_kind" in fold.columns:  # fetch outcomes say what failed (e.g. a request that could not be built)
        kind = F.when(F.col("fetch_ok"), F.lit(None)).otherwise(F.coalesce(F.col("failure_kind"), kind))
    return fold.withColumn("error_log", failure_reason(kind, "http_status", "fetch_error", max_attempts))


def with_backoff(fold: DataFrame) -> DataFrame:
    return fold.withColumn("backoff_seconds", backoff_seconds("attempts_used"))
