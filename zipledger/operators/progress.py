"""Counters over completion events: progress text and flush batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_timestamp, progress_text
from .ordering import with_global_rank


def _order():
    return [F.col("ts").asc_nulls_first(), F.col("archive_id").asc()]


def running_progress(completions: DataFrame, done_before: int, total: int) -> DataFrame:
    """``current/total`` per completion in time order; the counter starts at the
    number already completed when the run began."""
    ranked = with_global_rank(completions, _order(), "_n")
    n = (F.col("_n") + F.lit(done_before)).cast("long")
    return ranked.select("archive_id", "ts", n.alias("progress_n"),
                         progress_text(n, F.lit(total)).alias("progress")).drop("_n")


def flush_batches(completions: DataFrame, start, batch_size: int, interval_seconds: int) -> DataFrame:
    """Which completion write each id lands in.

    The flusher writes when ``batch_size`` ids are pending or when the ticker
    fires; the ticker runs every ``interval_seconds`` from ``start`` and is not
    reset by size flushes. So an id belongs to tick ``floor((ts - start)/interval)``
    and, within it, to batch ``floor((position in tick - 1) / batch_size)``.

    Position in tick = global position - first global position of the tick, so a
    burst (one tick holding a third of all ids) is still spread over range
    partitions instead of one window partition. Ids without a time share tick NULL.
    """
    t0 = as_timestamp(start)
    tick = F.floor(F.timestamp_diff("MICROSECOND", t0, F.col("ts")) / F.lit(interval_seconds * 1_000_000))
    ranked = with_global_rank(completions.withColumn("tick", tick.cast("long")), _order(), "_g")
    first = ranked.groupBy(F.col("tick").alias("_tick")).agg(F.min("_g").alias("_g0"))
    pos = F.col("_g") - F.col("_g0")
    return (ranked.join(first, F.col("tick").eqNullSafe(F.col("_tick")))
            .select("archive_id", "ts", "tick",
                    F.floor(pos / F.lit(batch_size)).cast("long").alias("flush_batch")))
