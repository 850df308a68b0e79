"""Global ordinals without funnelling rows through one task.

``row_number() OVER (ORDER BY ...)`` without PARTITION BY moves every row
into one partition. Here instead: range-partition on the order key, sort
within partitions, read the partition-local position from
``monotonically_increasing_id`` (partition id in the upper 31 bits, row
position in the lower 33), and add per-partition offsets computed from a
table with one row per partition. That table is bounded by the partition
count, so broadcasting it is safe at any data size.

Range bounds come from sampling seeded by the RDD id, so two evaluations
of the same range shuffle may cut the data differently. The positions are
therefore pinned by writing the ranged rows once as Parquet under the shared
``spark.checkpoint.dir`` (one job; a reliable ``checkpoint()`` would run the
plan twice) before both the per-partition totals and the rows read them. The
numbering thereby also survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, staging_path

_LOW = (1 << 33) - 1


def with_global_rank(df: DataFrame, order: list[Column], out_col: str, weight: Column | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col``: the 1-based position of each row in ``order`` (a total order),
    or, with ``weight``, the inclusive running sum of ``weight`` in that order."""
    checkpoint_root(df.sparkSession)
    # without an explicit count AQE may coalesce neighbouring range partitions,
    # which keeps the order; positions are read after that, inside the write
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = (ranged.sortWithinPartitions(*order)
              .withColumn("_gr_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_gr_pid", F.shiftright("_gr_mid", 33))
              .withColumn("_gr_lrn", F.col("_gr_mid").bitwiseAND(F.lit(_LOW)) + 1)
              .drop("_gr_mid"))
    if weight is None:
        ranged = ranged.withColumn("_gr_local", F.col("_gr_lrn"))
    else:
        w = Window.partitionBy("_gr_pid").orderBy("_gr_lrn").rowsBetween(Window.unboundedPreceding, 0)
        ranged = ranged.withColumn("_gr_local", F.sum(weight.cast("long")).over(w))
    path = staging_path(df.sparkSession, "positions")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    totals = ranged.groupBy("_gr_pid").agg(F.max("_gr_local").alias("_gr_total"))
    # one row per range partition: a single-partition window here is bounded by n
    before = Window.orderBy("_gr_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_gr_pid", F.coalesce(F.sum("_gr_total").over(before), F.lit(0)).alias("_gr_off"))
    return (ranged.join(F.broadcast(offsets), "_gr_pid")
            .withColumn(out_col, (F.col("_gr_off") + F.col("_gr_local")).cast("long"))
            .drop("_gr_pid", "_gr_lrn", "_gr_local", "_gr_off"))
