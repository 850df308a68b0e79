"""Continuous ingestion of ledger rows with incremental processing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_source_path(spark: SparkSession, path: str) -> str:
    """File streams need a directory or a glob; turn a single file into a one-file glob."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(where) and files.getFileStatus(where).isFile():
        return path[:-1] + "[" + path[-1] + "]"
    return path


def stream_manifest(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int = 1,
                    fmt: str = "parquet") -> DataFrame:
    """A streaming read of ledger files; each trigger takes at most N new files."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(stream_source_path(spark, path)))


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      timeout_seconds: float | None = None) -> StreamingQuery:
    """Process everything available now, in micro-batches, and stop. Restarting on
    the same checkpoint processes only files that arrived since."""
    q = (df.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    if q.awaitTermination(timeout_seconds) is False:
        q.stop()
        raise TimeoutError(f"the stream did not finish in {timeout_seconds} seconds")
    if q.exception():
        raise q.exception()
    return q
