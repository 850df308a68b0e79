from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs as fsx


def write_audit(events: DataFrame, path: str, run: str, fmt: str = "json") -> None:
    """Write one run's audit rows, one directory per channel (general / process / errors) and in it one
    per run. A repeated run replaces its own rows, so a retry adds none."""
    for channel in fsx.list_dir(path, files=False, dirs=True):
        fsx.remove_tree(fsx.join(path, channel, f"run={run}"))
    events.withColumn("run", F.lit(run)).write.mode("append").partitionBy("channel", "run").format(fmt).save(path)


def read_audit(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The audit rows of all runs, with their ``run`` and ``channel``."""
    schema = "event string, archive_id string, detail string, progress string, channel string, run string"
    return spark.read.schema(schema).format(fmt).load(path)
