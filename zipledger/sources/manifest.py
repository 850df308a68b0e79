from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LEDGER, LEDGER_COLUMNS


def read_manifest(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a ledger table with the declared schema (no inference)."""
    return spark.read.format(fmt).schema(LEDGER).options(**options).load(path)


def conform_ledger(df: DataFrame) -> DataFrame:
    """Cast an arbitrary ledger-shaped frame to the declared column order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER.fields])


def duplicate_ids(ledger: DataFrame) -> DataFrame:
    """archive_id is a primary key; Spark does not enforce it, so check it explicitly."""
    return ledger.groupBy("archive_id").count().where(F.col("count") > 1)


__all__ = ["read_manifest", "conform_ledger", "duplicate_ids", "LEDGER_COLUMNS"]
