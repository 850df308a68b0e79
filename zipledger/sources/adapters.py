"""Adapters from the generated test tables to the export data model.

They are plain projections (no joins, no shuffles), so every query built on
them scales with the underlying tables. The same rules are written as SQL in
``plans/oracle.py`` for the DuckDB cross-check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c) -> F.Column:
    return c.cast("string")


def manifest_from_orders(orders: DataFrame) -> DataFrame:
    """Ledger rows keyed by order key, covering every status spelling and broken locations."""
    k = F.col("o_orderkey")
    cust = _s(F.col("o_custkey") % 5)
    day = _s(F.col("o_orderdate").cast("date"))
    location = (
        F.when(k % 17 == 0, F.concat(F.lit("10.0.0.1:org"), cust))
        .when(k % 19 == 0, F.lit(""))
        .when(k % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("10.0.0."), _s(k % 4), F.lit(":org"), cust, F.lit(":"),
                            F.col("o_orderstatus"), F.lit(".example:"), day, F.lit(":"), _s(k)))
    )
    statuses = {0: None, 1: "", 2: "  ", 3: C.QUOTED_EMPTY, 4: C.PENDING, 5: C.PROCESSING,
                6: C.COMPLETED, 7: C.FAILED, 8: "pending"}
    status = F.when(F.lit(False), F.lit(None).cast("string"))
    for r, v in statuses.items():
        status = status.when(k % 10 == r, F.lit(v).cast("string"))
    status = status.otherwise(F.lit(C.PENDING))
    return orders.select(
        _s(k).alias("archive_id"),
        F.col("o_orderdate").alias("archive_time"),
        location.alias("archive_location"),
        F.floor(F.col("o_totalprice")).cast("long").alias("raw_eml_size"),
        status.alias("export_status"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(None).cast("string").alias("error_log"),
        F.lit(0).cast("int").alias("retries"),
    )


def attempts_from_manifest(manifest: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """Deterministic fetch attempts 1..max per ledger row: 200, 503, 204 or no response."""
    a = F.explode(F.sequence(F.lit(1), F.lit(max_attempts))).alias("attempt")
    rows = manifest.select("archive_id", a)
    h = F.col("archive_id").cast("long") * 7 + F.col("attempt") * 3
    status = (
        F.when(h % 5 < 1, F.lit(200))
        .when(h % 5 < 3, F.lit(503))
        .when((F.col("archive_id").cast("long") + F.col("attempt")) % 5 == 4, F.lit(204))
        .otherwise(F.lit(None).cast("int"))
    )
    return rows.select(
        "archive_id", F.col("attempt").cast("int").alias("attempt"), status.cast("int").alias("http_status"),
        F.when(status.isNull(), F.lit("timeout")).alias("error"),
    )


def content_from_documents(documents: DataFrame) -> DataFrame:
    """Stored bodies: UTF-8 bytes of each document, keyed by doc id."""
    return documents.select(_s(F.col("doc_id")).alias("archive_id"),
                            F.encode(F.col("text"), "UTF-8").alias("content"))


def completions_from_events(events: DataFrame) -> DataFrame:
    """Completion events (archive id, time) from the event stream."""
    return events.select(_s(F.col("event_id")).alias("archive_id"), F.col("ts"))


def inventory_from_events(events: DataFrame) -> DataFrame:
    """A storage tree of 3,000 job directories with mixed extensions and some nesting."""
    j = F.col("event_id") % 3000
    ext = (F.when(j % 6 == 0, ".zip").when(j % 6 == 1, ".db").when(j % 6 == 2, ".ZIP")
           .when(j % 6 == 3, ".log").when(j % 6 == 4, "").otherwise(".zip"))
    nested = j % 13 == 0
    path = F.concat(F.lit("/storage/job"), _s(j), F.when(nested, "/sub").otherwise(""),
                    F.lit("/f"), _s(F.col("event_id")), ext)
    return events.select(
        F.concat(F.lit("job"), _s(j)).alias("job"),
        F.when(nested, 1).otherwise(0).alias("depth"),
        path.alias("path"),
        F.col("ts").cast("timestamp_ntz").alias("mtime"),
        F.floor(F.abs(F.col("value")) * 1000000).cast("long").alias("length"),
    )


def archive_names_from_events(events: DataFrame) -> DataFrame:
    """Names found directly in 3,000 job directories: archive names in every spelling
    the resume scan must accept or reject, plus unrelated files."""
    e = F.col("event_id")
    j = e % 3000
    n = _s(e)
    name = (
        F.when(e % 9 == 0, F.concat(F.lit("emails_"), F.lpad(n, 4, "0"), F.lit(".zip")))
        .when(e % 9 == 1, F.concat(F.lit("emails_"), n, F.lit(".zip.tmp")))
        .when(e % 9 == 2, F.concat(F.lit("emails_"), n, F.lit(".ZIP")))
        .when(e % 9 == 3, F.concat(F.lit("emails_"), n, F.lit(".tar")))
        .when(e % 9 == 4, F.concat(F.lit("emails_"), n, F.lit("00000000.zip")))
        .when(e % 9 == 5, F.lit("emails_x.zip"))
        .when(e % 9 == 6, F.concat(F.lit("emails_-"), n, F.lit(".zip")))
        .when(e % 9 == 7, F.concat(F.lit("f"), n, F.lit(".zip")))
        .otherwise(F.concat(F.lit("emails_"), n, F.lit(".zip")))
    )
    return events.select(F.concat(F.lit("job"), _s(j)).alias("job"),
                         F.when(j % 13 == 0, 1).otherwise(0).alias("depth"),
                         name.alias("name"))
