"""Declared schemas and job configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from . import constants as C

# Ledger of stored items. Timestamps are wall-clock values without a zone
# (TIMESTAMP_NTZ), which is how Parquet TIMESTAMP columns load and keeps every
# comparison independent of the session time zone.
LEDGER = T.StructType([
    T.StructField("archive_id", T.StringType(), False),
    T.StructField("archive_time", T.TimestampNTZType(), True),
    T.StructField("archive_location", T.StringType(), True),
    T.StructField("raw_eml_size", T.LongType(), True),
    T.StructField("export_status", T.StringType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
    T.StructField("error_log", T.StringType(), True),
    T.StructField("retries", T.IntegerType(), True),
])

LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
CLAIM_COLUMNS = ["archive_id", "archive_time", "archive_location", "raw_eml_size"]

PARSED_LOCATION = T.StructType([
    T.StructField("server_ip", T.StringType(), True),
    T.StructField("org_id", T.StringType(), True),
    T.StructField("domain", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("id", T.StringType(), True),
])

CONTENT = T.StructType([
    T.StructField("archive_id", T.StringType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# One row per fetch attempt; a NULL http_status means the request never got a response.
ATTEMPTS = T.StructType([
    T.StructField("archive_id", T.StringType(), False),
    T.StructField("attempt", T.IntegerType(), False),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("error", T.StringType(), True),
])

# Keyed status writes; the highest seq per archive_id wins.
UPDATES = T.StructType([
    T.StructField("archive_id", T.StringType(), False),
    T.StructField("export_status", T.StringType(), True),
    T.StructField("error_log", T.StringType(), True),
    T.StructField("seq", T.LongType(), False),
])

INVENTORY = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("length", T.LongType(), True),
    T.StructField("modificationTime", T.TimestampNTZType(), True),
    T.StructField("is_dir", T.BooleanType(), True),
])


@dataclass(frozen=True)
class ExportConfig:
    job_id: str
    workers: int = C.DEFAULT_WORKERS
    zip_slots: int = 0  # <= 0: derived from workers
    max_zip_mb: int = C.DEFAULT_MAX_ZIP_MB  # <= 0: unlimited
    batch_size: int = C.DEFAULT_BATCH_SIZE
    flush_batch: int = C.DEFAULT_FLUSH_BATCH
    flush_interval_seconds: int = C.DEFAULT_FLUSH_INTERVAL_SECONDS
    max_attempts: int = C.MAX_ATTEMPTS
    archive_base_url: str = ""
    group_mode: str = "slot"  # "slot" | "partition" | "rotate"
    # "hash": slots co-partitioned with bodies, packing fused with writing (bodies shuffle once)
    # "round_robin": slots by claim position, pack metadata first, then shuffle bodies to writers
    # "bytes": slots as stretches of the claim order with equal declared bytes, packed like round_robin
    slot_rule: str = "hash"
    # without a slot count (zip_slots <= 0): slots grow so that no slot (one packing/writing
    # task) gets more declared bytes than this
    max_bytes_per_slot: int | None = 16 * 1024 ** 3
    # archive_id is the ledger's primary key; Spark does not enforce it, so the
    # claimed ids are checked (one partial aggregate) and a duplicate fails the run
    check_unique_ids: bool = True

    @property
    def slots(self) -> int:
        if self.zip_slots > 0:
            return self.zip_slots
        return max(C.MIN_AUTO_SLOTS, self.workers // C.WORKERS_PER_SLOT)

    @property
    def cap_bytes(self) -> int:
        return self.max_zip_mb * C.MB if self.max_zip_mb > 0 else C.UNLIMITED_BYTES


@dataclass(frozen=True)
class RetentionConfig:
    max_age_days: int = C.DEFAULT_MAX_AGE_DAYS
    dry_run: bool = False
    extensions: tuple = field(default=C.RETENTION_EXTENSIONS)
    protect: tuple = ()  # first-level directories never removed by the empty-directory sweep
    # ledger snapshot directories written by the export job age like the ledger copy (.db)
    snapshot_dirs: tuple = ("ledger", "ledger-stream")
