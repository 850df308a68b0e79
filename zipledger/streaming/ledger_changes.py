"""A bucketed ledger as a stream: ``spark.readStream.format("ledger_changes")``.

Offsets are ledger versions. A batch holds the rows that became eligible between two versions (eligible in the later one and
not in the earlier one; before version 1 nothing is), so a continuous export picks up new, requeued and given-back rows
without scanning the ledger. Only buckets whose files differ between the versions are read, one task a bucket: the earlier
bucket's eligible ids are held in the task (a bucket has a bounded size by choice), the later one streams past them. The
versions between a stream's last offset and the newest must not be expired.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .. import constants as C
from ..sinks import bucketed as B
from ..sinks import fs as fsx

CHANGE_ROWS = "archive_id string, archive_time timestamp_ntz, archive_location string, raw_eml_size long"


@dataclass
class _Bucket(InputPartition):
    before: str | None   # the bucket's folder in the earlier version
    after: str


def _eligible() -> ds.Expression:
    """``functions.is_eligible`` for Arrow: null, empty or spaces only, the literal ``""``, exactly PENDING."""
    s = ds.field("export_status")
    spaces = pc.equal(pc.utf8_trim(s, characters=" "), "")
    return s.is_null() | spaces | (s == C.QUOTED_EMPTY) | (s == C.PENDING)


def _scan(folder: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    fs, path = fsx.resolve(folder)
    yield from ds.dataset(path, filesystem=fs, format="parquet", partitioning=None).scanner(columns=columns, filter=_eligible(), use_threads=False).to_batches()


class _Reader(DataSourceStreamReader):
    def __init__(self, root: str, start: int):
        self.root, self.start = root, start

    def initialOffset(self) -> dict:
        return {"version": self.start}

    def latestOffset(self) -> dict:
        return {"version": B.versions(self.root)[-1]}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start["version"] >= end["version"]:
            return []
        new = B.snapshot(self.root, end["version"])
        old = B.snapshot(self.root, start["version"]).buckets if start["version"] else ("",) * len(new.buckets)
        at = lambda write, b: fsx.join(self.root, "data", write, f"bucket={b}") if write else None
        return [_Bucket(at(a, b), at(z, b)) for b, (a, z) in enumerate(zip(old, new.buckets, strict=True)) if z and a != z]

    def read(self, partition: _Bucket) -> Iterator[pa.RecordBatch]:
        had = [b.column(0) for b in _scan(partition.before, ["archive_id"])] if partition.before else []
        had = pa.chunked_array(had, pa.string()).combine_chunks()
        for batch in _scan(partition.after, ["archive_id", "archive_time", "archive_location", "raw_eml_size"]):
            batch = batch.filter(pc.invert(pc.is_in(batch.column(0), value_set=had)))
            if len(batch):
                yield batch.cast(pa.schema([("archive_id", pa.string()), ("archive_time", pa.timestamp("us")), ("archive_location", pa.string()),
                                            ("raw_eml_size", pa.int64())]))

    def commit(self, end: dict) -> None:
        pass


class LedgerChanges(DataSource):
    """Options: ``path`` (the bucketed ledger's root), ``startingVersion`` (what has been seen already; 0: nothing)."""

    @classmethod
    def name(cls) -> str:
        return "ledger_changes"

    def schema(self) -> str:
        return CHANGE_ROWS

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("startingVersion", 0)))


def stream_ledger_changes(spark: SparkSession, root: str, starting_version: int = 0) -> DataFrame:
    """A streaming DataFrame of rows that become eligible, from the version after ``starting_version`` on."""
    spark.dataSource.register(LedgerChanges)
    return spark.readStream.format("ledger_changes").option("path", root).option("startingVersion", str(starting_version)).load()
