"""ZIP archives as a Spark data source: ``df.write.format("zip_archives")``.

Rows are headers (``chunk_no`` -1: an item's declared size and group) and chunks of bodies, sorted by ``slot, ord,
archive_id, copy, chunk_no`` with each slot in one task (``route_chunks``). A task packs next-fit and appends every chunk to the
open entry as it comes, so it holds one chunk at a time, whatever the size of a body. It writes to files of its own
under ``.staging/<run>`` and hands the driver one commit message: how many archives each of its slots has, never its rows.
Its archives, and which entry lies where, it lists as Parquet beside them.

The job's commit numbers all archives slot by slot from the messages, writes the run's manifest ``_archives/<run>.json`` (or
another folder's, option ``manifests``) in one atomic step, gives the files their names and drops the staging folder, and with it whatever killed or repeated task
attempts have left. The manifest is the commit: before it nothing is visible, after it ``finish_commits`` can give
the names again. An aborted job leaves nothing. The manifest holds the number before each slot's first archive; the driver passes over the
tasks' lists in portions of ``MOVE_ROWS`` to give the names, so it holds one record per task and slot, however many archives there are.

The lists are read back with ``committed_archives`` and ``committed_entries``.
"""

from __future__ import annotations

import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .. import constants as C
from ..functions import archive_name
from . import fs as fsx
from .archive import ARCHIVE_ROWS, temp_dir

CHUNK_ROWS = "slot int, ord long, archive_id string, copy long, chunk_no int, grp string, declared long, chunk binary"
# n: the archive's number within its task and slot, without gaps (k counts archives that got no entry, too)
ENTRY_ROWS = "task string, slot int, n long, archive_id string, bytes long, error string"
MADE_ROWS = "task string, slot int, n long, k long, entries long, bytes long, file_bytes long"
_ENTRIES = pa.schema([("task", pa.string()), ("slot", pa.int32()), ("n", pa.int64()), ("archive_id", pa.string()), ("bytes", pa.int64()), ("error", pa.string())])
_MADE = pa.schema([("task", pa.string()), ("slot", pa.int32()), *((c, pa.int64()) for c in ("n", "k", "entries", "bytes", "file_bytes"))])
LIST_BATCH = 50_000
MOVES = 64         # files that a thread of the commit names in one go
MOVE_ROWS = 8192   # rows of the tasks' lists that it holds at once


@dataclass
class Written(WriterCommitMessage):
    task: str
    counts: list[tuple]        # (slot, archives)
    made: str | None           # the task's archive list
    entries: str | None        # its entry list

    @property
    def archives(self) -> list[tuple]:
        """(slot, k, temporary path, entries, bytes) of all archives, from the list."""
        return [(r["slot"], r["k"], _temp(self.made.rsplit("/", 1)[0], r), r["entries"], r["bytes"]) for b in _batches(self.made) for r in b]

    @property
    def sizes(self) -> list[int]:
        return [r["file_bytes"] for b in _batches(self.made) for r in b]


def _temp(staging: str, row: dict) -> str:
    return fsx.join(staging, f"{row['task']}-{row['slot']}-{row['k']}.zip")


def _batches(path: str | None) -> Iterator[list[dict]]:
    """A list's rows in portions."""
    if path:
        fs, p = fsx.resolve(path)
        with fs.open_input_file(p) as f:
            for batch in pq.ParquetFile(f).iter_batches(MOVE_ROWS):
                yield batch.to_pylist()


class _List:
    """Rows of a task, written as Parquet in portions; without a row there is no file."""

    def __init__(self, path: str, schema: pa.Schema):
        self.path, self.schema, self.rows, self.writer = path, schema, [], None

    def add(self, *row) -> None:
        self.rows.append(row)
        if len(self.rows) >= LIST_BATCH:
            self.flush()

    def flush(self) -> None:
        if self.writer is None:
            self.file = fsx.open_output(self.path)
            self.writer = pq.ParquetWriter(self.file, self.schema)
        self.writer.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), self.schema.types, strict=True)], schema=self.schema))
        self.rows.clear()

    def close(self) -> str | None:
        if self.rows:
            self.flush()
        if self.writer is None:
            return None
        self.writer.close()
        self.file.close()
        return self.path


def route_chunks(meta: DataFrame, chunks: DataFrame, slots: int, by_hash: bool = False) -> DataFrame:
    """Header and chunk rows, each slot in one task, in the order that the writer needs.

    ``meta``: ``archive_id, declared`` and ``grp``; with ``slot`` and ``claim_seq`` if they are given (``by_hash`` False), else
    the slot is the id's hash partition, items go in id order and bodies are exchanged once, with no join before."""
    grp = F.col("grp") if "grp" in meta.columns else F.lit(None).cast("string")
    if by_hash:
        slot = F.pmod(F.hash("archive_id"), F.lit(slots)).cast("int")
        meta = meta.select("archive_id", slot.alias("slot"), F.lit(0).cast("long").alias("ord"), grp.alias("grp"), "declared")
        chunks = chunks.select("archive_id", "copy", "chunk_no", "chunk", slot.alias("slot"), F.lit(0).cast("long").alias("ord"))
    else:
        meta = meta.select("archive_id", "slot", F.col("claim_seq").alias("ord"), grp.alias("grp"), "declared")
        chunks = chunks.join(meta.select("archive_id", "slot", "ord"), "archive_id")
    heads = meta.select("slot", "ord", "archive_id", F.lit(None).cast("long").alias("copy"), F.lit(-1).alias("chunk_no"), "grp", "declared", F.lit(None).cast("binary").alias("chunk"))
    rows = heads.unionByName(chunks.select("slot", "ord", "archive_id", "copy", "chunk_no", F.lit(None).cast("string").alias("grp"),
                                           F.lit(None).cast("long").alias("declared"), "chunk"))
    rows = rows.repartition(slots, "archive_id") if by_hash else rows.repartition(slots, "slot")
    return rows.sortWithinPartitions("slot", "ord", "archive_id", "copy", "chunk_no")


class _Packer:
    """Next-fit over headers and chunks; an item without a chunk gets no entry, a chunk without a header, of a further copy or a repeated one is
    skipped. An entry that can't be opened fails its item only; a failing write fails the task."""

    def __init__(self, staging: str, cap: int, rotate: bool, level: int | None):
        from ..operators.packing import NextFit

        self.staging, self.tag, self.level = staging, uuid.uuid4().hex, level
        self.fit = NextFit(cap, rotate)
        self.zip = self.stream = self.entry = self.path = self.head = None
        self.entries = self.bytes = self.size = 0
        self.next = 0
        self.counts: dict[int, int] = {}   # archives by slot
        self.opened: dict[int, int] = {}   # the last k by slot
        self.made = _List(fsx.join(staging, f"{self.tag}-archives.parquet"), _MADE)
        self.listed = _List(fsx.join(staging, f"{self.tag}.parquet"), _ENTRIES)
        fsx.makedirs(staging)

    def row(self, slot: int, archive_id: str, copy: int | None, chunk_no: int, grp, declared, chunk) -> None:
        if chunk_no < 0:
            if self.head is None or self.head[:2] != (slot, archive_id):
                self.end_entry()
                self.head, self.next = (slot, archive_id, grp, int(declared or 0)), 0
            return
        if self.head is None or self.head[:2] != (slot, archive_id) or chunk_no != self.next:
            return
        if chunk_no == 0:
            self.copy = copy
            if not self.begin_entry():
                self.next = -1  # no chunk of this item has that number
                return
        elif copy != self.copy:
            return
        self.entry.write(chunk)
        self.fit.fill += len(chunk)
        self.size += len(chunk)
        self.next += 1

    def begin_entry(self) -> bool:
        slot, archive_id, grp, declared = self.head
        k, opened = self.fit.step(slot, declared, 0, grp)
        if opened:
            self.end_archive()
            self.path = _temp(self.staging, {"task": self.tag, "slot": slot, "k": k})
            self.key, self.opened[slot] = (slot, k), k
            self.stream = fsx.open_output(self.path)
            self.zip = zipfile.ZipFile(self.stream, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=self.level)
        info = zipfile.ZipInfo(f"{archive_id}{C.ENTRY_SUFFIX}")
        info.compress_type = zipfile.ZIP_DEFLATED
        try:
            self.entry, self.size = self.zip.open(info, "w", force_zip64=True), 0
        except (ValueError, struct.error) as e:  # a name that ZIP can't hold
            self.listed.add(self.tag, slot, None, archive_id, None, str(e) or type(e).__name__)
        return self.entry is not None

    def end_entry(self) -> None:
        if self.entry is None:
            return
        self.entry.close()
        self.entry = None
        self.entries += 1
        self.bytes += self.size
        slot = self.key[0]
        self.listed.add(self.tag, slot, self.counts.get(slot, 0) + 1, self.head[1], self.size, None)

    def end_archive(self) -> None:
        self.end_entry()
        if self.zip is not None:
            self.zip.close()
            file_bytes = self.stream.tell()
            self.stream.close()
            if self.entries:
                slot, k = self.key
                n = self.counts[slot] = self.counts.get(slot, 0) + 1
                self.made.add(self.tag, slot, n, k, self.entries, self.bytes, file_bytes)
            else:
                fsx.remove(self.path)
            self.zip = None
            self.entries = self.bytes = 0

    def discard(self) -> None:
        """Remove what this attempt wrote."""
        for slot, last in self.opened.items():
            for k in range(1, last + 1):
                fsx.remove(_temp(self.staging, {"task": self.tag, "slot": slot, "k": k}))
        for listed in (self.made, self.listed):
            fsx.remove(listed.path)

    def close(self) -> Written:
        self.end_archive()
        return Written(self.tag, sorted(self.counts.items()), self.made.close(), self.listed.close())


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.out, self.folder, self.run = options["path"], options["folder"], options["run"]
        self.cap, self.start = int(options["cap"]), int(options.get("start", 0))
        self.rotate = str(options.get("rotate", "false")).lower() == "true"
        self.level = int(options["level"]) if options.get("level") else None
        self.at = options.get("manifests") or manifests(self.out)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        packer = _Packer(temp_dir(self.out, self.run), self.cap, self.rotate, self.level)
        try:
            for batch in iterator:
                narrow = [batch.column(c).to_pylist() for c in ("slot", "archive_id", "copy", "chunk_no", "grp", "declared")]
                chunks = batch.column("chunk")   # one at a time
                for i, row in enumerate(zip(*narrow, strict=True)):
                    packer.row(*row, chunks[i].as_py() if row[3] >= 0 else None)
            return packer.close()
        except BaseException:  # also when the job is aborted under a task that still runs
            packer.discard()
            raise

    def commit(self, messages) -> None:
        made = [m for m in messages if m is not None]
        slots, last = [], self.start
        for slot, i, n in sorted((slot, i, n) for i, m in enumerate(made) for slot, n in m.counts):
            slots.append((made[i].task, slot, last))
            last += n
        manifest = {"folder": self.folder, "start": self.start, "last": last, "slots": slots,
                    "made": [m.made for m in made if m.made], "lists": [m.entries for m in made if m.entries]}
        if not fsx.create_exclusive(_manifest(self.at, self.run), json.dumps(manifest)):
            raise FileExistsError(f"run {self.run} is committed")
        _give_names(self.out, self.run, self.at)

    def abort(self, messages) -> None:
        fsx.remove_tree(temp_dir(self.out, self.run))


class ZipArchives(DataSource):
    """Options: ``path``, ``folder`` (below it), ``run`` (unique), ``cap`` (bytes), ``start`` (the highest index in use), ``rotate``,
    ``level``, ``manifests`` (folder)."""

    @classmethod
    def name(cls) -> str:
        return "zip_archives"

    def schema(self) -> str:
        return CHUNK_ROWS

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("zip_archives only appends")
        return _Writer(dict(self.options))


# -- commits -------------------------------------------------------------------------------------

def manifests(out: str) -> str:
    return fsx.join(out, "_archives")


def _manifest(at: str, run: str) -> str:
    return fsx.join(at, f"{run}.json")


def _made(at: str, run: str) -> str:
    return fsx.join(at, f"{run}-archives")


def _lists(at: str, run: str) -> str:
    return fsx.join(at, f"{run}-entries")


def _committed(at: str, run: str) -> dict:
    return json.loads(fsx.read_text(_manifest(at, run)))


def _give_names(out: str, run: str, at: str) -> None:
    """Move a committed run's files to their names; what is moved already is left. A list moves after its archives."""
    made = _committed(at, run)
    staging, folder = temp_dir(out, run), fsx.join(out, made["folder"])
    first = {(task, slot): n for task, slot, n in made["slots"]}
    lists = [(p, fsx.join(to, p.rsplit("/", 1)[1])) for to, paths in ((_made(at, run), made["made"]), (_lists(at, run), made["lists"])) for p in paths]
    for made_in in {dst.rsplit("/", 1)[0] for _, dst in lists} | ({folder} if made["made"] else set()):
        fsx.makedirs(made_in)
    with ThreadPoolExecutor(32) as pool:
        for path in made["made"]:
            for rows in _batches(path) if fsx.exists(path) else ():
                moves = [(_temp(staging, r), fsx.join(folder, C.ARCHIVE_NAME_FORMAT % (first[r["task"], r["slot"]] + r["n"]))) for r in rows]
                list(pool.map(fsx.move_left, [moves[i:i + MOVES] for i in range(0, len(moves), MOVES)]))
    fsx.move_left(lists)
    fsx.remove_tree(staging)


def committed_runs(out: str) -> list[str]:
    return [n.removesuffix(".json") for n in fsx.list_dir(manifests(out)) if n.endswith(".json") and not n.startswith(".")]


def finish_commits(out: str) -> list[str]:
    """Finish the commits of drivers that died after the manifest, and remove what uncommitted runs left. No run may be under way."""
    done = set(committed_runs(out))
    left = fsx.list_dir(fsx.join(out, ".staging"), files=False, dirs=True)
    for run in left:
        if run in done:
            _give_names(out, run, manifests(out))
        else:
            fsx.remove_tree(temp_dir(out, run))
    return [run for run in left if run in done]


def last_index(out: str, folder: str) -> int:
    """The highest archive index that committed runs gave in a folder: read from the manifests, no directory is listed."""
    runs = [_committed(manifests(out), run) for run in committed_runs(out)]
    return max((m["last"] for m in runs if m["folder"] == folder and m["made"]), default=0)


def write_chunked_archives(rows: DataFrame, out: str, folder: str, cap: int, run: str | None = None, start: int | None = None,
                           rotate: bool = False, level: int | None = None, at: str | None = None) -> str:
    """Write routed rows (``route_chunks``) as archives; returns the committed run's name."""
    run = run or uuid.uuid4().hex
    rows.sparkSession.dataSource.register(ZipArchives)
    w = rows.write.format(ZipArchives.name()).mode("append").option("path", out).option("folder", folder).option("run", run)
    w = w.option("cap", str(cap)).option("start", str(last_index(out, folder) if start is None else start)).option("rotate", str(rotate))
    for name, value in (("level", level), ("manifests", at)):
        w = w.option(name, str(value)) if value is not None else w
    w.save()
    return run


def _numbered(spark: SparkSession, rows: DataFrame, slots: list) -> DataFrame:
    """``rows`` of the tasks' lists with ``zip_idx``. The numbers before the slots' first archives are one row per task and slot."""
    first = pa.table({c: pa.array(v, t) for c, v, t in zip(("task", "slot", "first"), zip(*slots, strict=True), (pa.string(), pa.int32(), pa.int64()), strict=True)})
    return rows.join(F.broadcast(spark.createDataFrame(first)), ["task", "slot"]).withColumn("zip_idx", F.col("first") + F.col("n"))


def _path(made: dict) -> Column:
    return F.concat(F.lit(made["folder"] + "/"), archive_name("zip_idx")).alias("archive_path")


def committed_archives(spark: SparkSession, out: str, run: str, at: str | None = None) -> DataFrame:
    """One row per archive of a committed run (also its slot and ordinal there), in the order of their numbers."""
    at = at or manifests(out)
    made = _committed(at, run)
    if not made["made"]:
        return spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARCHIVE_ROWS) + ", slot int, k long")
    rows = _numbered(spark, spark.read.schema(MADE_ROWS).parquet(_made(at, run)), made["slots"])
    return rows.select("zip_idx", _path(made), "entries", "bytes", "file_bytes", "slot", "k").orderBy("zip_idx")


def _listed(spark: SparkSession, made: dict, run: str, at: str) -> DataFrame:
    if not made["lists"]:
        return spark.createDataFrame([], ENTRY_ROWS)
    return spark.read.schema(ENTRY_ROWS).parquet(_lists(at, run))


def committed_entries(spark: SparkSession, out: str, run: str, at: str | None = None) -> DataFrame:
    """(archive_id, bytes, zip_idx, archive_path) of every entry of a committed run."""
    at = at or manifests(out)
    made = _committed(at, run)
    if not made["slots"]:
        return spark.createDataFrame([], "archive_id string, bytes long, zip_idx long, archive_path string")
    rows = _numbered(spark, _listed(spark, made, run, at).where("error IS NULL"), made["slots"])
    return rows.select("archive_id", "bytes", "zip_idx", _path(made))


def failed_entries(spark: SparkSession, out: str, run: str, at: str | None = None) -> DataFrame:
    """(archive_id, error) of the items whose entry couldn't be made."""
    at = at or manifests(out)
    return _listed(spark, _committed(at, run), run, at).where("error IS NOT NULL").select("archive_id", "error")
