"""Incremental file inventory: the last listing kept as a keyed snapshot, listed anew and merged with what changed.

``refresh`` lists a tree against the snapshot of its last listing. Every directory the snapshot knows is looked at in the first
round, whatever its depth; one whose modification time is what it was still holds the same names, so its names are taken from the
snapshot and it isn't read. Only new directories take further rounds. Names and metadata are gathered in two steps: a
directory is read for its names by one task, and the names of all directories are dealt over the tasks that fetch the metadata, so
a flat directory of a million names is spread over all of them.

A store holds, for each version, the rows that changed (``<store>/data/<write>/``) and a small manifest that names the writes it is made
of (``<store>/_versions/<version>.json``, created exclusively: of two refreshes that began at one version the second raises
``FileExistsError`` and leaves nothing). Every ``compact_every`` versions the whole state is written, so a read joins few writes.
The driver sees versions and directory names of the store only.

Defined results: paths are unique. An entry is new, gone, or changed (another size, time or kind). An entry that can't be read, and
everything directly in a directory that can't be read, keeps its last known row (``unread`` names it) and is never called gone; such a
directory is read again next time. A missing root raises. Modification times are trusted only if they are older than the listing
that recorded them by ``settle_seconds``: that covers changes during a listing, coarse file times and clocks apart by less.
Object stores have no directory times, so all their directories are read.
"""

from __future__ import annotations

import json
import os
import stat
import time
import uuid
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import qualified, staging_path
from ..sinks import fs as fsx
from .inventory import _entries_uri, _local

ENTRY = "path string, length long, modificationTime timestamp_ntz, is_dir boolean"
_CHANGE = ENTRY + ", change string"
_FOUND = ENTRY + ", error string"
_VALUES = ["length", "modificationTime", "is_dir"]
_ROWS = 10_000  # entries a task holds before it hands them on


@dataclass(frozen=True)
class Version:
    number: int
    writes: tuple[str, ...]   # whole state first, then the changes of each later version
    listed_at: int            # when the listing began, microseconds since the epoch


@dataclass
class Refresh:
    version: Version
    changes: DataFrame        # path, length, modificationTime, is_dir, change
    unread: DataFrame         # path, error


# ---- the merge -------------------------------------------------------------------------

def parent_of(path: str = "path") -> Column:
    return F.expr(f"left({path}, length({path}) - length(substring_index({path}, '/', -1)) - 1)")


def diff(before: DataFrame, after: DataFrame, unread: DataFrame | None = None) -> DataFrame:
    """What turns ``before`` into ``after`` (both with unique ``path``): one row per new, changed or gone entry, with the entry's new
    values (a gone one's last). Entries that are ``unread`` or lie directly in an unread directory are not gone. One full outer
    join on the unique path, so no key is hot."""
    values = F.struct(*_VALUES)
    both = before.select("path", values.alias("old")).join(after.select("path", values.alias("now")), "path", "full_outer")
    change = F.when(F.col("old").isNull(), "new").when(F.col("now").isNull(), "gone").when(~F.col("old").eqNullSafe(F.col("now")), "changed")
    out = both.select("path", F.coalesce("now", "old").alias("v"), change.alias("change")).where("change is not null").select(
        "path", *[F.col(f"v.{c}").alias(c) for c in _VALUES], "change")
    if unread is not None:
        lost = unread.select(F.col("path").alias("lost"))
        for place in (F.col("path"), parent_of()):
            out = out.join(lost, (place == F.col("lost")) & (F.col("change") == "gone"), "left_anti")
    return out


def _fold(writes: DataFrame) -> DataFrame:
    """The state that numbered changes leave: each path's last row, without the gone ones."""
    last = writes.groupBy("path").agg(F.max_by(F.struct(*_VALUES, "change"), "seq").alias("v"))
    return last.where("v.change <> 'gone'").select("path", *[F.col(f"v.{c}").alias(c) for c in _VALUES])


# ---- the store -------------------------------------------------------------------------

def _manifest(store: str, number: int) -> str:
    return fsx.join(store, "_versions", f"{number:012d}.json")


def latest(store: str) -> Version | None:
    names = [n for n in fsx.list_dir(fsx.join(store, "_versions")) if n.endswith(".json") and not n.startswith(".")]
    return version(store, max(int(n.removesuffix(".json")) for n in names)) if names else None


def version(store: str, number: int) -> Version:
    d = json.loads(fsx.read_text(_manifest(store, number)))
    return Version(number, tuple(d["writes"]), d["listed_at"])


def read(spark: SparkSession, store: str, at: Version | None = None) -> DataFrame:
    """The inventory as of a version (the newest by default; nothing if there is none)."""
    at = at or latest(store)
    if at is None:
        return spark.createDataFrame([], ENTRY)
    whole, *later = [spark.read.schema(_CHANGE).parquet(fsx.join(store, "data", w)) for w in at.writes]
    if not later:
        return whole.drop("change")
    numbered = whole.withColumn("seq", F.lit(0))
    for i, changes in enumerate(later, 1):
        numbered = numbered.union(changes.withColumn("seq", F.lit(i)))
    return _fold(numbered)


def changes_of(spark: SparkSession, store: str, number: int) -> DataFrame:
    """What a version changed against the one before; version 1: everything is new."""
    made = version(store, number)
    if number == 1 or len(made.writes) > 1:
        return spark.read.schema(_CHANGE).parquet(fsx.join(store, "data", made.writes[-1]))
    return diff(read(spark, store, version(store, number - 1)), read(spark, store, made))


def commit(spark: SparkSession, store: str, listing: DataFrame, listed_at: int, unread: DataFrame | None = None,
           base: Version | None = None, compact_every: int = 16) -> Version:
    """The next version of a store: ``listing`` merged into version ``base`` (None: the store is new)."""
    number, writes = (base.number if base else 0) + 1, base.writes if base else ()
    name = uuid.uuid4().hex
    at = fsx.join(store, "data", name)
    before = read(spark, store, base) if base else spark.createDataFrame([], ENTRY)
    diff(before, listing, unread).write.parquet(at)
    made, written = (*writes, name), [name]
    if len(made) > compact_every:
        whole = uuid.uuid4().hex
        read(spark, store, Version(number, made, listed_at)).withColumn("change", F.lit("new")).write.parquet(fsx.join(store, "data", whole))
        made, written = (whole,), [name, whole]
    if not fsx.create_exclusive(_manifest(store, number), json.dumps({"writes": made, "listed_at": listed_at})):
        for w in written:
            fsx.remove_tree(fsx.join(store, "data", w))
        raise FileExistsError(f"version {number} of {store} was committed by another refresh")
    return Version(number, made, listed_at)


# ---- the listing -----------------------------------------------------------------------

def refresh(spark: SparkSession, root: str, store: str, settle_seconds: int = 60, num_partitions: int | None = None,
            compact_every: int = 16) -> Refresh:
    """List ``root`` against the newest version of ``store``, commit the changes as the next one and return them. The
    tree's own row (``root``) is part of the inventory."""
    base, now = latest(store), time.time_ns() // 1000
    known = read(spark, store, base)
    trusted = (base.listed_at - settle_seconds * 1_000_000) if base else 0
    found = relist(spark, root, known, trusted, num_partitions)
    unread = found.where("error is not null").select("path", "error")
    blind = unread.select("path").distinct().withColumn("blind", F.lit(True))
    # an unread directory's time is dropped, so that it is read next time
    listing = found.where("error is null").drop("error").join(blind, "path", "left").select(
        "path", "length", F.when(F.col("blind").isNull(), F.col("modificationTime")).alias("modificationTime"), "is_dir")
    made = commit(spark, store, listing, now, unread, base, compact_every)
    return Refresh(made, changes_of(spark, store, made.number), unread)


def relist(spark: SparkSession, root: str, known: DataFrame, trusted_before: int, num_partitions: int | None = None) -> DataFrame:
    """Every entry under ``root`` and itself: path, length, modificationTime, is_dir, error. Directories of ``known`` with the same time
    as there, if it is before ``trusted_before`` (microseconds since the epoch), are not read. The result is staged."""
    root = qualified(spark, root)
    base = root.rstrip("/") if "://" in root else _local(root).rstrip("/")
    if not fsx.is_dir(base):
        raise FileNotFoundError(f"no directory {root}")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage, rounds = staging_path(spark, "relisting"), []
    limit = F.lit(pd.Timestamp(trusted_before, unit="us").isoformat(sep=" ")).cast("timestamp_ntz")
    seen = F.when(F.col("modificationTime") < limit, F.col("modificationTime"))
    known_dirs = known.where("is_dir").select("path", seen.alias("seen"))
    start = spark.createDataFrame([(base, None)], "path string, seen timestamp_ntz")
    dirs = first = known_dirs.union(start.join(known_dirs, "path", "left_anti"))
    while True:
        level = fsx.join(stage, f"level-{len(rounds)}")
        dirs.repartition(n).mapInPandas(_names, _FOUND + ", same boolean").write.parquet(level + "-names")
        names = spark.read.schema(_FOUND + ", same boolean").parquet(level + "-names")
        todo = names.where("not same").drop("same")
        if not rounds:
            # the names of directories that stayed as they were; a hot one is split, as only its own side has many rows
            same = names.where("same").select(F.col("path").alias("held"))
            kept = known.join(same, parent_of() == F.col("held"), "left_semi").select("path").union(start.select("path"))
            todo = todo.unionByName(kept, allowMissingColumns=True)
        todo.repartition(n, "path").mapInPandas(_stat, _FOUND).write.parquet(level)
        rounds.append(level)
        dirs = spark.read.schema(_FOUND).parquet(level).where("is_dir and error is null").select(
            "path", F.lit(None).cast("timestamp_ntz").alias("seen")).join(first.select("path"), "path", "left_anti")
        if dirs.isEmpty():
            return spark.read.schema(_FOUND).parquet(*rounds)


def _portions(rows, columns):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield _frame(held, columns)
            held = []
    if held:
        yield _frame(held, columns)


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    out["length"] = pd.array(out["length"], dtype="Int64")
    out["modificationTime"] = pd.to_datetime(out["modificationTime"], unit="us")
    out["is_dir"] = pd.array(out["is_dir"], dtype="boolean")
    return out


def _names(batches):
    """For each directory: itself with ``same`` if its time is ``seen``, else the names in it (object stores: with metadata)."""
    def rows():
        for pdf in batches:
            for directory, seen in zip(pdf["path"].tolist(), pdf["seen"].tolist(), strict=True):
                try:
                    us, is_dir = _time(directory)
                    if not is_dir:
                        continue
                    if us is not None and not pd.isna(seen) and pd.Timestamp(seen).value // 1000 == us:
                        yield directory, None, None, None, None, True
                    elif "://" in directory:
                        for entry in _entries_uri(directory):
                            yield *entry, False
                    else:
                        with os.scandir(directory) as found:
                            for e in found:
                                yield e.path, None, None, None, None, False
                except FileNotFoundError:
                    pass  # gone, as the merge will tell
                except OSError as err:
                    yield directory, None, None, True, str(err), False
    return _portions(rows(), ["path", "length", "modificationTime", "is_dir", "error", "same"])


def _time(path: str):
    """(time in microseconds or None, whether it is a directory)."""
    if "://" not in path:
        st = os.lstat(path)
        return st.st_mtime_ns // 1000, stat.S_ISDIR(st.st_mode)
    fs, p = fsx.resolve(path)
    info = fs.get_file_info(p)
    return None if info.mtime_ns is None else info.mtime_ns // 1000, info.type == pafs.FileType.Directory


def _stat(batches):
    """The metadata of names that have none yet; names that are gone are left out."""
    def rows():
        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for path, length, mtime, is_dir, error in pdf[["path", "length", "modificationTime", "is_dir", "error"]].itertuples(index=False):
                if is_dir is not None or error is not None:
                    yield path, length, None if mtime is None else pd.Timestamp(mtime).value // 1000, is_dir, error
                    continue
                try:
                    if "://" not in path:
                        st = os.lstat(path)
                        folder = stat.S_ISDIR(st.st_mode)
                        yield path, None if folder else st.st_size, st.st_mtime_ns // 1000, folder, None
                        continue
                    fs, p = fsx.resolve(path)
                    info = fs.get_file_info(p)
                    if info.type != pafs.FileType.NotFound:
                        folder = info.type == pafs.FileType.Directory
                        yield path, None if folder else info.size, None if info.mtime_ns is None else info.mtime_ns // 1000, folder, None
                except FileNotFoundError:
                    pass
                except OSError as err:
                    yield path, None, None, None, str(err)
    return _portions(rows(), ["path", "length", "modificationTime", "is_dir", "error"])
