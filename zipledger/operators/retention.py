"""Age-based cleanup of a storage tree."""

from __future__ import annotations

import os
import re

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import age_days, as_timestamp, file_extension, gb_text
from ..sinks import fs as fsx


def below(path_col: str, root: str) -> F.Column:
    """The path relative to ``root``."""
    return F.substring(F.col(path_col), len(root.rstrip("/")) + 2, 1 << 30)


def in_snapshot(path_col: str, snapshot_dirs, root: str, dirs: bool = False) -> F.Column:
    """A file the ledger snapshots of a job consist of, ``<root>/<job>/<ledger>/[batch_id=N/](version=N/...|_committed_N)``
    (with ``dirs``: one of those directories): the counterpart of the single ledger-copy file the original kept
    in each job directory. Any other file in a folder of that name is a stranger's."""
    if not snapshot_dirs:
        return F.lit(False)
    top = r"^[^/]+/(?:" + "|".join(re.escape(d) for d in snapshot_dirs) + ")"
    tail = r"(?:/batch_id=\d+)?(?:/version=\d+)?$" if dirs else r"(?:/batch_id=\d+)?/(?:version=\d+/[^/]+|_committed_\d+)$"
    return below(path_col, root).rlike(top + tail)


def retention_plan(inventory: DataFrame, now=None, max_age_days: int = C.DEFAULT_MAX_AGE_DAYS,
                   extensions=C.RETENTION_EXTENSIONS, mtime_col: str = "mtime",
                   snapshot_dirs: tuple = (), root: str = "") -> DataFrame:
    """Files whose extension (case-sensitive) is listed and whose mtime is strictly
    before ``now - max_age_days * 24h``, at any depth. Files inside ledger snapshot
    directories (``snapshot_dirs``) age like the ledger copy (``.db``) they replace."""
    t = as_timestamp(now)
    cutoff = t - F.expr(f"INTERVAL {int(max_age_days) * 24} HOURS")
    files = inventory.where(~F.col("is_dir")) if "is_dir" in inventory.columns else inventory
    kind = file_extension("path").isin(*extensions) | in_snapshot("path", snapshot_dirs, root)
    return files.where(kind & (F.col(mtime_col) < cutoff)).withColumn("age_days", age_days(mtime_col, t))


DELETE_RESULT = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("length", T.LongType(), True),
    T.StructField("deleted", T.BooleanType(), False),
    T.StructField("error", T.StringType(), True),
])


def apply_retention(plan: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Delete the planned files in parallel; one result row per file.

    A missing file counts as deleted (so a retried task is harmless). Other
    failures are recorded and the run goes on. The result performs deletions
    when evaluated: materialise it exactly once (e.g. write it)."""
    rows = plan.select("path", F.col("length").cast("long").alias("length"))
    if num_partitions:
        rows = rows.repartition(num_partitions)

    def run(batches):
        for pdf in batches:
            deleted, errors = [], []
            for p in pdf["path"].tolist():
                try:
                    if "://" in p:
                        sfs, sp = fsx.resolve(p)
                        sfs.delete_file(sp)
                    else:
                        os.remove(p)
                    deleted.append(True)
                    errors.append(None)
                except FileNotFoundError:
                    deleted.append(True)
                    errors.append(None)
                except OSError as e:
                    deleted.append(False)
                    errors.append(str(e))
            yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "deleted": deleted, "error": errors})

    return rows.mapInPandas(run, DELETE_RESULT)


def retention_summary(result: DataFrame, errors_before: int = 0) -> DataFrame:
    """files, bytes, GB text and errors. Without a ``deleted`` column (dry run)
    every planned file counts as if deleted; failed deletions count only as errors."""
    ok = F.col("deleted") if "deleted" in result.columns else F.lit(True)
    agg = result.agg(F.count_if(ok).alias("files"),
                     F.coalesce(F.sum(F.when(ok, F.col("length"))), F.lit(0)).cast("long").alias("bytes"),
                     (F.count_if(~ok) + F.lit(errors_before)).cast("long").alias("errors"))
    return agg.select("files", "bytes", gb_text("bytes").alias("gb_freed"), "errors")


def first_level(path_col: str, root: str):
    """The first directory component below ``root`` (NULL for files directly in root)."""
    r = root.rstrip("/") + "/"
    rest = F.substring(F.col(path_col), len(r) + 1, 1 << 30)
    return F.when(F.col(path_col).startswith(r) & (F.instr(rest, "/") > 0),
                  F.concat(F.lit(r), F.substring_index(rest, "/", 1)))


def empty_job_dirs(files: DataFrame, deleted: DataFrame, root: str, dirs: DataFrame | None = None,
                   protect: list[str] | tuple = (), snapshot_dirs: tuple = ()) -> DataFrame:
    """First-level directories with no entries left after deletion.

    A file keeps its job directory if it was not deleted or if it sits in a
    subdirectory (the subdirectory itself survives, even when emptied). With
    ``dirs`` (all first-level directories) never-populated ones are included.
    ``protect`` names first-level directories never to remove (e.g. jobs that
    are starting right now). Directories inside a ledger snapshot
    (``snapshot_dirs``) do not keep a job: once their files are gone they go too.
    Returns ``path`` of each directory to remove.
    """
    f = files.select("path", *(["is_dir"] if "is_dir" in files.columns else [])) \
        .withColumn("dir", first_level("path", root))
    f = f.where(F.col("dir").isNotNull())
    depth_gt0 = F.instr(F.substring(F.col("path"), F.length(F.col("dir")) + 2, 1 << 30), "/") > 0
    gone = deleted.select("path", F.lit(True).alias("_gone"))
    if "is_dir" in files.columns:
        f = f.withColumn("_is_dir", F.coalesce(F.col("is_dir"), F.lit(False)))
    else:
        f = f.withColumn("_is_dir", F.lit(False))
    marked = f.join(gone, "path", "left")
    snap = F.when(F.col("_is_dir"), in_snapshot("path", snapshot_dirs, root, dirs=True)).otherwise(
        in_snapshot("path", snapshot_dirs, root))
    # a file survives unless deleted; a (sub)directory survives unless it belongs to a snapshot
    survives = F.when(F.col("_is_dir"), ~snap).otherwise(F.col("_gone").isNull() | (depth_gt0 & ~snap))
    keep = marked.where(survives).select("dir").distinct()
    candidates = f.select("dir").distinct()
    if dirs is not None:
        candidates = candidates.unionByName(dirs.select(F.col("path").alias("dir"))).distinct()
    out = candidates.join(keep, "dir", "left_anti")
    if protect:
        r = root.rstrip("/") + "/"
        out = out.where(~F.col("dir").isin(*[r + p for p in protect]))
    return out.select(F.col("dir").alias("path"))


def remove_dirs(dirs: DataFrame) -> DataFrame:
    """Remove the given directories, bottom-up with ``rmdir`` only: emptied
    subdirectories (snapshot versions) go first, and a directory still holding a
    file is never removed (the error is recorded). Returns path, removed, error."""
    def remove(top: str) -> None:
        for d, _, _ in sorted(os.walk(top, topdown=False), key=lambda w: -w[0].count("/")):
            os.rmdir(d)

    def remove_uri(top: str) -> None:
        sfs, p = fsx.resolve(top)
        if sfs.get_file_info(p).type == pafs.FileType.NotFound:
            return
        if isinstance(sfs, pafs.LocalFileSystem):
            return remove(p)
        inside = sfs.get_file_info(pafs.FileSelector(p, recursive=True))
        for d in [*sorted((i.path for i in inside if i.type == pafs.FileType.Directory), key=lambda x: -x.count("/")), p]:
            left = sfs.get_file_info(pafs.FileSelector(d))  # these stores have no rmdir: look right before each deletion
            if left:
                raise OSError(f"directory not empty: {left[0].path}")
            sfs.delete_dir(d)

    def run(batches):
        for pdf in batches:
            ok, err = [], []
            for p in pdf["path"].tolist():
                try:
                    if "://" in p:
                        remove_uri(p)
                    elif os.path.isdir(p):
                        remove(p)
                    ok.append(True)
                    err.append(None)
                except OSError as e:
                    ok.append(False)
                    err.append(str(e))
            yield pd.DataFrame({"path": pdf["path"], "removed": ok, "error": err})
    return dirs.mapInPandas(run, "path string, removed boolean, error string")
