"""Archive sinks: ZIP files of entries ``{archive_id}.eml`` (Deflate).

``write_archives`` writes already numbered archives: ``repartition(zip_idx)`` +
``sortWithinPartitions(zip_idx, seq)`` + ``mapInPandas(writer)``; each archive
is written by exactly one task, entries in claim order, to a hidden temporary
name that is atomically renamed when complete, so a retried or speculative task
rewrites the same bytes under the same final name.

``sinks.zip_source`` packs and writes in one go, chunk by chunk, and numbers archives at the job's commit.
"""

from __future__ import annotations

import hashlib
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from . import fs as fsx

READ_BLOCK, READ_ROWS = 1 << 20, 10_000
ARCHIVE_ROWS = T.StructType([
    T.StructField("zip_idx", T.LongType(), False),
    T.StructField("archive_path", T.StringType(), False),
    T.StructField("entries", T.LongType(), False),
    T.StructField("bytes", T.LongType(), False),
    T.StructField("file_bytes", T.LongType(), False),
])


def write_archives(rows: DataFrame, out_dir: str, group_col: str = "grp", seq_col: str = "claim_seq",
                   num_partitions: int | None = None, compresslevel: int | None = None) -> DataFrame:
    """Write archives; returns one row per archive (index, relative path, entries, bytes).

    ``rows`` needs ``archive_id, zip_idx, <group_col>, <seq_col>, content``.
    ``out_dir``: a local/shared path or a file://, hdfs:// or s3:// URI (``sinks.fs``).
    """
    base = out_dir
    src = rows.select("archive_id", "zip_idx", group_col, seq_col, "content")

    def run(batches):
        out = []
        state = {"idx": None, "zf": None, "tmp": None, "final": None, "rel": None, "n": 0, "b": 0}

        def close():
            if state["zf"] is None:
                return
            state["zf"].close()
            state["stream"].close()
            fsx.move(state["tmp"], state["final"])
            out.append((state["idx"], state["rel"], state["n"], state["b"], fsx.size(state["final"])))
            state["zf"] = None

        for pdf in batches:
            ids = pdf["archive_id"].tolist()
            idxs = pdf["zip_idx"].tolist()
            grps = pdf[group_col].tolist()
            bodies = pdf["content"].tolist()
            for i in range(len(ids)):
                if idxs[i] != state["idx"]:
                    close()
                    name = C.ARCHIVE_NAME_FORMAT % idxs[i]
                    d = fsx.join(base, str(grps[i]))
                    fsx.makedirs(d)
                    state.update(idx=idxs[i], final=fsx.join(d, name), rel=f"{grps[i]}/{name}", n=0, b=0,
                                 tmp=fsx.join(d, f".{name}.{uuid.uuid4().hex}.tmp"))
                    state["stream"] = fsx.open_output(state["tmp"])
                    state["zf"] = zipfile.ZipFile(state["stream"], "w", compression=zipfile.ZIP_DEFLATED,
                                                  compresslevel=compresslevel)
                body = bodies[i] if bodies[i] is not None else b""
                state["zf"].writestr(f"{ids[i]}{C.ENTRY_SUFFIX}", bytes(body))
                state["n"] += 1
                state["b"] += len(body)
            if out:
                yield pd.DataFrame(out, columns=[f.name for f in ARCHIVE_ROWS.fields])
                out.clear()
        close()
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in ARCHIVE_ROWS.fields])

    parts = src.repartition(num_partitions, "zip_idx") if num_partitions else src.repartition("zip_idx")
    return parts.sortWithinPartitions("zip_idx", seq_col).mapInPandas(run, ARCHIVE_ROWS)


def temp_dir(out_dir: str, run_id: str) -> str:
    """Where one run's unfinished archives live (hidden; removed by the job's commit or abort, ``zip_source``)."""
    return fsx.join(out_dir, ".staging", run_id)


def read_archives(archives: DataFrame, out_dir: str) -> DataFrame:
    """Read archives back: (archive_path, archive_id, content_bytes, content_md5) for every entry of every archive. Bodies
    stream through their digest block by block, and rows are handed on in portions. The archives are dealt over
    ``spark.sql.shuffle.partitions`` tasks: a list of names is small, whatever the archives weigh."""
    base = out_dir
    names = ["archive_path", "archive_id", "content_bytes", "content_md5"]

    def run(batches):
        for pdf in batches:
            for rel in pdf["archive_path"].tolist():
                rows = []
                with fsx.open_input(fsx.join(base, rel)) as stream, zipfile.ZipFile(stream) as z:
                    for info in z.infolist():
                        size, digest = 0, hashlib.md5()
                        with z.open(info) as entry:
                            while block := entry.read(READ_BLOCK):
                                size += len(block)
                                digest.update(block)
                        rows.append((rel, info.filename.removesuffix(C.ENTRY_SUFFIX), size, digest.hexdigest()))
                        if len(rows) >= READ_ROWS:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    spark = archives.sparkSession
    dealt = archives.select("archive_path").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "archive_path")
    return dealt.mapInPandas(run, "archive_path string, archive_id string, content_bytes long, content_md5 string")
