"""Archives against the ledger: what a job's files hold and what its rows say.

Only the directories of archives are read: a ZIP file's directory lies at its end, so a task seeks there and reads the
tail, whatever the size of the bodies. Entries and ledger meet in one full outer join on the id.
"""

from __future__ import annotations

import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..sinks import fs as fsx

ENTRY_PORTION = 50_000   # rows that a listing task hands on at once
LISTED = "archive_path string, archive_id string, bytes long, crc long, error string"


def archive_listing(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """(archive_path, archive_id, bytes, crc, error) of every entry, from the directories of ``paths``; an unreadable
    archive is one row with its error. The archives are dealt over ``spark.sql.shuffle.partitions`` tasks: a list of names is small,
    however many directories it stands for, so adaptive execution would join its partitions into one task."""

    def run(batches):
        names, rows = ["archive_path", "archive_id", "bytes", "crc", "error"], []
        for pdf in batches:
            for path in pdf[path_col].tolist():
                try:
                    with fsx.open_input(path) as stream, zipfile.ZipFile(stream) as z:
                        for info in z.infolist():
                            rows.append((path, info.filename.removesuffix(C.ENTRY_SUFFIX), info.file_size, info.CRC, None))
                            if len(rows) >= ENTRY_PORTION:
                                yield pd.DataFrame(rows, columns=names).astype({"bytes": "Int64", "crc": "Int64"})
                                rows = []
                except (OSError, ValueError, zipfile.BadZipFile) as e:
                    rows.append((path, None, None, None, str(e) or type(e).__name__))
        if rows:  # of many archives: a frame for each would cost more than its directory
            yield pd.DataFrame(rows, columns=names).astype({"bytes": "Int64", "crc": "Int64"})

    n = max(1, int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return paths.select(path_col).repartition(n, path_col).mapInPandas(run, LISTED)


def reconcile(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """One row for each id that is COMPLETED or archived: ``archive_id, export_status, n_archives, finding``.

    ``ok``: COMPLETED and in one archive; ``missing``: COMPLETED, in none; ``orphan``: archived, but the ledger has no such id or
    doesn't call it COMPLETED; ``duplicate``: in several archives or several times in one (also if not COMPLETED)."""
    entries = listing.where("error IS NULL").groupBy(F.col("archive_id").alias("entry")).agg(F.count(F.lit(1)).alias("n"))
    rows = ledger.select("archive_id", "export_status").join(entries, F.col("archive_id") == F.col("entry"), "full_outer")
    done = F.coalesce(F.col("export_status") == C.COMPLETED, F.lit(False))
    n = F.coalesce(F.col("n"), F.lit(0))
    finding = F.when(n > 1, "duplicate").when(n == 0, "missing").when(done, "ok").otherwise("orphan")
    return rows.where(done | (n > 0)).select(F.coalesce("archive_id", "entry").alias("archive_id"), "export_status",
                                             n.alias("n_archives"), finding.alias("finding"))


def repairs(found: DataFrame) -> DataFrame:
    """Update rows that mend what a reconciliation found: missing rows go back to PENDING, orphans become COMPLETED. Duplicates
    are harmless for the ledger and stay."""
    status = F.when(F.col("finding") == "missing", C.PENDING).when(F.col("finding") == "orphan", C.COMPLETED)
    return found.where(F.col("finding").isin("missing", "orphan")).select(
        "archive_id", status.alias("export_status"), F.lit(None).cast("string").alias("error_log"), F.lit(0).cast("long").alias("seq"))
