"""Export runs that share one ledger: each claims its rows atomically and commits their outcome claim by claim.

Any number of runs (own ``run`` names, own job ids) work on one bucketed ledger at a time. A run claims up to
``claim_rows`` rows, exports them as one job into its own folder, and commits their statuses; then it claims again until
nothing is eligible. Others see claims at once and statuses after every claim, so a crash loses at most the claim
under way: its archives are finished or removed by the job's own record (``plans.export``), and the next start of
the same run commits what the job had finished and gives the rest back.
"""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.ledger import failure_updates
from ..schema import ExportConfig
from ..session import qualified
from ..sinks import bucketed as B
from ..sinks import fs as fsx
from ..sinks.ledger import committed_versions, read_ledger_snapshot
from .export import run_export


@dataclass
class SharedRun:
    claims: int                  # claims this run exported
    archives: list[DataFrame]    # archive rows of each
    snapshot: B.Snapshot         # the ledger after its last commit


def _outcome(ledger: DataFrame) -> DataFrame:
    """Update rows for what a job finished."""
    done = ledger.where(F.col("export_status").isin(C.COMPLETED, C.FAILED))
    return failure_updates(done, seq=F.lit(1), status=F.col("export_status"))


def _recover(spark: SparkSession, root: str, run: str, job_ledger: str, now) -> None:
    """What a dead run of this name finished but didn't commit here is committed; the rest of its claims goes back."""
    snap = B.snapshot(root)
    if run not in snap.claims:
        return
    if committed_versions(job_ledger):
        held = B.held_by(spark, snap, run).select("archive_id")
        path = fsx.join(root, "claims", f"recovered-{snap.version}-{run}")
        _outcome(read_ledger_snapshot(spark, job_ledger)).join(held, "archive_id", "left_semi").write.mode("overwrite").parquet(path)
        B.upsert(spark, root, spark.read.schema(B.UPDATE_ROWS).parquet(path), now=now, base=snap)
    B.release(spark, root, run, now=now)


def run_shared_export(spark: SparkSession, root: str, cfg: ExportConfig, out_dir: str, run: str, *, claim_rows: int | None = 100_000,
                      max_claims: int | None = None, now=None, **how) -> SharedRun:
    """Export from the bucketed ledger at ``root`` until nothing is eligible (or ``max_claims`` claims are done).

    ``run`` names this run's claims and must be no other live run's; ``cfg.job_id`` likewise. ``how``: ``content`` or
    ``fetcher_factory`` and the other options of ``run_export``."""
    out_dir = qualified(spark, out_dir)
    job_ledger = os.path.join(out_dir, cfg.job_id, "ledger")
    _recover(spark, root, run, job_ledger, now)
    cfg = dataclasses.replace(cfg, check_unique_ids=False)  # ids were checked when the ledger was created
    done, archives, snap = 0, [], B.snapshot(root)
    while max_claims is None or done < max_claims:
        mine = B.claim(spark, root, run, claim_rows, now=now)
        snap = mine.snapshot
        if not mine.path:
            break
        rows = mine.rows.select("*", F.lit(C.PENDING).alias("export_status"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
                                F.lit(None).cast("string").alias("error_log"), F.lit(0).alias("retries"))
        res = run_export(spark, rows, cfg, out_dir, now=now, **how)
        snap = B.finish(spark, root, run, mine, _outcome(res.ledger), now=now).snapshot
        archives.append(res.archives)
        done += 1
    return SharedRun(done, archives, snap)
