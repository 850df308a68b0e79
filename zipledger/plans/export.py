"""The export job: claim -> parse -> fetch -> pack -> number -> write -> commit -> report.

Stage boundaries that are written to storage (so every later step reads one
fixed copy and a lost executor never re-runs a fetch or an archive write):
  * claim positions (the ordering checkpoint)
  * the fetch outcomes and bodies, when fetched (nondeterministic, costly)
  * the per-entry archive lists (written by the tasks that wrote the archives, valid by the job's commit)
The input must be a stable table (e.g. a committed snapshot); the output is
always a new ledger version, never the input path. Bodies are shuffled once,
into the task that packs and writes them (hash slot rule).
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import json
import os
import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import build_url, failure_reason
from ..operators import ledger as L
from ..operators import packing as PK
from ..operators.attempts import outcome_reason
from ..operators.progress import running_progress
from ..operators.report import audit_events, job_report
from ..schema import ExportConfig
from ..session import qualified, staging_path
from ..sinks import fs as fsx
from ..sinks.archive import write_archives
from ..sinks.audit import write_audit
from ..sinks.zip_source import committed_archives, committed_entries, failed_entries, route_chunks, write_chunked_archives
from ..sources.chunks import chunk_bodies, fetch_chunks, fetched_chunks, fetched_outcomes
from ..sinks.ledger import committed_versions, last_archive, read_ledger_snapshot, write_ledger_snapshot
from ..sources.fetch import fetch_content, resolve_content
from ..sources.inventory import list_any
from ..sources.manifest import duplicate_ids


@dataclass
class ExportResult:
    ledger: DataFrame      # the committed new ledger version
    archives: DataFrame    # one row per archive written
    entries: DataFrame     # record -> archive
    report: DataFrame      # one-row job report
    version: int
    start_index: int
    timings: dict


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


PRUNE_BYTES = 64 << 20  # claimed ids up to this size are broadcast to prune a content table


def resume_start(spark: SparkSession, job_dir: str, group_dirs: bool = False, ledger_root: str | None = None) -> int:
    """Highest existing archive index directly in the job directory (0 if none).

    The job's last commit records it; names are listed only where there is no such record, or where an archive
    that the record doesn't know follows it. With per-group archive directories (``group_mode="partition"``) their
    direct children are scanned too, so numbering never reuses an index."""
    known = last_archive(ledger_root) if ledger_root and not group_dirs else None
    if known is not None and not fsx.exists(fsx.join(job_dir, C.ARCHIVE_NAME_FORMAT % (known + 1))):
        return known
    names = [(n,) for n in fsx.list_dir(job_dir)]
    if group_dirs:
        for sub in fsx.list_dir(job_dir, files=False, dirs=True):
            if sub not in _LEDGER_DIRS:
                names += [(n,) for n in fsx.list_dir(fsx.join(job_dir, sub))]
    if not names:
        return 0
    df = spark.createDataFrame(names, "name string")
    return int(PK.resume_index(df, depth_col=None).first()["resume_index"])


_INTENT = "_uncommitted_run.json"
_LEDGER_DIRS = ("ledger", "ledger-stream")


def _drop_archives_after(job_dir: str, start: int, group_dirs: bool) -> None:
    """Remove archives a dead run left above its start index (no committed ledger names them)."""
    prefix, suffix = re.split(r"%\d*d", C.ARCHIVE_NAME_FORMAT)
    folders = [job_dir]
    if group_dirs:
        folders += [fsx.join(job_dir, d) for d in fsx.list_dir(job_dir, files=False, dirs=True) if d not in _LEDGER_DIRS]
    for folder in folders:
        for name in fsx.list_dir(folder):
            m = re.fullmatch(re.escape(prefix) + r"(\d+)" + re.escape(suffix), name)
            if m and int(m.group(1)) > start:
                fsx.remove(fsx.join(folder, name))


def _begin_run(spark: SparkSession, job_dir: str, cfg: ExportConfig, ledger_root: str) -> int:
    """Archive numbering start for this run.

    Before any archive is written, the start index and the ledger version the run
    will commit are recorded in the job directory. A run that finds a record asks
    whether that version is committed: if so, the dead run only failed to remove
    its record, its archives stay and numbering goes on after them; if not, what it
    wrote belongs to no ledger, is removed, and its start is used again."""
    intent, grouped = fsx.join(job_dir, _INTENT), cfg.group_mode == "partition"
    if fsx.exists(intent):
        record = json.loads(fsx.read_text(intent))
        if record.get("version") not in committed_versions(record.get("ledger", ledger_root)):
            start = int(record["start"])
            _drop_archives_after(job_dir, start, grouped)
            _record_run(intent, start, ledger_root)
            return start
        fsx.remove(intent)
    start = resume_start(spark, job_dir, group_dirs=grouped, ledger_root=ledger_root)
    _record_run(intent, start, ledger_root)
    return start


def _record_run(intent: str, start: int, ledger_root: str) -> None:
    done = committed_versions(ledger_root)
    fsx.write_text(intent, json.dumps({"start": start, "ledger": ledger_root, "version": done[-1] + 1 if done else 1}))


def _end_run(job_dir: str) -> None:
    fsx.remove(fsx.join(job_dir, _INTENT))


def scale_slots(total: int, cfg: ExportConfig) -> ExportConfig:
    """Without a slot count of the user's: enough slots that each holds at most
    ``max_bytes_per_slot`` of the ``total`` declared bytes. A given count is kept."""
    if cfg.zip_slots > 0 or not cfg.max_bytes_per_slot:
        return cfg
    need = -(-total // int(cfg.max_bytes_per_slot))
    return dataclasses.replace(cfg, zip_slots=need) if need > cfg.slots else cfg


def _chunked_pack_write(spark, meta, chunks, cfg: ExportConfig, out_dir: str, start: int, stage: str):
    """Hash slots: chunks of bodies go once to the task that packs and writes their slot; archives are numbered from the
    tasks' commit messages."""
    run, at = os.path.basename(stage), os.path.join(stage, "commit")
    heads = meta.select("archive_id", "declared", F.col("org_id").alias("grp"))
    write_chunked_archives(route_chunks(heads, chunks, cfg.slots, by_hash=True), out_dir, cfg.job_id, cfg.cap_bytes, run=run, start=start,
                           rotate=cfg.group_mode == "rotate", at=at)
    archives = committed_archives(spark, out_dir, run, at).select("zip_idx", "archive_path", "entries", "bytes", "file_bytes")
    numbered = committed_entries(spark, out_dir, run, at).select("archive_id", "zip_idx", F.lit(cfg.job_id).alias("grp"))
    zip_failed = failed_entries(spark, out_dir, run, at).select("archive_id", failure_reason(F.lit("zip"), detail="error").alias("error_log"))
    return numbered, archives, zip_failed


def run_export(spark: SparkSession, ledger: DataFrame, cfg: ExportConfig, out_dir: str, *,
               fetcher_factory=None, streamer_factory=None, content: DataFrame | None = None, now=None,
               max_batches: int | None = None, sleep=time.sleep, audit_dir: str | None = None,
               ledger_root: str | None = None, audit_run: str | None = None) -> ExportResult:
    """Run one export over ``ledger`` into ``out_dir/<job_id>``.

    Bodies come from ``content`` (a table keyed by archive_id), from ``streamer_factory`` (``sources.chunks``: block by block,
    connections kept) or from ``fetcher_factory`` (``sources.fetch``: whole responses). ``max_batches`` processes only
    that many claim batches and leaves the next one claimed (PROCESSING), as an
    interrupted run would; a later run resets it and continues.
    """
    if sum(x is not None for x in (content, fetcher_factory, streamer_factory)) != 1:
        raise ValueError("give exactly one of content / fetcher_factory / streamer_factory")
    by_chunks = cfg.slot_rule == "hash" and cfg.group_mode != "partition"
    if streamer_factory is not None and not by_chunks:
        raise ValueError("a streamer needs the hash slot rule and no archives per group")
    out_dir = qualified(spark, out_dir)
    job_dir = os.path.join(out_dir, cfg.job_id)
    stage = staging_path(spark, f"export-{cfg.job_id}")

    timings: dict[str, float] = {}
    clock = [time.time()]

    def lap(name):
        t = time.time()
        timings[name] = round(t - clock[0], 3)
        clock[0] = t

    # One fixed "now" for the whole run keeps every step deterministic, so the
    # recovered ledger can stay a lazy view of the (stable, committed) input.
    run_now = now if now is not None else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(" ")
    cur = L.reset_stale(ledger, now=run_now)
    ledger_root = ledger_root or os.path.join(job_dir, "ledger")
    start = _begin_run(spark, job_dir, cfg, ledger_root)

    # claim positions are pinned by the ordering checkpoint; nothing else to stage
    claimed = L.claim_batches(cur, cfg.batch_size)
    interrupted = None
    if max_batches is not None:
        interrupted = claimed.where(F.col("batch_id") == max_batches)
        claimed = claimed.where(F.col("batch_id") < max_batches)

    if cfg.check_unique_ids:
        dup = duplicate_ids(claimed).limit(1).collect()
        if dup:
            raise ValueError(f"archive_id {dup[0]['archive_id']!r} appears {dup[0]['count']} times in the ledger")
    valid, rejects = L.split_valid(claimed)
    valid = valid.withColumn("url", build_url("loc"))
    if content is not None:
        # outcomes from a presence join (bodies not read); bodies are read once, by the writer
        content = content.where(F.col("content").isNotNull())  # a row without a body is a miss
        present = content.select("archive_id").distinct().select("archive_id", F.lit(b"").alias("content"))
        fetched = resolve_content(valid, present, cfg.max_attempts).drop("content")
        bodies = content.select("archive_id", "content")
    elif streamer_factory is not None:
        blocks = _stage(fetch_chunks(valid, streamer_factory, cfg.max_attempts, concurrency=cfg.workers, sleep=sleep),
                        os.path.join(stage, "fetched"))
        fetched, bodies = fetched_outcomes(blocks), None
    else:
        # nondeterministic and costly: fetch exactly once, stage, read the copy everywhere
        fetched = _stage(fetch_content(valid, fetcher_factory, cfg.max_attempts, concurrency=cfg.workers,
                                       sleep=sleep), os.path.join(stage, "fetched"))
        bodies = fetched.where("fetch_ok").select("archive_id", "content")
    lap("claim_and_fetch")

    meta = valid.select("archive_id", "claim_seq", F.col("raw_eml_size").alias("declared"),
                        F.col("loc.org_id").alias("org_id")).join(
        fetched.where("fetch_ok").select("archive_id"), "archive_id", "left_semi")
    keys = PK.pack_keys(cfg.group_mode, "org_id")
    size = meta.agg(F.count(F.lit(1)).alias("n"), F.sum("declared").alias("b"), F.sum(F.octet_length("archive_id")).alias("ids")).first()
    cfg = scale_slots(int(size["b"] or 0), cfg)
    if content is not None and by_chunks:
        # ids whose size is known to be small prune the bodies before they move; else unclaimed ones end at the writer
        if int(size["ids"] or 0) + 64 * size["n"] <= PRUNE_BYTES:
            bodies = bodies.join(F.broadcast(meta.select("archive_id")), "archive_id", "left_semi")
    elif content is not None:
        # claimed bodies only, copies of one id collapsed (map-side first): one plan at every size
        bodies = bodies.join(meta.select("archive_id"), "archive_id", "left_semi").groupBy("archive_id").agg(
            F.max("content").alias("content"))
    org = F.url_encode(F.col("org_id"))  # a directory name of its own, whatever the ledger says
    org = F.when(org.rlike(r"^\.*$|^ledger"), F.concat(F.lit("%"), org)).otherwise(org)
    job_dir_rel = F.lit(cfg.job_id) if cfg.group_mode != "partition" else F.concat(F.lit(cfg.job_id + "/"), org)
    # per-group archives are packed from metadata first, then bodies go to their archive's writer
    if by_chunks:
        chunks = fetched_chunks(blocks) if streamer_factory is not None else chunk_bodies(bodies)
        numbered, archives, zip_failed = _chunked_pack_write(spark, meta, chunks, cfg, out_dir, start, stage)
    else:
        ok = bodies.select("archive_id", F.octet_length("content").cast("long").alias("actual"))
        items = meta.join(ok, "archive_id")
        slotted = PK.assign_slots_by_bytes(items, cfg.slots) if cfg.slot_rule == "bytes" else PK.assign_slots(items, cfg.slots)
        packed = _stage(PK.pack_next_fit(slotted, cfg.cap_bytes, mode=cfg.group_mode, group_col="org_id"),
                        os.path.join(stage, "packed"))  # the sequential packer runs once
        numbered = PK.number_archives(packed, keys, start=start, staged=True)
        numbered = _stage(numbered.withColumn("grp", job_dir_rel), os.path.join(stage, "numbered"))
        to_write = numbered.select("archive_id", "zip_idx", "grp", "claim_seq").join(bodies, "archive_id")
        archives = _stage(write_archives(to_write, out_dir, group_col="grp"), os.path.join(stage, "archives"))
        zip_failed = None
    entries = PK.archive_entries(numbered, F.col("grp"))
    lap("pack_and_write")

    failed_fetch = fetched.where(~F.col("fetch_ok"))
    fetch_fail = L.failure_updates(outcome_reason(failed_fetch, cfg.max_attempts), seq=F.lit(2))
    done = L.completion_updates(numbered.select("archive_id"), seq=F.lit(3))
    updates = L.failure_updates(rejects, seq=F.lit(1)).unionByName(fetch_fail).unionByName(done)
    if zip_failed is not None:
        updates = updates.unionByName(L.failure_updates(zip_failed, seq=F.lit(2)))
    if interrupted is not None:
        updates = updates.unionByName(interrupted.select(
            "archive_id", F.lit(C.PROCESSING).alias("export_status"),
            F.lit(None).cast("string").alias("error_log"), F.lit(0).cast("long").alias("seq")))
    final = L.apply_updates(cur, updates, now=run_now)
    done_versions = committed_versions(ledger_root)
    version = done_versions[-1] + 1 if done_versions else 1
    if audit_dir:  # before the commit and under the version to come: a rerun replaces these rows
        failures = L.failure_updates(rejects).unionByName(
            L.failure_updates(outcome_reason(failed_fetch, cfg.max_attempts)))
        # per-record "current/total", counting from what was already completed (claim order)
        before = L.progress_stats(cur).first()
        order = numbered.select("archive_id").join(meta.select("archive_id", F.col("claim_seq").alias("ts")), "archive_id")
        progress = running_progress(order, before["completed"], before["total"]).select("archive_id", "progress")
        archived = entries.join(progress, "archive_id")
        n_archives = archives.count()
        general = spark.createDataFrame([
            ("job_started", f"job={cfg.job_id} workers={cfg.workers} slots={cfg.slots} max_zip_mb={cfg.max_zip_mb}"),
            ("ledger_scanned", f"completed={before['completed']} failed={before['failed']} total={before['total']}"),
            ("resume_index", f"start={start}"),
            ("job_finished", f"archives={n_archives} ledger_version={version}"),
        ], "event string, detail string")   # a fixed handful of job-level rows
        write_audit(audit_events(failures=failures, archived=archived, general=general), audit_dir,
                    audit_run or f"{cfg.job_id}-{version}")
    highest = archives.agg(F.max("zip_idx")).first()[0] or start
    write_ledger_snapshot(final, ledger_root, version, last_archive=highest)
    final = read_ledger_snapshot(spark, ledger_root, version)
    _end_run(job_dir)
    if content is None:
        fsx.remove_tree(os.path.join(stage, "fetched"))  # the bodies are in archives now
    lap("commit")

    inventory = list_any(spark, job_dir)   # paths keep the job dir's form (plain path or URI)
    report = job_report(final, inventory, cfg.job_id, job_dir, cfg.archive_base_url)
    timings["slots"] = cfg.slots
    return ExportResult(final, archives, entries, report, version, start, timings)
