"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the generated tables through the adapters in
``sources/adapters.py`` and runs over whole tables.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import os

from .. import constants as C
from ..functions import archive_name, build_url, cap_bytes, format_size, parse_location, portal_link, slot_count
from ..operators import attempts as AT
from ..operators import ledger as L
from ..operators import packing as PK
from ..operators import progress as PR
from ..operators.block_packing import pack_next_fit_blocks
from ..operators.reconcile import archive_listing, reconcile
from ..operators.report import audit_events, job_report, total_archive_size
from ..operators.retention import apply_retention, empty_job_dirs, retention_plan, retention_summary
from ..schema import ExportConfig, RetentionConfig
from ..session import staging_path
from ..sinks import bucketed as B
from ..sinks import fs as fsx
from ..sinks.archive import read_archives, write_archives
from ..sinks.audit import read_audit, write_audit
from ..sinks.ledger import read_ledger_snapshot, write_ledger_snapshot
from ..sinks.zip_source import committed_archives, committed_entries, last_index, route_chunks, write_chunked_archives
from ..sources import adapters as A
from ..sources import incremental as I
from ..sources.chunks import chunk_bodies
from ..sources.fetch import attempt_rule_fetcher_factory, fetch_content, resolve_content
from ..sources.inventory import list_files, snapshot
from ..sources.manifest import conform_ledger
from ..streaming.commit import commit_completions, compact
from ..streaming.export_stream import read_stream_ledger, run_export_stream
from ..streaming.ledger_changes import stream_ledger_changes
from ..streaming.manifest_stream import run_available_now, stream_manifest
from ..streaming.pack_state import stream_pack
from ..streaming.timed_commit import commit_timed, drain, progress_now, stream_progress
from . import params as P
from .export import run_export
from .retention import materialize_tree, run_retention
from .shared_export import run_shared_export

Query = Callable[[SparkSession, str], DataFrame]


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.manifest_from_orders(A.load_table(spark, sf_dir, "orders"))


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger as a run sees it after start-up recovery."""
    return L.reset_stale(_manifest(spark, sf_dir), now=P.NOW)


def q_manifest_scan(spark, sf_dir):
    return conform_ledger(_manifest(spark, sf_dir))


def q_eligible_records(spark, sf_dir):
    return L.eligible(_manifest(spark, sf_dir))


def q_parse_location(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return m.select("archive_id", "archive_location", parse_location("archive_location").alias("loc")) \
        .select("archive_id", "archive_location", "loc.*")


def q_build_url(spark, sf_dir):
    m = _manifest(spark, sf_dir).withColumn("loc", parse_location("archive_location"))
    return m.where("loc.valid").select("archive_id", build_url("loc").alias("url"))


def q_reset_stale(spark, sf_dir):
    return _current(spark, sf_dir)


def q_progress_stats(spark, sf_dir):
    return L.progress_stats(_manifest(spark, sf_dir))


def q_claim_batches(spark, sf_dir):
    return L.claim_batches(_current(spark, sf_dir), P.BATCH_SIZE)


def q_claim_first_batch(spark, sf_dir):
    return L.claim_first_batch(_current(spark, sf_dir), P.BATCH_SIZE)


def _claimed(spark, sf_dir):
    return L.claim_batches(_current(spark, sf_dir), P.BATCH_SIZE)


def _fold(spark, sf_dir):
    return AT.fold_attempts(A.attempts_from_manifest(_manifest(spark, sf_dir)))


def q_claim_mark_processing(spark, sf_dir):
    """Ledger after one claim: the first batch becomes PROCESSING (error text untouched)."""
    cur = _current(spark, sf_dir)
    return L.mark_claimed(cur, L.claim_first_batch(cur, P.BATCH_SIZE), now=P.NOW)


def q_parse_rejects(spark, sf_dir):
    _, rejects = L.split_valid(L.eligible(_current(spark, sf_dir)))
    return rejects


def q_fold_attempts(spark, sf_dir):
    return _fold(spark, sf_dir)


def q_failure_reasons(spark, sf_dir):
    return AT.outcome_reason(_fold(spark, sf_dir)).where(~F.col("fetch_ok")).select("archive_id", "error_log")


def q_backoff_seconds(spark, sf_dir):
    return AT.with_backoff(_fold(spark, sf_dir)).select("archive_id", "attempts_used", "backoff_seconds")


def q_format_size(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    scale = F.pow(F.lit(1024), F.col("archive_id").cast("long") % 5).cast("long")
    sized = m.select("archive_id", (F.col("raw_eml_size") * scale).alias("nbytes"))
    return sized.select("archive_id", "nbytes", format_size("nbytes").alias("size_text"))


def q_portal_link(spark, sf_dir):
    m = _manifest(spark, sf_dir).withColumn("loc", parse_location("archive_location")).where("loc.valid")
    base = F.concat(F.lit("https://"), F.col("loc.server_ip"), F.lit("/portal"),
                    F.repeat(F.lit("/"), (F.col("archive_id").cast("long") % 4).cast("int")))
    job = F.concat(F.lit("job-"), F.col("loc.org_id"))
    return m.select("archive_id", base.alias("base_url"), portal_link(base, job).alias("link"))


def q_slot_sizing(spark, sf_dir):
    o = A.load_table(spark, sf_dir, "orders")
    cfg = o.select(F.col("o_orderkey").cast("string").alias("archive_id"),
                   (F.col("o_custkey") % 300).alias("workers"),
                   (F.col("o_orderkey") % 9 - 3).alias("zip_slots"),
                   (F.col("o_orderkey") % 5 - 1).alias("max_zip_mb"))
    return cfg.select("*", slot_count("workers", "zip_slots").alias("slots"),
                      cap_bytes("max_zip_mb").alias("cap_bytes"))


def q_mark_completed(spark, sf_dir):
    done = A.completions_from_events(A.load_table(spark, sf_dir, "events"))
    return L.apply_updates(_current(spark, sf_dir), L.completion_updates(done), now=P.NOW)


def q_mark_failed(spark, sf_dir):
    _, rejects = L.split_valid(L.eligible(_current(spark, sf_dir)))
    return L.apply_updates(_current(spark, sf_dir), L.failure_updates(rejects), now=P.NOW)


def _run_updates(spark, sf_dir):
    """Updates a run would write: parse rejects, fetch outcomes, then completion events."""
    cur = _current(spark, sf_dir)
    valid, rejects = L.split_valid(L.eligible(cur))
    outcomes = AT.outcome_reason(_fold(spark, sf_dir)).join(valid.select("archive_id"), "archive_id", "left_semi")
    fetched = L.failure_updates(outcomes, seq=F.lit(2),
                                status=F.when(F.col("fetch_ok"), F.lit("COMPLETED")).otherwise(F.lit("FAILED")))
    events = A.completions_from_events(A.load_table(spark, sf_dir, "events"))
    done = L.completion_updates(events, seq=F.lit(3))
    return cur, L.failure_updates(rejects, seq=F.lit(1)).unionByName(fetched).unionByName(done)


def q_apply_updates(spark, sf_dir):
    cur, ups = _run_updates(spark, sf_dir)
    return L.apply_updates(cur, ups, now=P.NOW)


def _pack_input(spark, sf_dir):
    """Valid claimed rows with slot, org, declared size and the size actually stored."""
    slotted = PK.assign_slots(_claimed(spark, sf_dir), P.SLOTS)
    valid, _ = L.split_valid(slotted)
    docs = A.load_table(spark, sf_dir, "documents")
    sizes = docs.select(F.col("doc_id").cast("string").alias("archive_id"),
                        F.octet_length("text").cast("long").alias("_stored"))
    return valid.join(sizes, "archive_id", "left").select(
        "archive_id", "slot", "claim_seq", F.col("loc.org_id").alias("org_id"),
        F.col("raw_eml_size").alias("declared"),
        F.coalesce(F.col("_stored"), F.col("raw_eml_size")).alias("actual"))


_CAP = P.PACK_CAP_MB * 1024 * 1024


def q_slot_assignment(spark, sf_dir):
    return PK.assign_slots(_claimed(spark, sf_dir), P.SLOTS).select("archive_id", "claim_seq", "slot")


def q_slots_by_bytes(spark, sf_dir):
    claimed = _claimed(spark, sf_dir).withColumn("declared", F.col("raw_eml_size"))
    return PK.assign_slots_by_bytes(claimed, P.SLOTS).select("archive_id", "claim_seq", "slot")


def q_pack_next_fit(spark, sf_dir):
    return PK.pack_next_fit(_pack_input(spark, sf_dir), _CAP, mode="slot")


def q_pack_one_slot(spark, sf_dir):
    """All claimed rows in one slot, packed by blocks of the claim order."""
    rows = _pack_input(spark, sf_dir).withColumn("slot", F.lit(0))
    return pack_next_fit_blocks(rows, _CAP, block_rows=P.BLOCK_ROWS, fan_in=P.FAN_IN)


def q_pack_by_org(spark, sf_dir):
    return PK.pack_next_fit(_pack_input(spark, sf_dir), _CAP, mode="partition", group_col="org_id")


def q_pack_rotate_on_change(spark, sf_dir):
    return PK.pack_next_fit(_pack_input(spark, sf_dir), _CAP, mode="rotate", group_col="org_id")


def _numbered(spark, sf_dir):
    packed = PK.pack_next_fit(_pack_input(spark, sf_dir), _CAP, mode="slot")
    return PK.number_archives(packed, ["slot"], start=P.RESUME_START)


def q_number_archives(spark, sf_dir):
    return _numbered(spark, sf_dir).select("archive_id", "slot", "k", "zip_idx")


def q_archive_names(spark, sf_dir):
    return _numbered(spark, sf_dir).select("zip_idx").distinct() \
        .select("zip_idx", archive_name("zip_idx").alias("archive_name"))


def q_archive_entries(spark, sf_dir):
    return PK.archive_entries(_numbered(spark, sf_dir), F.lit(P.JOB_ID))


def q_resume_index(spark, sf_dir):
    names = A.archive_names_from_events(A.load_table(spark, sf_dir, "events"))
    return PK.resume_index(names, ["job"])


def _completions(spark, sf_dir):
    return A.completions_from_events(A.load_table(spark, sf_dir, "events"))


def q_running_progress(spark, sf_dir):
    stats = L.progress_stats(_current(spark, sf_dir)).first()
    return PR.running_progress(_completions(spark, sf_dir), stats["completed"], stats["total"])


def q_flush_batches(spark, sf_dir):
    return PR.flush_batches(_completions(spark, sf_dir), P.FLUSH_START, P.FLUSH_BATCH, P.FLUSH_INTERVAL_SECONDS)


# ---- sources, sinks and the export job -------------------------------------------------

def _valid_claimed(spark, sf_dir):
    valid, _ = L.split_valid(_claimed(spark, sf_dir))
    return valid.withColumn("url", build_url("loc"))


def _content(spark, sf_dir):
    return A.content_from_documents(A.load_table(spark, sf_dir, "documents"))


def q_fetch_content(spark, sf_dir):
    out = fetch_content(_valid_claimed(spark, sf_dir), attempt_rule_fetcher_factory(), sleep=lambda s: None)
    return out.drop("content", "failure_kind")


def q_resolve_content(spark, sf_dir):
    out = resolve_content(_valid_claimed(spark, sf_dir), _content(spark, sf_dir))
    return out.select("archive_id", "fetch_ok", "attempts_used", "http_status",
                      F.octet_length("content").cast("long").alias("content_bytes"),
                      F.md5("content").alias("content_md5"))


SINK_CAP_MB = 1


def q_archive_sink(spark, sf_dir):
    """Resolved bodies packed (256 KB cap, 10 slots) and written as ZIP files under staging."""
    valid = _valid_claimed(spark, sf_dir)
    fetched = resolve_content(valid, _content(spark, sf_dir)).where("fetch_ok")
    meta = valid.select("archive_id", "claim_seq", F.col("raw_eml_size").alias("declared")).join(
        fetched.select("archive_id", F.octet_length("content").cast("long").alias("actual")), "archive_id")
    packed = PK.pack_next_fit(PK.assign_slots(meta, P.SLOTS), P.SINK_CAP_BYTES, mode="slot")
    numbered = PK.number_archives(packed, ["slot"], start=0).withColumn("grp", F.lit(P.JOB_ID))
    bodies = numbered.select("archive_id", "zip_idx", "grp", "claim_seq").join(
        fetched.select("archive_id", "content"), "archive_id")
    out = staging_path(spark, "archive_sink")
    written = write_archives(bodies, out, group_col="grp")
    written.write.parquet(out + "/_rows")
    return spark.read.parquet(out + "/_rows").select("zip_idx", "archive_path", "entries", "bytes")


def _chunk_meta(spark, sf_dir):
    """Valid claimed rows with their slot, and the stored bodies as chunks of at most 1 KB."""
    meta = PK.assign_slots(_valid_claimed(spark, sf_dir), P.SLOTS).select(
        "archive_id", "slot", "claim_seq", F.col("raw_eml_size").alias("declared"))
    return meta, chunk_bodies(_content(spark, sf_dir), P.CHUNK_BYTES)


def q_archive_commit(spark, sf_dir):
    """The archives of ``archive_sink``, written by the data source: numbers come from the tasks' commit messages."""
    out = staging_path(spark, "archive_commit")
    run = write_chunked_archives(route_chunks(*_chunk_meta(spark, sf_dir), P.SLOTS), out, P.JOB_ID, P.SINK_CAP_BYTES)
    return committed_archives(spark, out, run).select("zip_idx", "archive_path", "entries", "bytes")


def q_archive_chunks(spark, sf_dir):
    """Bodies written chunk by chunk (hash slots: exchanged once) and read back from the archives, in how many entries."""
    out = staging_path(spark, "archive_chunks")
    run = write_chunked_archives(route_chunks(*_chunk_meta(spark, sf_dir), P.SLOTS, by_hash=True), out, P.JOB_ID, P.SINK_CAP_BYTES)
    back = read_archives(committed_archives(spark, out, run), out)
    listed = committed_entries(spark, out, run).select("archive_id", "archive_path", F.col("bytes").alias("listed_bytes"))
    return back.join(listed, ["archive_id", "archive_path"]).groupBy("archive_id").agg(
        F.count("archive_path").alias("n_archives"), F.min("content_bytes").alias("content_bytes"), F.min("listed_bytes").alias("listed_bytes"),
        F.min("content_md5").alias("content_md5"))


def _export_cfg():
    return ExportConfig(job_id=P.JOB_ID, workers=P.WORKERS, max_zip_mb=SINK_CAP_MB, batch_size=P.BATCH_SIZE,
                        archive_base_url=P.BASE_URL)


def q_export_job(spark, sf_dir):
    res = run_export(spark, _manifest(spark, sf_dir), _export_cfg(), staging_path(spark, "export"),
                     content=_content(spark, sf_dir), now=P.NOW)
    return res.ledger


def q_export_roundtrip(spark, sf_dir):
    """What the job's archives hold, read back from the ZIP files: each exported body, in how many archives."""
    out = staging_path(spark, "roundtrip")
    res = run_export(spark, _manifest(spark, sf_dir), _export_cfg(), out, content=_content(spark, sf_dir), now=P.NOW)
    return read_archives(res.archives, out).groupBy("archive_id").agg(
        F.count("archive_path").alias("n_archives"), F.min("content_bytes").alias("content_bytes"), F.min("content_md5").alias("content_md5"))


def q_export_by_org(spark, sf_dir):
    """The job with a folder of archives per organisation, read back: where each exported body lies."""
    out = staging_path(spark, "by_org")
    res = run_export(spark, _manifest(spark, sf_dir), dataclasses.replace(_export_cfg(), group_mode="partition"), out,
                     content=_content(spark, sf_dir), now=P.NOW)
    back = read_archives(res.archives, out)
    return back.withColumn("folder", F.regexp_extract("archive_path", "^(.*)/[^/]*$", 1)).groupBy("archive_id", "folder").agg(
        F.count("archive_path").alias("n_archives"), F.min("content_bytes").alias("content_bytes"), F.min("content_md5").alias("content_md5"))


def _no_sleep(seconds):
    return None


def q_export_job_fetch(spark, sf_dir):
    """The export job with the fetch path: retries decided by the rule-based fetcher."""
    res = run_export(spark, _manifest(spark, sf_dir), _export_cfg(), staging_path(spark, "export_fetch"),
                     fetcher_factory=attempt_rule_fetcher_factory(), sleep=_no_sleep, now=P.NOW)
    return res.ledger


def q_resume_run(spark, sf_dir):
    """Interrupted after three claim batches (the fourth left PROCESSING), then rerun."""
    out = staging_path(spark, "resume")
    first = run_export(spark, _manifest(spark, sf_dir), _export_cfg(), out, content=_content(spark, sf_dir),
                       now=P.NOW, max_batches=3)
    second = run_export(spark, first.ledger, _export_cfg(), out, content=_content(spark, sf_dir), now=P.NOW)
    return second.ledger


def q_ledger_snapshot(spark, sf_dir):
    root = staging_path(spark, "ledger")
    v = write_ledger_snapshot(q_apply_updates(spark, sf_dir), root)
    return read_ledger_snapshot(spark, root, v)


# ---- one ledger, many runs ---------------------------------------------------------------

def q_ledger_upsert(spark, sf_dir):
    """The run's updates as one commit of a bucketed ledger, then one id more: how many buckets the last commit
    rewrote, and how many files it shares with the version before."""
    root = staging_path(spark, "bucketed")
    cur, ups = _run_updates(spark, sf_dir)
    B.create(cur, root, P.LEDGER_BUCKETS)
    ups.write.parquet(root + "/updates")
    first = B.upsert(spark, root, spark.read.schema(B.UPDATE_ROWS).parquet(root + "/updates"), now=P.NOW)
    one = B.read(spark, first.snapshot).agg(F.max("archive_id").alias("archive_id"))
    one.select("archive_id", F.lit("FAILED").alias("export_status"), F.lit("late").alias("error_log"), F.lit(0).cast("long").alias("seq")) \
        .write.parquet(root + "/one")
    last = B.upsert(spark, root, spark.read.schema(B.UPDATE_ROWS).parquet(root + "/one"), now=P.NOW)
    shared = set(first.snapshot.paths()) & set(last.snapshot.paths())
    return B.read(spark, last.snapshot).withColumn("rewritten", F.lit(len(last.rewritten)).cast("long")) \
        .withColumn("shared", F.lit(len(shared)).cast("long"))


def q_claim_two_runs(spark, sf_dir):
    """Two runs that start each round from the same version claim at once, and commit their claims' outcome from it too:
    the ledger in the end, with the run that got each row."""
    root = staging_path(spark, "two_runs")
    B.create(_current(spark, sf_dir), root, P.LEDGER_BUCKETS)
    got = []
    for _ in range(2):
        base = B.snapshot(root)
        a, b = (B.claim(spark, root, run, P.BATCH_SIZE, now=P.NOW, base=base) for run in "AB")
        for run, mine in (("B", b), ("A", a)):  # B's claim knows A's; A's outcome meets B's commit
            if not mine.path:
                continue  # nothing was left for this run
            B.finish(spark, root, run, mine, L.completion_updates(mine.rows), now=P.NOW)
            got.append(mine.rows.select("archive_id", F.lit(run).alias("claimed_by")))
    owners = got[0]
    for more in got[1:]:
        owners = owners.unionByName(more)
    return B.read(spark, B.snapshot(root)).join(owners, "archive_id", "left")


def q_export_two_runs(spark, sf_dir):
    """Two runs export one ledger, the first stopping after one claim: the shared ledger in the end."""
    root, out = staging_path(spark, "shared"), staging_path(spark, "shared_out")
    B.create(_current(spark, sf_dir), root, P.LEDGER_BUCKETS)
    for run, claims in (("run-1", 1), ("run-2", None)):
        cfg = dataclasses.replace(_export_cfg(), job_id=run)
        run_shared_export(spark, root, cfg, out, run, claim_rows=P.CLAIM_ROWS if claims else None, max_claims=claims, now=P.NOW,
                          content=_content(spark, sf_dir))
    return B.read(spark, B.snapshot(root))


def q_stream_ledger_changes(spark, sf_dir):
    """A stream over four ledger versions, read at the first, third and fourth: how often each row became eligible. The versions: a
    claim, then some failed rows requeued, then the claim given back."""
    root = staging_path(spark, "changes")
    B.create(_current(spark, sf_dir), root + "/ledger", P.LEDGER_BUCKETS)

    def read():
        run_available_now(stream_ledger_changes(spark, root + "/ledger").select("archive_id"), root + "/sink", root + "/checkpoint")

    read()
    B.claim(spark, root + "/ledger", "run", P.BATCH_SIZE, now=P.NOW)
    failed = _manifest(spark, sf_dir).where("export_status = 'FAILED' AND cast(archive_id AS long) % 4 = 1")
    B.upsert(spark, root + "/ledger", L.failure_updates(failed, status="PENDING"), now=P.NOW)
    read()
    B.release(spark, root + "/ledger", "run", now=P.NOW)
    read()
    return spark.read.parquet(root + "/sink").groupBy("archive_id").agg(F.count(F.lit(1)).alias("n_times"))


def q_reconcile_archives(spark, sf_dir):
    """A job's archives and ledger after damage: one archive lost, one copied, the rows of a third set back."""
    out = staging_path(spark, "reconcile")
    run = write_chunked_archives(route_chunks(*_chunk_meta(spark, sf_dir), P.SLOTS), out, P.JOB_ID, P.SINK_CAP_BYTES)
    entries = committed_entries(spark, out, run)
    done = L.completion_updates(entries.where(F.col("zip_idx") != P.SET_BACK))
    at = lambda i: os.path.join(out, P.JOB_ID, C.ARCHIVE_NAME_FORMAT % i)
    fsx.copy(at(P.COPIED), at(last_index(out, P.JOB_ID) + 1))  # a name that no archive has
    fsx.remove(at(P.LOST))
    files = list_files(spark, os.path.join(out, P.JOB_ID)).where("path LIKE '%.zip'")
    ledger = L.apply_updates(_current(spark, sf_dir).withColumn("export_status", F.lit("PENDING")), done, now=P.NOW)
    return reconcile(ledger, archive_listing(files))


# ---- inventory, retention and report ---------------------------------------------------

def _inventory(spark, sf_dir):
    return A.inventory_from_events(A.load_table(spark, sf_dir, "events"))


def _tree(spark, sf_dir):
    """The inventory written out as a real (sparse) file tree; returns its root."""
    root = staging_path(spark, "tree")
    materialize_tree(_inventory(spark, sf_dir), root).write.parquet(root + "-created")
    return root


def _relative(df, root):
    return df.withColumn("path", F.substring(F.col("path"), len(root.rstrip("/")) + 1, 1 << 30))


def q_file_inventory(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return _relative(list_files(spark, root), root).select("path", "length", "modificationTime")


def q_inventory_diff(spark, sf_dir):
    """Two listings merged in a store: every path's last row and what the second listing made of it."""
    store, rows = staging_path(spark, "inventory-store"), _inventory(spark, sf_dir).select(
        "path", "length", F.col("mtime").alias("modificationTime"), F.lit(False).alias("is_dir"))
    kind = F.col("length") % 10  # 1: gone, 2: changed, 3: new
    later = rows.where(kind != 1).withColumn("length", F.col("length") + F.when(kind == 2, 1).otherwise(0))
    first = I.commit(spark, store, rows.where(kind != 3), 0)
    second = I.commit(spark, store, later, 0, base=first)
    changes = I.changes_of(spark, store, second.number).drop("is_dir")
    state = I.read(spark, store, second).select("path", "length", "modificationTime").join(changes.select("path", "change"), "path", "left")
    return state.unionByName(changes.where("change = 'gone'"))


def q_retention_plan(spark, sf_dir):
    return retention_plan(_inventory(spark, sf_dir), now=P.RETENTION_NOW, max_age_days=P.MAX_AGE_DAYS) \
        .select("path", "length", "mtime", "age_days")


def q_retention_summary(spark, sf_dir):
    return retention_summary(q_retention_plan(spark, sf_dir))


def q_empty_job_dirs(spark, sf_dir):
    return empty_job_dirs(_inventory(spark, sf_dir), q_retention_plan(spark, sf_dir), "/storage")


def q_retention_apply(spark, sf_dir):
    root = _tree(spark, sf_dir)
    files = snapshot(list_files(spark, root), staging_path(spark, "inventory"))
    plan = retention_plan(files, now=P.RETENTION_NOW, max_age_days=P.MAX_AGE_DAYS,
                          mtime_col="modificationTime")
    out = staging_path(spark, "deleted")
    apply_retention(plan).write.parquet(out)
    return _relative(spark.read.parquet(out), root)


def q_retention_job(spark, sf_dir):
    root = _tree(spark, sf_dir)
    res = run_retention(spark, root + "/storage", RetentionConfig(max_age_days=P.MAX_AGE_DAYS), now=P.RETENTION_NOW)
    removed = res.removed_dirs.agg(F.count_if("removed").alias("dirs_removed"))
    # both inputs are single rows: attach the count as a literal
    return res.summary.withColumn("dirs_removed", F.lit(removed.first()["dirs_removed"]).cast("long"))


def q_total_archive_size(spark, sf_dir):
    return total_archive_size(_inventory(spark, sf_dir), ["job"])


def q_job_report(spark, sf_dir):
    return job_report(_manifest(spark, sf_dir), _inventory(spark, sf_dir), P.REPORT_JOB,
                      "/storage/" + P.REPORT_JOB, P.BASE_URL)


def q_audit_log(spark, sf_dir):
    cur = _current(spark, sf_dir)
    _, rejects = L.split_valid(L.eligible(cur))
    valid, _ = L.split_valid(L.eligible(cur))
    outcomes = AT.outcome_reason(_fold(spark, sf_dir)).join(valid.select("archive_id"), "archive_id", "left_semi")
    failures = L.failure_updates(rejects).unionByName(
        L.failure_updates(outcomes.where(~F.col("fetch_ok"))))
    archived = PK.archive_entries(_numbered(spark, sf_dir), F.lit(P.JOB_ID))
    return audit_events(failures=failures, archived=archived)


def q_audit_sink(spark, sf_dir):
    """The audit log written as one run, written again as a retry would, and read back."""
    root = staging_path(spark, "audit")
    for _ in range(2):
        write_audit(q_audit_log(spark, sf_dir), root, run=P.JOB_ID)
    return read_audit(spark, root).select("channel", "event", "archive_id", "detail")


# ---- streaming ----------------------------------------------------------------------

STREAM_FILES = 4


def q_stream_manifest(spark, sf_dir):
    """orders -> ledger rows -> eligible rows, as an availableNow stream into a Parquet sink."""
    orders = stream_manifest(spark, os.path.join(sf_dir, "orders.parquet"),
                             A.load_table(spark, sf_dir, "orders").schema)
    out = staging_path(spark, "stream_manifest")
    run_available_now(L.eligible(A.manifest_from_orders(orders)), out + "/sink", out + "/checkpoint")
    return spark.read.parquet(out + "/sink")


def q_stream_commit(spark, sf_dir):
    """Completion events streamed into an update log (merge-on-read), then compacted."""
    root = staging_path(spark, "stream_commit")
    write_ledger_snapshot(_current(spark, sf_dir), root + "/ledger", version=1)
    events = A.load_table(spark, sf_dir, "events")
    events.repartition(STREAM_FILES).write.parquet(root + "/input")
    events = stream_manifest(spark, root + "/input", events.schema)  # a batch for every file
    commit_completions(spark, A.completions_from_events(events), root + "/log", root + "/checkpoint", now=P.NOW)
    return read_ledger_snapshot(spark, root + "/ledger", compact(spark, root + "/ledger", root + "/log"))


def _event_stream(spark, sf_dir, root):
    """The completion events as a stream: a micro-batch for each of a few files."""
    events = A.load_table(spark, sf_dir, "events")
    events.repartition(STREAM_FILES).write.parquet(root + "/input")
    return A.completions_from_events(stream_manifest(spark, root + "/input", events.schema))


def q_stream_commit_timed(spark, sf_dir):
    """Completion events committed in lots bounded by size and waiting time, then compacted."""
    root = staging_path(spark, "stream_commit_timed")
    write_ledger_snapshot(_current(spark, sf_dir), root + "/ledger", version=1)
    q = commit_timed(spark, _event_stream(spark, sf_dir, root), root + "/log", root + "/checkpoint", now=P.NOW,
                     batch_size=P.FLUSH_BATCH, interval_seconds=P.COMMIT_SECONDS, lanes=P.LANES)
    drain(q, P.COMMIT_SECONDS)
    return read_ledger_snapshot(spark, root + "/ledger", compact(spark, root + "/ledger", root + "/log"))


def q_stream_progress(spark, sf_dir):
    """Counts kept up from the update log while completion events are committed; the counts in the end."""
    root = staging_path(spark, "stream_progress")
    write_ledger_snapshot(_current(spark, sf_dir), root + "/ledger", version=1)
    commit_completions(spark, _event_stream(spark, sf_dir, root), root + "/log", root + "/checkpoint-log", now=P.NOW)
    stream_progress(spark, read_ledger_snapshot(spark, root + "/ledger", 1), root + "/log", root + "/progress",
                    root + "/checkpoint", groups=P.LANES)
    return progress_now(spark, root + "/progress")


def q_stream_pack(spark, sf_dir):
    """Pack input written as claim-ordered files, streamed one file per trigger through
    the stateful packer: archives continue across micro-batches."""
    root = staging_path(spark, "stream_pack")
    src = root + "/input"
    rows = _pack_input(spark, sf_dir).drop("org_id")
    rows.repartitionByRange(STREAM_FILES, "claim_seq").withColumn("part", F.spark_partition_id()).write.parquet(root + "/parts")
    parts = spark.read.parquet(root + "/parts")
    for i in range(STREAM_FILES):  # the file source takes the oldest file first
        parts.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(src)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_available_now(stream_pack(stream, _CAP), root + "/sink", root + "/checkpoint")
    return spark.read.parquet(root + "/sink")


def q_export_stream(spark, sf_dir):
    """The manifest arrives as claim-ordered files; each micro-batch is exported as it lands."""
    root = staging_path(spark, "export_stream")
    conform_ledger(_manifest(spark, sf_dir)).repartitionByRange(STREAM_FILES, "archive_time", "archive_id") \
        .write.parquet(root + "/incoming")
    run_export_stream(spark, root + "/incoming", _export_cfg(), root + "/out", root + "/checkpoint",
                      content=_content(spark, sf_dir), now=P.NOW)
    return read_stream_ledger(spark, root + "/out", P.JOB_ID)


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
FLAGSHIP = "export_job"
