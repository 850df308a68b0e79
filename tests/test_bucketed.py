"""Bucketed ledger: shared files, optimistic commits, claims of several runs, recovery."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from zipledger.operators import ledger as L
from zipledger.plans.shared_export import run_shared_export
from zipledger.schema import LEDGER, ExportConfig
from zipledger.sinks import bucketed as B
from zipledger.sinks import fs as fsx

NOW = "2026-01-01 00:00:00"


def _ledger(spark, n, status="PENDING"):
    rows = spark.range(n).select(
        F.format_string("id%05d", "id").alias("archive_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("archive_time"),
        F.concat(F.lit("h:o:d:2024:"), F.col("id").cast("string")).alias("archive_location"), F.lit(10).cast("long").alias("raw_eml_size"),
        F.lit(status).alias("export_status"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.lit(None).cast("string").alias("error_log"), F.lit(0).alias("retries"))
    return spark.createDataFrame(rows.rdd, LEDGER)


def _updates(spark, tmp_path, rows):
    path = str(tmp_path / f"ups-{len(os.listdir(tmp_path))}")
    spark.createDataFrame(rows, B.UPDATE_ROWS).write.parquet(path)
    return spark.read.schema(B.UPDATE_ROWS).parquet(path)


def _state(spark, snap):
    return {r.archive_id: (r.export_status, r.error_log) for r in B.read(spark, snap).collect()}


def test_exclusive_create_has_one_winner(tmp_path):
    path, won = str(tmp_path / "c" / "1.json"), []
    threads = [threading.Thread(target=lambda i=i: won.append((fsx.create_exclusive(path, f"text {i}"), i))) for i in range(16)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winners = [i for ok, i in won if ok]
    assert len(winners) == 1 and fsx.read_text(path) == f"text {winners[0]}"
    assert os.listdir(tmp_path / "c") == ["1.json"]


def test_upsert_rewrites_only_the_ids_buckets(spark, tmp_path):
    root = str(tmp_path / "l")
    first = B.create(_ledger(spark, 500), root, buckets=8)
    rows = [("id00003", "FAILED", "x", 1), ("id00003", "COMPLETED", None, 2), ("nobody", "FAILED", "y", 1)]
    done = B.upsert(spark, root, _updates(spark, tmp_path, rows), now=NOW)
    want = L.apply_updates(_ledger(spark, 500), spark.createDataFrame(rows, B.UPDATE_ROWS), now=NOW)
    assert sorted(map(tuple, B.read(spark, done.snapshot).collect())) == sorted(map(tuple, want.collect()))
    assert 1 <= len(done.rewritten) <= 2 and done.attempts == 1
    assert len(set(first.paths()) & set(done.snapshot.paths())) == 8 - len(done.rewritten)
    assert _state(spark, first)["id00003"] == ("PENDING", None)          # old versions stay readable
    with pytest.raises(FileExistsError):
        B.create(_ledger(spark, 5), root)
    nothing = B.upsert(spark, root, _updates(spark, tmp_path, []), now=NOW)
    assert nothing.rewritten == () and nothing.snapshot.buckets == done.snapshot.buckets


def test_stale_base_loses_no_update(spark, tmp_path):
    root = str(tmp_path / "l")
    base = B.create(_ledger(spark, 300), root, buckets=4)
    everyone = [(f"id{i:05d}", "COMPLETED", None, 1) for i in range(300)]
    a = B.upsert(spark, root, _updates(spark, tmp_path, everyone[::2]), now=NOW, base=base)
    b = B.upsert(spark, root, _updates(spark, tmp_path, everyone[1::2]), now=NOW, base=base)      # all buckets overlap
    assert (a.attempts, b.attempts, b.snapshot.version) == (1, 2, 3)
    assert set(_state(spark, b.snapshot).values()) == {("COMPLETED", None)}
    one = [[("id00001", "FAILED", "e1", 1)], [("id00002", "FAILED", "e2", 1)]]
    for rows in one:                                                                            # disjoint or not: both stay
        last = B.upsert(spark, root, _updates(spark, tmp_path, rows), now=NOW, base=b.snapshot)
    found = _state(spark, last.snapshot)
    assert (found["id00001"], found["id00002"]) == (("FAILED", "e1"), ("FAILED", "e2")) and len(found) == 300


def test_runs_in_parallel_claim_disjoint_rows(spark, tmp_path):
    root, got, errors = str(tmp_path / "l"), {}, []
    B.create(_ledger(spark, 400), root, buckets=4)

    def work(run):
        try:
            while (mine := B.claim(spark, root, run, 60, now=NOW)).path:
                ids = [r.archive_id for r in mine.rows.collect()]
                got.setdefault(run, []).extend(ids)
                B.finish(spark, root, run, mine, L.completion_updates(mine.rows), now=NOW)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(r,)) for r in "ABC"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    every = [i for ids in got.values() for i in ids]
    assert len(every) == len(set(every)) == 400
    last = B.snapshot(root)
    assert set(_state(spark, last).values()) == {("COMPLETED", None)} and last.claims == {}


def test_claims_stand_when_others_commit_elsewhere(spark, tmp_path):
    root = str(tmp_path / "l")
    base = B.create(_ledger(spark, 100), root, buckets=4)
    B.upsert(spark, root, _updates(spark, tmp_path, [(f"id{i:05d}", "FAILED", "gone", 1) for i in range(50, 100)]), now=NOW)
    mine = B.claim(spark, root, "A", 20, now=NOW, base=base)          # same buckets, other ids: nothing is chosen anew
    assert mine.attempts == 2 and sorted(r.archive_id for r in mine.rows.collect()) == [f"id{i:05d}" for i in range(20)]
    found = _state(spark, mine.snapshot)
    assert found["id00000"] == ("PROCESSING", None) and found["id00099"] == ("FAILED", "gone")


def test_released_claims_are_refused_and_others_kept(spark, tmp_path):
    root = str(tmp_path / "l")
    B.create(_ledger(spark, 60), root, buckets=4)
    a, b = B.claim(spark, root, "A", 20, now=NOW), B.claim(spark, root, "B", 20, now=NOW)
    B.release(spark, root, "A", now=NOW)
    found = _state(spark, B.snapshot(root))
    assert [sum(s == x for s, _ in found.values()) for x in ("PENDING", "PROCESSING")] == [40, 20]
    c = B.claim(spark, root, "C", 20, now=NOW)
    assert {r.archive_id for r in c.rows.collect()} == {r.archive_id for r in a.rows.collect()}
    writes = set(os.listdir(root + "/data"))
    with pytest.raises(B.ClaimLost):
        B.finish(spark, root, "A", a, L.completion_updates(a.rows), now=NOW)
    assert set(os.listdir(root + "/data")) == writes
    B.finish(spark, root, "B", b, L.completion_updates(b.rows), now=NOW)
    assert B.release(spark, root, "nobody") is None
    assert set(B.snapshot(root).claims) == {"C"}


def test_expired_versions_leave_the_newest_whole(spark, tmp_path):
    root = str(tmp_path / "l")
    B.create(_ledger(spark, 100), root, buckets=4)
    for i in range(5):
        B.upsert(spark, root, _updates(spark, tmp_path, [(f"id{i:05d}", "COMPLETED", None, 1)]), now=NOW)
    a = B.claim(spark, root, "A", 10, now=NOW)
    before = _state(spark, a.snapshot)
    assert B.expire(root, keep=1) == list(range(1, 7)) and B.versions(root) == [7]
    assert _state(spark, B.snapshot(root)) == before and len(before) == 100
    assert B.held_by(spark, B.snapshot(root), "A").count() == 10


def test_shared_export_recovers_a_run_that_died(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "l"), str(tmp_path / "out")
    B.create(_ledger(spark, 50), root, buckets=4)
    content = spark.range(45).select(F.format_string("id%05d", "id").alias("archive_id"), F.encode(F.lit("body"), "UTF-8").alias("content"))
    cfg = ExportConfig(job_id="j", workers=1, zip_slots=2)
    keep = B.finish
    monkeypatch.setattr(B, "finish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):                              # dies after the job's commit, before the shared one
        run_shared_export(spark, root, cfg, out, "A", claim_rows=20, now=NOW, content=content)
    assert sum(s == "PROCESSING" for s, _ in _state(spark, B.snapshot(root)).values()) == 20
    monkeypatch.setattr(B, "finish", keep)
    other = run_shared_export(spark, root, ExportConfig(job_id="k", workers=1, zip_slots=2), out, "B", claim_rows=10, max_claims=1, now=NOW, content=content)
    again = run_shared_export(spark, root, cfg, out, "A", claim_rows=20, now=NOW, content=content)
    found = _state(spark, again.snapshot)
    assert [sum(s == x for s, _ in found.values()) for x in ("COMPLETED", "FAILED")] == [45, 5]
    entries = sum(r.entries for res in (other, again) for a in res.archives for r in a.collect())
    assert (other.claims, again.claims, entries) == (1, 1, 25) and again.snapshot.claims == {}    # 20 were archived before the crash
