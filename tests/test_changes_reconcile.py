"""Ledger changes as a stream, byte-balanced slots, archives against the ledger."""

import os
import random
import zipfile

from pyspark.sql import functions as F

from zipledger.operators import ledger as L
from zipledger.operators import packing as PK
from zipledger.operators.reconcile import archive_listing, reconcile, repairs
from zipledger.schema import LEDGER
from zipledger.sinks import bucketed as B
from zipledger.streaming.ledger_changes import stream_ledger_changes
from zipledger.streaming.manifest_stream import run_available_now

NOW = "2026-01-01 00:00:00"
STATUSES = [None, "", "  ", "\t", '""', '"', "PENDING", "pending", " PENDING", "PROCESSING", "COMPLETED", "FAILED", " "]


def _ledger(spark, n):
    rows = [(f"i{i}", None, f"loc{i}", i, STATUSES[i % len(STATUSES)], None, None, 0) for i in range(n)]
    return spark.createDataFrame(rows, LEDGER)


def test_changes_are_set_differences(spark, tmp_path):
    root, sink, at = (str(tmp_path / x) for x in ("l", "s", "c"))
    rng, ups = random.Random(4), 0
    snap, seen, runs = B.create(_ledger(spark, 130), root, buckets=8), set(), 0
    for step in range(3):
        run_available_now(stream_ledger_changes(spark, root), sink, at)
        now = {r.archive_id for r in L.eligible(B.read(spark, B.snapshot(root))).collect()}
        got = sorted(r.archive_id for r in spark.read.parquet(sink).collect())
        new = sorted(now - seen)
        runs += len(new)
        assert len(got) == runs and all(got.count(i) >= 1 for i in new)
        seen = now
        for _ in range(2):                                   # two versions between reads: only the net difference counts
            rows = [(f"i{rng.randrange(140)}", rng.choice(["PENDING", "FAILED", "COMPLETED"]), None, 1) for _ in range(25)]
            path = str(tmp_path / f"u{(ups := ups + 1)}")
            spark.createDataFrame(rows, B.UPDATE_ROWS).write.parquet(path)
            B.upsert(spark, root, spark.read.schema(B.UPDATE_ROWS).parquet(path), now=NOW)
    late = stream_ledger_changes(spark, root, starting_version=snap.version)       # a stream that has seen version 1
    run_available_now(late, str(tmp_path / "s2"), str(tmp_path / "c2"))
    first = {r.archive_id for r in L.eligible(B.read(spark, snap)).collect()}
    last = {r.archive_id for r in L.eligible(B.read(spark, B.snapshot(root))).collect()}
    assert {r.archive_id for r in spark.read.parquet(str(tmp_path / "s2")).collect()} == last - first
    run_available_now(late, str(tmp_path / "s2"), str(tmp_path / "c2"))            # nothing new, nothing read again
    assert spark.read.parquet(str(tmp_path / "s2")).count() == len(last - first)


def test_slots_hold_equal_bytes(spark):
    rng = random.Random(6)
    for sizes in ([rng.choice([1, 10, 1000, 50_000]) for _ in range(300)], [0, None, 0], [7], [], [10**15] * 9, [None, 5, -3, 5]):
        rows = spark.createDataFrame([(f"i{i}", i + 1, s) for i, s in enumerate(sizes)], "archive_id string, claim_seq long, declared long").repartition(3)
        got = sorted(PK.assign_slots_by_bytes(rows, 7).collect(), key=lambda r: r.claim_seq)
        assert [r.archive_id for r in got] == [f"i{i}" for i in range(len(sizes))]
        assert [r.slot for r in got] == sorted(r.slot for r in got) and all(0 <= r.slot < 7 for r in got)
        clean = [max(s or 0, 0) for s in sizes]
        held = {}
        for r, s in zip(got, clean, strict=True):
            held[r.slot] = held.get(r.slot, 0) + s
        if sum(clean):
            assert max(held.values()) <= sum(clean) / 7 + max(clean)


def test_reconciliation_finds_and_mends(spark, tmp_path):
    def archive(name, ids):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for i in ids:
                z.writestr(f"{i}.eml", f"body {i}")

    archive("a.zip", ["i10", "i23", "i36", "i5"])            # three COMPLETED, one pending
    archive("b.zip", ["i23", "stranger"])
    archive("empty.zip", [])
    (tmp_path / "torn.zip").write_bytes((tmp_path / "a.zip").read_bytes()[:40])
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in sorted(os.listdir(tmp_path))] + [(str(tmp_path / "gone.zip"),)], "path string")
    listing = archive_listing(paths.repartition(3))
    assert sorted(os.path.basename(r.archive_path) for r in listing.where("error IS NOT NULL").collect()) == ["gone.zip", "torn.zip"]
    assert {(r.archive_id, r.bytes, r.crc) for r in listing.where("archive_path LIKE '%b.zip'").collect()} == {
        (i, len(f"body {i}"), __import__("zlib").crc32(f"body {i}".encode())) for i in ("i23", "stranger")}
    ledger = _ledger(spark, 60)
    found = {r.archive_id: (r.n_archives, r.finding) for r in reconcile(ledger, listing).collect()}
    assert found == {"i10": (1, "ok"), "i23": (2, "duplicate"), "i36": (1, "ok"), "i49": (0, "missing"), "i5": (1, "orphan"), "stranger": (1, "orphan")}
    mended = L.apply_updates(ledger, repairs(reconcile(ledger, listing)), now=NOW)
    after = {r.archive_id: r.finding for r in reconcile(mended, listing).collect()}
    assert after == {"i10": "ok", "i23": "duplicate", "i36": "ok", "i5": "ok", "stranger": "orphan"}
    assert reconcile(ledger.limit(0), listing.limit(0)).count() == 0
    assert archive_listing(paths.limit(0)).count() == 0


def test_directories_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """A short list of archives doesn't put all of them into one task, and a task hands on rows of many archives at once."""
    from zipledger.operators import reconcile as R
    for i in range(200):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as z:
            for j in range(i % 3):
                z.writestr(f"{i}-{j}.eml", b"x")
    (tmp_path / "torn.zip").write_bytes(b"half")
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in os.listdir(tmp_path)], "path string").repartition("path")
    rows = archive_listing(paths).select("archive_id", "error", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.archive_id for r in rows if r.error is None) == sorted(f"{i}-{j}" for i in range(200) for j in range(i % 3))
    assert len(rows) == 200 and len({r.task for r in rows}) > 1
    seen = []
    monkeypatch.setattr(type(paths), "mapInPandas", lambda self, run, schema: seen.append(run) or self)
    monkeypatch.setattr(R, "ENTRY_PORTION", 150)
    archive_listing(paths)
    frames = list(seen[0](iter([__import__("pandas").DataFrame({"path": [str(tmp_path / n) for n in os.listdir(tmp_path)]})])))
    assert [len(f) for f in frames] == [150, 50]
