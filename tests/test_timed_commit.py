"""Commits bounded by size and waiting time, and progress kept up from the update log."""

import json
import random
import time

from pyspark.sql import functions as F

from zipledger.operators import ledger as L
from zipledger.schema import LEDGER
from zipledger.streaming import timed_commit as TC
from zipledger.streaming.commit import LOG_SCHEMA, read_update_log

NOW = "2026-01-01 00:00:00"
IDS = "archive_id string"


def _stream(spark, path):
    return spark.readStream.schema(IDS).option("maxFilesPerTrigger", 1).parquet(path)


def _feed(q, n):
    """Wait for the batch that read row n, and stop. (``processAllAvailable`` would wait for ever: timers keep batches coming.)"""
    until = time.time() + 60
    while sum(p["numInputRows"] for p in q.recentProgress) < n:
        assert time.time() < until and q.exception() is None
        time.sleep(0.1)
    q.stop()


def test_commits_are_bounded_and_lose_nothing(spark, tmp_path):
    src, at = str(tmp_path / "in"), str(tmp_path / "cp")
    ids = [f"i{i}" for i in range(230)] + ["i0", "i0"]          # repeats are rows like others
    spark.createDataFrame([(i,) for i in ids], IDS).coalesce(1).write.parquet(src)
    out = []

    def keep(batch, batch_id):
        out.extend((batch_id, *r) for r in batch.collect())

    interval = 2
    q = TC.timed_commits(_stream(spark, src), batch_size=40, interval_seconds=interval, lanes=2).writeStream \
        .outputMode("update").option("checkpointLocation", at).trigger(processingTime="500 milliseconds").foreachBatch(keep).start()
    TC.drain(q, interval, timeout_seconds=120)
    assert sorted(r[1] for r in out) == sorted(ids)             # also what was left when the source went quiet
    commits = {}
    for batch_id, aid, lane, number, waited in out:
        commits.setdefault((lane, number), []).append((batch_id, waited))
    for rows in commits.values():
        assert len(rows) <= 40 and len(set(rows)) == 1          # one commit: one micro-batch
    full = [k for k, v in commits.items() if len(v) == 40]
    assert len(full) >= 4 and all(commits[k][0][1] == 0 for k in full)
    timed = [v[0][1] for k, v in commits.items() if len(v) < 40]
    # by its timer, at the first trigger after it (a trigger takes some seconds on a slow machine)
    assert timed and all(interval * 1000 <= w < interval * 1000 + 10_000 for w in timed)
    for lane in {k[0] for k in commits}:
        assert sorted(n for la, n in commits if la == lane) == list(range(sum(1 for k in commits if k[0] == lane)))


def test_restart_goes_on_with_waiting_ids(spark, tmp_path):
    src, at, log = (str(tmp_path / x) for x in ("in", "cp", "log"))
    spark.createDataFrame([(f"a{i}",) for i in range(5)], IDS).coalesce(1).write.parquet(src)
    q = TC.commit_timed(spark, _stream(spark, src), log, at, now=NOW, batch_size=100, interval_seconds=600, lanes=2)
    _feed(q, 5)
    assert not (tmp_path / "log").exists()                      # five ids wait; a trigger without a commit leaves nothing
    spark.createDataFrame([(f"b{i}",) for i in range(200)], IDS).coalesce(1).write.mode("append").parquet(src)
    q = TC.commit_timed(spark, _stream(spark, src), log, at, now=NOW, batch_size=20, interval_seconds=600, lanes=2)
    _feed(q, 200)
    got = {r.archive_id for r in read_update_log(spark, log).collect()}
    assert {f"a{i}" for i in range(5)} <= got and 205 - len(got) < 2 * 20


def test_a_source_without_rows_drains(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([], IDS).write.parquet(src)
    q = TC.commit_timed(spark, _stream(spark, src), str(tmp_path / "log"), str(tmp_path / "cp"), interval_seconds=1, lanes=2)
    TC.drain(q, 1, timeout_seconds=60)
    assert not (tmp_path / "log").exists()


def test_progress_equals_ledger_after_every_batch(spark, tmp_path):
    log, root, at = (str(tmp_path / x) for x in ("log", "progress", "cp"))
    statuses = [None, "PENDING", "COMPLETED", "FAILED", "PROCESSING"]
    base = spark.createDataFrame([(f"i{i}", None, "l", 1, statuses[i % 5], None, None, 0) for i in range(60)], LEDGER)
    rng, sizes = random.Random(2), []
    for b in range(3):
        rows = [(f"i{rng.randrange(70)}", rng.choice(["COMPLETED", "FAILED", "PENDING", None]), None, b, None) for _ in range(25)]
        rows += rows[:3]                                        # repeated updates count once
        sizes.append(len(rows))
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.parquet(f"{log}/batch_id={b}")
        q = TC.stream_progress(spark, base, log, root, at, groups=4)   # goes on from its checkpoint
        want = L.progress_stats(L.apply_updates(base, read_update_log(spark, log), now=NOW)).first()
        assert TC.progress_now(spark, root).first() == want
        assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [sizes[b]]   # its own rows only
    assert json.loads((tmp_path / "progress" / "start").read_text()) == L.progress_stats(base).first().asDict()


def test_groups_grow_with_the_ledger(spark, tmp_path, monkeypatch):
    """No group holds more than some ids, whatever ``groups`` says, and a later start keeps the number."""
    monkeypatch.setattr(TC, "GROUP_IDS", 10)
    log, root, at = (str(tmp_path / x) for x in ("log", "progress", "cp"))
    base = spark.createDataFrame([(f"i{i}", None, "l", 1, "PENDING", None, None, 0) for i in range(400)], LEDGER)
    for b, given in enumerate((2, 3)):
        ups = [(f"i{i}", "COMPLETED", None, b, None) for i in range(b * 100, b * 100 + 150)]
        spark.createDataFrame(ups, LOG_SCHEMA).coalesce(1).write.parquet(f"{log}/batch_id={b}")
        q = TC.stream_progress(spark, base, log, root, at, groups=given)
        assert TC.progress_now(spark, root).first() == (150 + 100 * b, 0, 400)
        assert json.loads((tmp_path / "progress" / "groups").read_text()) == 40
    held = sum(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress[-1:])
    assert held > 2 * 2   # one value a group; with the two groups asked for there would be two
