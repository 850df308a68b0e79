"""Chunked bodies: cut, fetched in blocks, written by the data source, read back."""

import hashlib
import os
import pickle
import time
import tracemalloc
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zipledger.operators import packing as PK
from zipledger.sinks import fs as fsx
from zipledger.sinks import zip_source as Z
from zipledger.sinks.archive import read_archives
from zipledger.sources import chunks as CH
from zipledger.sources.fetch import RequestBuildError

CONTENT = "archive_id string, content binary"


def _routed(spark, bodies, slots=3, chunk=7, by_hash=True, cap=1 << 40, declared=1):
    content = spark.createDataFrame(bodies, CONTENT)
    meta = content.select("archive_id").distinct().where("archive_id <> 'unclaimed'").select("archive_id", F.lit(declared).cast("long").alias("declared"))
    return Z.route_chunks(meta, CH.chunk_bodies(content, chunk), slots, by_hash=by_hash)


def _back(spark, out, run):
    found = read_archives(Z.committed_archives(spark, out, run), out).collect()
    return {r.archive_id: (r.content_bytes, r.content_md5) for r in found}, len(found)


def _copy(spark, body):
    return spark.createDataFrame([("i", body)], CONTENT).select(F.xxhash64("content")).first()[0]


def _want(bodies):
    return {i: (len(b), hashlib.md5(b).hexdigest()) for i, b in bodies}


def test_chunks_rejoin_to_the_bodies(spark):
    bodies = [("a", b""), ("b", None), ("c", b"0123456"), ("d", b"01234567"), ("e", os.urandom(100)), ("e2", bytes(50)), ("f", b"x"), ("f", b"x"),
              ("g", b"one"), ("g", b"other"), (None, b"nobody's")]
    rows = CH.chunk_bodies(spark.createDataFrame(bodies, CONTENT), 7).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.archive_id or "", r.copy, r.chunk_no)):
        found.setdefault(r.archive_id, []).append((r.chunk_no, bytes(r.chunk)))
    assert found["a"] == [(0, b"")] and "b" not in found and found["c"] == [(0, b"0123456")]
    assert found["d"] == [(0, b"0123456"), (1, b"7")] and found["f"] == [(0, b"x")] * 2
    assert b"".join(c for _, c in found["e"]) == bodies[4][1] and len(found["e"]) == 15
    assert sorted(found["g"]) == [(0, b"one"), (0, b"other")]
    assert CH.chunk_bodies(spark.createDataFrame([], CONTENT)).count() == 0


def test_written_bodies_read_back(spark, tmp_path):
    out = str(tmp_path / "o")
    bodies = [(f"id{i}", os.urandom(i * 37 % 400)) for i in range(60)] + [("big", os.urandom(3 << 20))]
    two = sorted((os.urandom(2500), os.urandom(3100)), key=lambda b: _copy(spark, b))      # the smaller hash counts
    bodies.append(("two", two[0]))
    rows = _routed(spark, [*bodies, bodies[5], bodies[60], ("two", two[1]), ("x" * 70000, b"no ZIP name"), ("missing", None), ("unclaimed", b"zz")], chunk=1000)
    run = Z.write_chunked_archives(rows, out, "job", cap=4000)
    found, entries = _back(spark, out, run)
    assert found == _want(bodies) and entries == 62
    assert [len(r.archive_id) for r in Z.failed_entries(spark, out, run).collect()] == [70000]
    listed = {r.archive_id: (r.bytes, r.archive_path) for r in Z.committed_entries(spark, out, run).collect()}
    assert {i: b for i, (b, _) in listed.items()} == {i: len(b) for i, b in bodies}
    for rel in {p for _, p in listed.values()}:
        with zipfile.ZipFile(os.path.join(out, rel)) as z:
            assert z.testzip() is None and sorted(z.namelist()) == sorted(f"{i}.eml" for i, (_, p) in listed.items() if p == rel)
    again = Z.write_chunked_archives(_routed(spark, bodies[:5]), out, "job", cap=4000)     # numbering goes on
    names = [r.archive_path for run in (run, again) for r in Z.committed_archives(spark, out, run).collect()]
    assert names == [f"job/emails_{i:04d}.zip" for i in range(1, len(names) + 1)]
    assert sorted(os.listdir(os.path.join(out, "job"))) == [n.split("/")[1] for n in names]
    assert os.listdir(os.path.join(out, ".staging")) == []


def test_bodies_over_the_arrow_batch_bound(spark, tmp_path):
    """The body is many times an Arrow batch: it reaches the writer in several."""
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "4")
    try:
        bodies = [("a", os.urandom(200_000)), ("b", os.urandom(10)), ("c", os.urandom(70_000))]
        out = str(tmp_path / "o")
        run = Z.write_chunked_archives(_routed(spark, bodies, slots=1, chunk=1000), out, "job", cap=1 << 30)
        assert _back(spark, out, run) == (_want(bodies), 3)
    finally:
        spark.conf.set(key, old)


def test_writer_memory_is_flat(tmp_path):
    packer = Z._Packer(str(tmp_path / "s"), 1 << 60, False, 1)
    packer.row(0, "huge", None, -1, None, 1, None)
    chunk = os.urandom(1 << 20)
    tracemalloc.start()
    for i in range(200):
        packer.row(0, "huge", 7, i, None, None, chunk)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert packer.close().archives[0][3:] == (1, 200 << 20) and peak < 16 << 20


def test_packing_follows_the_state_machine(spark, tmp_path):
    out = str(tmp_path / "o")
    sizes = [(i * 7919) % 90 for i in range(80)]
    bodies = [(f"id{i:03d}", bytes(n)) for i, n in enumerate(sizes)]
    content = spark.createDataFrame(bodies, CONTENT)
    meta = spark.createDataFrame([(f"id{i:03d}", i % 3, i + 1, (n * 3) % 120, f"g{i % 2}") for i, n in enumerate(sizes)],
                                 "archive_id string, slot int, claim_seq long, declared long, grp string")
    for rotate in (False, True):
        run = Z.write_chunked_archives(Z.route_chunks(meta, CH.chunk_bodies(content, 10), 3), out, f"r{rotate}", cap=150, rotate=rotate)
        packed = PK.pack_next_fit(meta.join(content.select("archive_id", F.octet_length("content").cast("long").alias("actual")), "archive_id"),
                                  150, mode="rotate" if rotate else "slot", group_col="grp")
        numbered = PK.number_archives(packed, ["slot"], start=0)
        assert {r.archive_id: r.zip_idx for r in Z.committed_entries(spark, out, run).collect()} == {r.archive_id: r.zip_idx for r in numbered.collect()}


def test_failed_job_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "o")

    def broken(batches):
        for i, batch in enumerate(batches):
            yield batch
            raise RuntimeError("lost")

    rows = _routed(spark, [(f"id{i}", os.urandom(500)) for i in range(50)], chunk=50)
    with pytest.raises(Exception, match="lost"):
        Z.write_chunked_archives(rows.mapInArrow(broken, rows.schema), out, "job", cap=2000)
    assert not os.path.exists(os.path.join(out, "job")) and Z.committed_runs(out) == []
    left = None
    for _ in range(50):  # tasks of the aborted job may still be ending
        left = [f for _, _, names in os.walk(out) for f in names]
        if not left:
            break
        time.sleep(0.2)
    assert left == []


def _batch(rows):
    names = ("slot", "ord", "archive_id", "copy", "chunk_no", "grp", "declared", "chunk")
    types = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def test_dead_attempts_and_dead_drivers(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    w = Z._Writer({"path": out, "folder": "job", "run": "r1", "cap": "100"})
    rows = [(0, 0, "a", None, -1, None, 1, None), (0, 0, "a", 5, 0, None, None, b"body")]
    w.write(iter([_batch(rows)]))                                        # an attempt whose message never came
    message = w.write(iter([_batch(rows)]))
    give = Z._give_names
    monkeypatch.setattr(Z, "_give_names", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):                               # the driver dies between manifest and names
        w.commit([message, None])
    monkeypatch.setattr(Z, "_give_names", give)
    fsx.write_text(os.path.join(out, ".staging", "dead", "x.zip"), "half")    # and another died before its manifest
    assert Z.finish_commits(out) == ["r1"]
    assert os.listdir(os.path.join(out, "job")) == ["emails_0001.zip"] and os.listdir(os.path.join(out, ".staging")) == []
    assert _back(spark, out, "r1") == (_want([("a", b"body")]), 1)
    with pytest.raises(FileExistsError):
        w.commit([message])


def test_empty_write(spark, tmp_path):
    out = str(tmp_path / "o")
    run = Z.write_chunked_archives(_routed(spark, [("missing", None)]), out, "job", cap=10)
    assert Z.committed_archives(spark, out, run).count() == 0 and Z.committed_entries(spark, out, run).count() == 0


# -- fetching ------------------------------------------------------------------------------------

def _streamer():
    def stream(url, attempt):
        i = int(url.rsplit("/", 1)[1])
        if i % 7 == 6:
            raise RequestBuildError("no request")
        if i % 7 == 5:
            return 503, None, None
        if i % 7 == 4:
            return None, None, "timeout"

        def blocks():
            for n in range(i % 5):
                if i % 7 == 3 and attempt < 3 and n == 1:
                    raise OSError("broken off")
                yield bytes([attempt, n]) * 10

        return 200, blocks(), None

    return stream


def test_fetch_keeps_only_the_whole_attempt(spark, tmp_path):
    df = spark.range(140).select(F.col("id").cast("string").alias("archive_id"), F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"))
    CH.fetch_chunks(df, lambda: _streamer(), concurrency=8, threads_per_task=3, batch_bytes=64, sleep=lambda s: None).write.parquet(str(tmp_path / "f"))
    staged = spark.read.parquet(str(tmp_path / "f"))
    outcomes = {int(r.archive_id): r for r in CH.fetched_outcomes(staged).collect()}
    chunks = {}
    for r in CH.fetched_chunks(staged).collect():
        chunks.setdefault(int(r.archive_id), {})[r.chunk_no] = bytes(r.chunk)
    assert len(outcomes) == 140 and set(CH.fetched_chunks(staged).columns) == {"archive_id", "copy", "chunk_no", "chunk"}
    for i, r in outcomes.items():
        kind, parts = i % 7, i % 5
        if kind < 4:
            used = 3 if kind == 3 and parts > 1 else 1
            assert (r.fetch_ok, r.attempts_used, r.http_status) == (True, used, 200)
            assert chunks[i] == ({n: bytes([used, n]) * 10 for n in range(parts)} or {0: b""})
        else:
            assert not r.fetch_ok and i not in chunks
            assert (r.attempts_used, r.http_status, r.fetch_error, r.failure_kind) == {
                4: (3, None, "timeout", "network"), 5: (3, 503, None, "api"), 6: (1, None, "no request", "request")}[kind]


class _Answer:
    def __init__(self, parts, status=200):
        self.parts, self.status = list(parts), status

    def read(self, n=None):
        return self.parts.pop(0) if self.parts else b""


class _Connection:
    made: list = []

    def __init__(self, host, port, timeout):
        self.made.append(self)
        self.host, self.served, self.closed = host, 0, False

    def request(self, method, path, headers):
        if self.closed or (self.host == "short" and self.served == 1):
            raise ConnectionResetError("gone")
        self.path, self.key = path, headers
        self.served += 1

    def getresponse(self):
        return _Answer([b"part", self.path.encode()], 404 if "none" in self.path else 200)

    def close(self):
        self.closed = True


def test_connections_are_kept_for_each_host():
    _Connection.made.clear()
    fetch = CH.http_streamer_factory("key", connect=_Connection)()
    get = lambda url: (lambda s, b, e: (s, b"".join(b) if b else None, e))(*fetch(url, 1))
    assert [get(f"http://long/{i}?q=1") for i in range(3)] == [(200, f"part/{i}?q=1".encode(), None) for i in range(3)]
    assert get("http://long/none") == (404, None, None) and len(_Connection.made) == 1
    assert [get(f"http://short:81/{i}")[0] for i in range(3)] == [200] * 3 and len(_Connection.made) == 4   # reopened when the server closed it
    _, blocks, _ = fetch("http://long/cut", 1)
    next(blocks)
    blocks.close()                                                       # broken off: the connection isn't used again
    assert _Connection.made[0].closed and get("http://long/x")[0] == 200 and len(_Connection.made) == 5
    for bad in ("ftp://x/1", "http:///1", "http://h:99999999/1"):
        with pytest.raises(RequestBuildError):
            fetch(bad, 1)


def test_export_by_chunks_and_numbers_from_the_record(spark, tmp_path, monkeypatch):
    """The job with a streamer and with a content table too big to prune by its ids; a second job lists no names."""
    from zipledger.plans import export as X
    from zipledger.schema import LEDGER, ExportConfig

    def ledger(lo, hi):
        rows = spark.range(lo, hi).selectExpr(
            "cast(id as string) as archive_id", "timestamp_ntz'2024-01-01' as archive_time", "concat('h:o', id % 2, ':d:2024:', id) as archive_location",
            "10L as raw_eml_size", "'PENDING' as export_status", "cast(null as timestamp_ntz) as updated_at", "cast(null as string) as error_log",
            "0 as retries")
        return spark.createDataFrame(rows.rdd, LEDGER)

    cfg, out = ExportConfig(job_id="j", workers=4, zip_slots=2), str(tmp_path)
    first = X.run_export(spark, ledger(0, 70), cfg, out, streamer_factory=lambda: _streamer(), sleep=lambda s: None, now="2026-01-01 00:00:00")
    state = {int(r.archive_id): (r.export_status, r.error_log) for r in first.ledger.collect()}
    for i, (status, reason) in state.items():
        want = {4: "Network error after 3 attempts: timeout", 5: "API returned status 503 after 3 attempts", 6: "Request build error: no request"}.get(i % 7)
        assert (status, reason) == (("FAILED", want) if want else ("COMPLETED", None))
    n = first.archives.count()
    monkeypatch.setattr(X, "PRUNE_BYTES", -1)
    monkeypatch.setattr(X.fsx, "list_dir", lambda path, **k: (_ for _ in ()).throw(AssertionError(path)) if path.endswith("/j") else _LIST(path, **k))
    body = spark.range(1000).selectExpr("cast(id as string) as archive_id", "cast(repeat('b', cast(id as int)) as binary) as content")
    again = X.run_export(spark, ledger(500, 560), cfg, out, content=body, now="2026-01-01 00:00:00")
    assert again.start_index == n and again.report.first().completed == 60
    found = read_archives(again.archives, out).collect()
    assert {int(r.archive_id): r.content_bytes for r in found} == {i: i for i in range(500, 560)}


_LIST = fsx.list_dir


def test_reading_back_is_dealt_over_tasks(spark, tmp_path):
    """A short list of names doesn't put all archives into one task."""
    names = [(f"a{i}.zip",) for i in range(40)]
    for (n,) in names:
        with zipfile.ZipFile(tmp_path / n, "w") as z:
            z.writestr(n + ".eml", n)
    back = read_archives(spark.createDataFrame(names, "archive_path string").repartition("archive_path"), str(tmp_path))
    back = back.select("archive_path", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.archive_path for r in back) == sorted(n for n, in names)
    assert len({r.task for r in back}) > 1


def test_names_are_given_once_and_a_missing_folder_is_an_error(tmp_path):
    (tmp_path / "a").write_text("a")
    pairs = [(str(tmp_path / "a"), str(tmp_path / "b")), (str(tmp_path / "moved"), str(tmp_path / "c"))]
    fsx.move_left(pairs)
    fsx.move_left(pairs)
    assert (tmp_path / "b").read_text() == "a" and not (tmp_path / "c").exists()
    with pytest.raises(FileNotFoundError):
        fsx.move_left([(str(tmp_path / "b"), str(tmp_path / "none" / "b"))])


def test_sizes_of_archives_come_from_the_tasks(tmp_path):
    packer = Z._Packer(str(tmp_path), 1 << 20, False, None)
    packer.row(0, "1", None, -1, None, 5, None)
    packer.row(0, "1", 7, 0, None, None, b"hello")
    written = packer.close()
    (slot, k, path, n, size), = written.archives
    assert (n, size, written.sizes) == (1, 5, [os.path.getsize(path)])


def _items(slot, ids, declared=200):
    """Items that each get an archive of their own under a cap of 100."""
    rows = []
    for ord_, i in enumerate(ids):
        rows += [(slot, ord_, i, None, -1, None, declared, None), (slot, ord_, i, 5, 0, None, None, b"body " + i[:9].encode())]
    return rows


def test_the_driver_holds_no_record_of_an_archive(spark, tmp_path):
    """Messages and manifest are as long for a thousand archives as for ten; the archives and entries come from the tasks' lists."""
    long = {}
    for n in (10, 1000):
        out = str(tmp_path / f"o{n}")
        w = Z._Writer({"path": out, "folder": "job", "run": "r", "cap": "100"})
        messages = [w.write(iter([_batch(_items(slot, [f"{slot}-{i}" for i in range(n)]))])) for slot in (1, 0)]
        long[n] = [len(pickle.dumps(m)) for m in messages]
        w.commit(messages)
        long[n].append(len(fsx.read_text(os.path.join(out, "_archives", "r.json"))))
        names = [f"job/emails_{i:04d}.zip" for i in range(1, 2 * n + 1)]
        assert [(r.zip_idx, r.archive_path, r.entries) for r in Z.committed_archives(spark, out, "r").collect()] == [(i, p, 1) for i, p in enumerate(names, 1)]
        assert sorted(os.listdir(os.path.join(out, "job"))) == sorted(p[4:] for p in names) and Z.last_index(out, "job") == 2 * n
        assert {r.archive_id: r.zip_idx for r in Z.committed_entries(spark, out, "r").collect()} == {
            f"{slot}-{i}": slot * n + i + 1 for slot in (0, 1) for i in range(n)}
    assert all(b - a < 20 for a, b in zip(long[10], long[1000], strict=True))


def test_names_cut_short_are_finished(spark, tmp_path, monkeypatch):
    """A driver that dies among the names: those given stay, the rest are given later; an archive without an entry takes no number."""
    out = str(tmp_path / "o")
    w = Z._Writer({"path": out, "folder": "job", "run": "r", "cap": "100"})
    ids = [f"a{i}" for i in range(6)] + ["x" * 70000] + [f"b{i}" for i in range(5)]
    two = [w.write(iter([_batch(_items(0, some))])) for some in (ids, ["c0", "c1"])]     # one slot, by two tasks
    monkeypatch.setattr(Z, "MOVES", 2)
    move, left = fsx.move_left, [3]

    def dying(pairs):
        left[0] -= 1
        if left[0] < 0:
            raise KeyboardInterrupt
        move(pairs)

    monkeypatch.setattr(fsx, "move_left", dying)
    with pytest.raises(KeyboardInterrupt):
        w.commit(two)
    monkeypatch.setattr(fsx, "move_left", move)
    assert Z.finish_commits(out) == ["r"] and Z.finish_commits(out) == []
    want = [i for i in ids if len(i) < 9] + ["c0", "c1"]
    assert {r.archive_id: r.zip_idx for r in Z.committed_entries(spark, out, "r").collect()} == {i: n for n, i in enumerate(want, 1)}
    for n, i in enumerate(want, 1):
        with zipfile.ZipFile(os.path.join(out, "job", f"emails_{n:04d}.zip")) as z:
            assert z.namelist() == [f"{i}.eml"]
    assert len(os.listdir(os.path.join(out, "job"))) == len(want) and os.listdir(os.path.join(out, ".staging")) == []
    assert [len(r.archive_id) for r in Z.failed_entries(spark, out, "r").collect()] == [70000]


def test_a_discarded_attempt_leaves_no_file(tmp_path, monkeypatch):
    monkeypatch.setattr(Z, "LIST_BATCH", 3)
    packer = Z._Packer(str(tmp_path), 100, False, None)
    for row in _items(0, [f"a{i}" for i in range(8)]) + _items(4, [f"b{i}" for i in range(8)]):
        packer.row(row[0], *row[2:])
    assert len(os.listdir(tmp_path)) == 18
    packer.discard()
    assert os.listdir(tmp_path) == []
