"""Fetch, archive sink, retention on a real tree."""

import datetime as dt
import os
import tempfile
import zipfile

import pytest

from zipledger.operators.retention import apply_retention, empty_job_dirs, retention_plan, retention_summary
from zipledger.plans.retention import run_retention
from zipledger.schema import RetentionConfig
from zipledger.sinks.archive import write_archives
from zipledger.sources.fetch import fetch_content, resolve_content
from zipledger.sources.inventory import list_files


def test_fetch_retries_and_outcomes(spark):
    calls = {}

    def factory():
        def fetch(url, attempt):
            calls.setdefault(url, []).append(attempt)
            if url.endswith("/ok2") and attempt == 2:
                return 200, b"body", None
            if url.endswith("/net"):
                return None, None, "connection refused"
            if url.endswith("/404"):
                return 404, None, None
            return 503, None, None
        return fetch

    df = spark.createDataFrame([("a", "http://h/ok2"), ("b", "http://h/net"), ("c", "http://h/404")],
                               "archive_id string, url string")
    slept = []
    out = {r["archive_id"]: r for r in fetch_content(df, factory, sleep=slept.append).collect()}
    assert (out["a"]["fetch_ok"], out["a"]["attempts_used"], out["a"]["content"]) == (True, 2, bytearray(b"body"))
    assert (out["b"]["fetch_ok"], out["b"]["http_status"], out["b"]["fetch_error"]) == (False, None,
                                                                                       "connection refused")
    assert (out["c"]["http_status"], out["c"]["attempts_used"]) == (404, 3)


def test_resolve_content(spark):
    df = spark.createDataFrame([("a",), ("b",)], "archive_id string")
    content = spark.createDataFrame([("a", bytearray(b"xyz"))], "archive_id string, content binary")
    out = {r["archive_id"]: r for r in resolve_content(df, content).collect()}
    assert out["a"]["fetch_ok"] and out["a"]["http_status"] == 200
    assert not out["b"]["fetch_ok"] and out["b"]["http_status"] == 404 and out["b"]["attempts_used"] == 3


def test_archive_round_trip_and_idempotence(spark):
    bodies = [(f"id{i}", i // 10 + 1, "job", i, bytes([i % 251]) * (i * 37 % 5000)) for i in range(100)]
    df = spark.createDataFrame(bodies, "archive_id string, zip_idx long, grp string, claim_seq long, content binary")
    out = tempfile.mkdtemp(prefix="zl-sink-")
    for _ in range(2):  # a rerun rewrites the same archives
        rows = write_archives(df, out, group_col="grp").collect()
    assert len(rows) == 10
    files = sorted(os.listdir(os.path.join(out, "job")))
    assert files == [f"emails_{i:04d}.zip" for i in range(1, 11)]
    for zi in range(1, 11):
        with zipfile.ZipFile(os.path.join(out, "job", f"emails_{zi:04d}.zip")) as z:
            names = z.namelist()
            exp = [b for b in bodies if b[1] == zi]
            assert names == [f"{b[0]}.eml" for b in exp]  # claim order inside the archive
            for b in exp:
                assert z.read(f"{b[0]}.eml") == b[4]
            assert all(i.compress_type == zipfile.ZIP_DEFLATED for i in z.infolist())


def _touch(path, when, size=10):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"x" * size)
    ts = int(when.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000) * 1000
    os.utime(path, ns=(ts, ts))


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_retention_tree(spark, scheme):
    """The same tree through the POSIX walk (plain path) and through pyarrow.fs (a URI)."""
    root = tempfile.mkdtemp(prefix="zl-ret-")
    now = dt.datetime(2024, 1, 31)
    cutoff = now - dt.timedelta(days=7)
    old = cutoff - dt.timedelta(days=1)
    _touch(f"{root}/j1/a.zip", cutoff)                                   # equal to cutoff: kept
    _touch(f"{root}/j1/b.zip", cutoff - dt.timedelta(microseconds=1))    # 1 us older: deleted
    _touch(f"{root}/j2/c.ZIP", old)                                      # .ZIP: kept by retention
    _touch(f"{root}/j3/a.zip/b", old)                                    # extension '' : kept
    _touch(f"{root}/j4/sub/x.db", old)                                   # emptied subdir keeps j4
    _touch(f"{root}/j5/only.zip", old)                                   # emptied: j5 removed
    os.makedirs(f"{root}/j6")                                            # never populated: removed
    os.makedirs(f"{root}/j7/empty-sub")                                  # holds an empty subdirectory: kept
    _touch(f"{root}/top.db", old)                                        # file directly in root
    dry = run_retention(spark, scheme + root, RetentionConfig(dry_run=True), now=now)
    assert dry.summary.first()["files"] == 4 and os.path.exists(f"{root}/j5/only.zip")
    res = run_retention(spark, scheme + root, RetentionConfig(), now=now)
    s = res.summary.first()
    assert (s["files"], s["bytes"], s["errors"], s["gb_freed"]) == (4, 40, 0, "0.00")
    assert sorted(os.listdir(root)) == ["j1", "j2", "j3", "j4", "j7"]
    assert res.removed_dirs.where("not removed").count() == 0
    assert os.listdir(f"{root}/j1") == ["a.zip"] and os.path.isdir(f"{root}/j4/sub")


def test_retention_plan_operators(spark):
    inv = spark.createDataFrame([("/s/j1/a.zip", 5, dt.datetime(2020, 1, 1)), ("/s/j1/b.log", 5, dt.datetime(2020, 1, 1)),
                                 ("/s/j2/c.db", 7, dt.datetime(2030, 1, 1))], "path string, length long, mtime timestamp_ntz")
    plan = retention_plan(inv, now="2024-01-31 00:00:00")
    assert [r["path"] for r in plan.collect()] == ["/s/j1/a.zip"]
    assert [r["path"] for r in empty_job_dirs(inv, plan, "/s").collect()] == []
    assert retention_summary(plan).first()["bytes"] == 5


def test_failed_delete_counts_only_as_error(spark):
    root = tempfile.mkdtemp(prefix="zl-del-")
    _touch(f"{root}/j/a.zip", dt.datetime(2020, 1, 1), size=3)
    os.makedirs(f"{root}/j/dir.zip")                       # removing a directory as a file fails
    plan = spark.createDataFrame([(f"{root}/j/a.zip", 3), (f"{root}/j/dir.zip", 9), (f"{root}/j/gone.zip", 4)],
                                 "path string, length long")
    res = {r["path"].rsplit("/", 1)[-1]: r for r in apply_retention(plan).collect()}
    assert res["a.zip"]["deleted"] and res["gone.zip"]["deleted"]   # already missing = done
    assert not res["dir.zip"]["deleted"] and res["dir.zip"]["error"]
    s = retention_summary(spark.createDataFrame(list(res.values()))).first()
    assert (s["files"], s["bytes"], s["errors"]) == (2, 7, 1)


def test_list_files_skips_nothing(spark):
    root = tempfile.mkdtemp(prefix="zl-list-")
    _touch(f"{root}/a/.hidden.zip", dt.datetime(2024, 1, 1))
    _touch(f"{root}/a/b/c.zip", dt.datetime(2024, 1, 2))
    got = list_files(spark, root, include_dirs=True).collect()
    paths = sorted((r["path"][len(root):], r["is_dir"]) for r in got)
    assert paths == [("/a", True), ("/a/.hidden.zip", False), ("/a/b", True), ("/a/b/c.zip", False)]
    t = {r["path"][len(root):]: r["modificationTime"] for r in got}
    assert t["/a/b/c.zip"] == dt.datetime(2024, 1, 2)


def test_request_build_error_is_not_retried(spark):
    from zipledger.operators.attempts import outcome_reason
    from zipledger.sources.fetch import http_fetcher_factory
    df = spark.createDataFrame([("a", "nota-url")], "archive_id string, url string")
    slept = []
    out = fetch_content(df, http_fetcher_factory("k"), sleep=slept.append)
    r = outcome_reason(out).first()
    assert (r["fetch_ok"], r["attempts_used"], r["failure_kind"]) == (False, 1, "request")
    assert r["error_log"].startswith("Request build error: ") and slept == []


def test_protect_and_audit(spark):
    from zipledger.operators.report import audit_events
    from zipledger.sinks.audit import read_audit, write_audit
    inv = spark.createDataFrame([("/s/j1/a.zip",), ("/s/j2/b.zip",)], "path string")
    gone = inv
    assert sorted(r[0] for r in empty_job_dirs(inv, gone, "/s", protect=["j2"]).collect()) == ["/s/j1"]
    fails = spark.createDataFrame([("x", "Parse error: invalid archive location format")], "archive_id string, error_log string")
    done = spark.createDataFrame([("y", "job/emails_0001.zip")], "archive_id string, archive_path string")
    d = tempfile.mkdtemp()
    events = audit_events(failures=fails, archived=done)
    for run in ("r1", "r1", "r2"):  # a repeated run adds no rows
        write_audit(events, d + "/audit", run)
    assert sorted(n for n in os.listdir(d + "/audit") if n.startswith("channel=")) == ["channel=errors",
                                                                                 "channel=process"]
    got = sorted((r["run"], r["channel"], r["archive_id"]) for r in read_audit(spark, d + "/audit").collect())
    assert got == [(run, c, i) for run in ("r1", "r2") for c, i in (("errors", "x"), ("process", "y"))]


def test_listing_rounds(spark, monkeypatch):
    """Wide and deep trees: every entry once, portions of a fixed size, vanished entries as error rows."""
    import pandas as pd
    from zipledger.sources import inventory
    root = tempfile.mkdtemp()
    os.makedirs(root + "/wide")
    deep = root + "/a/b/c/d/e/f/g"
    os.makedirs(deep)
    for i in range(25_000):
        open(f"{root}/wide/{i}", "w").close()
    open(deep + "/leaf", "w").close()
    for base in (root, "file://" + root):
        paths = [r[0] for r in list_files(spark, base).select("path").collect()]
        assert len(paths) == len(set(paths)) == 25_001 and base + "/a/b/c/d/e/f/g/leaf" in paths
        assert list_files(spark, base, include_dirs=True).where("is_dir").count() == 8
    parts = list(inventory._list_level(iter([pd.DataFrame({"path": [root + "/wide", root + "/gone"]})])))
    assert max(map(len, parts)) <= 10_000 and sum(map(len, parts)) == 25_001
    last = parts[-1].iloc[-1]
    assert last["path"] == root + "/gone" and last["error"]


def test_http_fetcher_network_failure(spark):
    """The real HTTP fetcher against a closed local port (nothing listens; no server is started)."""
    from zipledger.operators.attempts import outcome_reason
    from zipledger.sources.fetch import http_fetcher_factory
    df = spark.createDataFrame([("a", "http://127.0.0.1:1/archive/read/o/d/2026-01-01/a")], "archive_id string, url string")
    slept = []
    r = outcome_reason(fetch_content(df, http_fetcher_factory("k", timeout=2), sleep=slept.append)).first()
    assert (r["fetch_ok"], r["attempts_used"], r["http_status"], r["failure_kind"]) == (False, 3, None, "network")
    assert r["error_log"].startswith("Network error after 3 attempts: ")
    assert r["fetch_error"]


def test_list_files_hadoop_matches_walk(spark):
    from zipledger.sources.inventory import list_files_hadoop
    root = tempfile.mkdtemp(prefix="zl-hl-")
    _touch(f"{root}/a/x.zip", dt.datetime(2024, 1, 1, 12), size=7)
    _touch(f"{root}/a/b/y.db", dt.datetime(2024, 1, 2, 12), size=3)
    walk = sorted((r["path"], r["length"], r["modificationTime"]) for r in list_files(spark, root).collect())
    hadoop = sorted((r["path"], r["length"], r["modificationTime"]) for r in list_files_hadoop(spark, root).collect())
    assert hadoop == walk and len(walk) == 2


def test_resolve_content_collapses_copies(spark):
    df = spark.createDataFrame([("a",), ("b",)], "archive_id string")
    content = spark.createDataFrame([("a", bytearray(b"xyz"))] * 50 + [("b", bytearray(b"q"))],
                                    "archive_id string, content binary")
    out = resolve_content(df, content).collect()
    assert sorted((r["archive_id"], bytes(r["content"])) for r in out) == [("a", b"xyz"), ("b", b"q")]


def test_tree_writer_makes_a_folder_once(tmp_path, monkeypatch):
    import pandas as pd

    from zipledger.plans import retention
    calls, make = [], os.makedirs
    monkeypatch.setattr(os, "makedirs", lambda d, exist_ok=False: (calls.append(d), make(d, exist_ok=exist_ok)))
    paths = [f"/j{i % 2}/f{i}" for i in range(20)]
    naive = pd.DataFrame({"path": paths, "length": [i if i else None for i in range(20)], "mtime": pd.Timestamp("2024-01-02 03:04:05.000007")})
    aware = naive.assign(path=naive["path"] + "x", mtime=pd.Timestamp("2024-01-02 05:04:05.000007", tz="Europe/Helsinki"))
    got = [p for frame in retention.tree_writer(str(tmp_path), "mtime")(iter([naive, aware])) for p in frame["path"]]
    assert got == [str(tmp_path) + p for p in paths] + [str(tmp_path) + p + "x" for p in paths]
    assert sorted(calls) == [str(tmp_path / "j0"), str(tmp_path / "j1")]
    at = pd.Timestamp("2024-01-02 03:04:05.000007").value
    for i, p in enumerate(paths):
        for q in (p, p + "x"):
            st = os.stat(str(tmp_path) + q)
            assert (st.st_size, st.st_mtime_ns) == (i, at)
