"""End-to-end invariants of the export job, streaming restarts, and the oracle at sf0.001."""

import os
import tempfile
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zipledger.plans.export import run_export
from zipledger.schema import ExportConfig
from zipledger.sources import adapters as A
from zipledger.sources.fetch import attempt_rule_fetcher_factory


def _inputs(spark):
    m = A.manifest_from_orders(A.load_table(spark, SF_SMALL, "orders"))
    c = A.content_from_documents(A.load_table(spark, SF_SMALL, "documents"))
    return m, c


@pytest.mark.parametrize("rule,mode", [("hash", "slot"), ("round_robin", "slot"), ("hash", "partition"),
                                       ("round_robin", "rotate")])
def test_export_invariants_and_rerun(spark, rule, mode):
    m, c = _inputs(spark)
    out = tempfile.mkdtemp(prefix="zl-exp-")
    cfg = ExportConfig(job_id="j", max_zip_mb=1, batch_size=50, slot_rule=rule, group_mode=mode)
    res = run_export(spark, m, cfg, out, content=c, now="2026-01-01 00:00:00")
    before = {r["archive_id"]: r["export_status"] for r in m.collect()}
    after = {r["archive_id"]: (r["export_status"], r["error_log"]) for r in res.ledger.collect()}
    eligible = {k for k, v in before.items() if v in (None, "", "  ", '""', "PENDING", "PROCESSING")}
    assert all(after[k][0] in ("COMPLETED", "FAILED") for k in eligible)
    assert all(after[k][0] == before[k] for k in before if k not in eligible)
    completed = {k for k, v in after.items() if v[0] == "COMPLETED" and k in eligible}
    seen = {}
    for d, _, names in os.walk(os.path.join(out, "j")):
        for z in names:
            if z.endswith(".zip"):
                with zipfile.ZipFile(os.path.join(d, z)) as f:
                    for n in f.namelist():
                        seen[n[:-4]] = seen.get(n[:-4], 0) + 1
    assert set(seen) == completed and set(seen.values()) == {1}
    docs = {r["archive_id"]: bytes(r["content"]) for r in c.collect()}
    some = sorted(completed)[0]
    entry = res.entries.where(F.col("archive_id") == some).first()
    with zipfile.ZipFile(os.path.join(out, entry["archive_path"])) as f:
        assert f.read(f"{some}.eml") == docs[some]
    rep = res.report.first()
    assert rep["total"] == len(before) and rep["zip_bytes"] > 0 and rep["link"].endswith("/j")
    # a rerun on the finished ledger changes nothing and numbers after the existing archives
    again = run_export(spark, res.ledger, cfg, out, content=c, now="2026-01-01 00:00:00")
    assert again.start_index == res.archives.agg(F.max("zip_idx")).first()[0]
    assert {r["archive_id"]: (r["export_status"], r["error_log"]) for r in again.ledger.collect()} == after
    assert again.archives.count() == 0


def test_interrupted_run_resumes_to_the_same_result(spark):
    m, c = _inputs(spark)
    cfg = ExportConfig(job_id="j", max_zip_mb=1, batch_size=40)
    one = run_export(spark, m, cfg, tempfile.mkdtemp(), content=c, now="2026-01-01 00:00:00")
    out = tempfile.mkdtemp()
    part = run_export(spark, m, cfg, out, content=c, now="2026-01-01 00:00:00", max_batches=2)
    assert part.ledger.where(F.col("export_status") == "PROCESSING").count() > 0
    rest = run_export(spark, part.ledger, cfg, out, content=c, now="2026-01-01 00:00:00")
    key = lambda df: sorted((r["archive_id"], r["export_status"], r["error_log"]) for r in df.collect())
    assert key(rest.ledger) == key(one.ledger)
    assert rest.start_index > 0


def test_export_with_fetcher(spark):
    m, _ = _inputs(spark)
    cfg = ExportConfig(job_id="f", max_zip_mb=1, batch_size=100, workers=10)
    res = run_export(spark, m, cfg, tempfile.mkdtemp(), fetcher_factory=attempt_rule_fetcher_factory(),
                     sleep=lambda s: None, now="2026-01-01 00:00:00")
    errs = {r["error_log"] for r in res.ledger.where("export_status = 'FAILED'").collect()}
    assert "Network error after 3 attempts: timeout" in errs
    assert any(e and e.startswith("API returned status") for e in errs)


def test_stream_restart_reads_nothing_new(spark):
    from zipledger.streaming.manifest_stream import run_available_now, stream_manifest
    src = os.path.join(SF_SMALL, "orders.parquet")
    d = tempfile.mkdtemp()
    s = stream_manifest(spark, src, A.load_table(spark, SF_SMALL, "orders").schema)
    run_available_now(s, d + "/sink", d + "/ck")
    n1 = spark.read.parquet(d + "/sink").count()
    s = stream_manifest(spark, src, A.load_table(spark, SF_SMALL, "orders").schema)
    run_available_now(s, d + "/sink", d + "/ck")
    assert spark.read.parquet(d + "/sink").count() == n1 > 0


@pytest.mark.parametrize("name", sorted(__import__("__spark_entry__").oracle_sql()))
def test_oracle_sf0001(spark, name):
    import __spark_entry__ as E
    from tools.check_oracle import TABLES, digest, type_diff
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    assert type_diff(sdf, res) == {}
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == \
        digest([d[0] for d in res.description], res.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "export_status" in df.columns


def test_stream_commit_log_is_merge_on_read(spark):
    """Several micro-batches append to the log; replaying a batch changes nothing;
    the current view equals a batch apply; compaction folds the log."""
    from zipledger.operators import ledger as L
    from zipledger.sinks.ledger import write_ledger_snapshot
    from zipledger.streaming.commit import commit_completions, compact, current_ledger
    d = tempfile.mkdtemp()
    m = A.manifest_from_orders(A.load_table(spark, SF_SMALL, "orders"))
    write_ledger_snapshot(m, d + "/ledger", version=1)
    ev = A.completions_from_events(A.load_table(spark, SF_SMALL, "events"))
    ev.repartition(3).write.parquet(d + "/events")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events")
    q = commit_completions(spark, s, d + "/log", d + "/ck", now="2026-01-01 00:00:00")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    exp = L.apply_updates(m, L.completion_updates(ev), now="2026-01-01 00:00:00")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(current_ledger(spark, d + "/ledger", d + "/log")) == key(exp)
    v = compact(spark, d + "/ledger", d + "/log")
    assert v == 2 and key(current_ledger(spark, d + "/ledger", d + "/log")) == key(exp)
    # a version written by another job on top keeps what is folded: the log isn't applied over newer statuses
    from pyspark.sql import functions as F
    newer = exp.withColumn("export_status", F.lit("FAILED"))
    assert write_ledger_snapshot(newer, d + "/ledger") == 3
    assert key(current_ledger(spark, d + "/ledger", d + "/log")) == key(newer)


def test_paths_without_a_scheme_follow_spark(spark):
    from zipledger.session import qualified
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    default = conf.get("fs.defaultFS")
    assert qualified(spark, "/a/b") == "/a/b"
    try:
        conf.set("fs.defaultFS", "hdfs://store/")
        assert qualified(spark, "/a/b") == "hdfs://store/a/b"
        assert qualified(spark, "file:///a") == "file:///a" and qualified(spark, "s3a://x/a") == "s3a://x/a"
    finally:
        conf.set("fs.defaultFS", default)


def test_cli_export(spark, capsys):
    import json
    from zipledger.__main__ import main
    d = tempfile.mkdtemp()
    m, c = _inputs(spark)
    m.write.parquet(d + "/ledger")
    c.write.parquet(d + "/content")
    assert main(["export", "--job-id", "cli", "--ledger", d + "/ledger", "--content", d + "/content",
                 "--output-dir", d + "/out", "--max-zip-size-mb", "1", "--log-dir", d + "/logs"]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["job"] == "cli" and rep["completed"] > 0
    assert os.path.isdir(d + "/logs/channel=process")
    logs = spark.read.json(d + "/logs/channel=process").collect()
    before = m.where("export_status = 'COMPLETED'").count()
    counts = sorted(int(r["progress"].split("/")[0]) for r in logs)
    assert counts == list(range(before + 1, before + len(logs) + 1))
    assert {r["progress"].split("/")[1] for r in logs} == {str(m.count())}
    general = {r["event"] for r in spark.read.json(d + "/logs/channel=general").collect()}
    assert general == {"job_started", "ledger_scanned", "resume_index", "job_finished"}


def test_slots_grow_with_data(spark):
    m, c = _inputs(spark)
    cfg = ExportConfig(job_id="s", max_zip_mb=1, max_bytes_per_slot=2 * 1024 * 1024)
    res = run_export(spark, m, cfg, tempfile.mkdtemp(), content=c, now="2026-01-01 00:00:00")
    assert res.timings["slots"] > cfg.slots
    per_slot = res.entries.count()
    assert per_slot > 0 and res.archives.agg(F.sum("entries")).first()[0] == per_slot


def test_no_temp_files_left(spark):
    m, c = _inputs(spark)
    out = tempfile.mkdtemp()
    run_export(spark, m, ExportConfig(job_id="t", max_zip_mb=1), out, content=c, now="2026-01-01 00:00:00")
    leftovers = [f for d, _, fs in os.walk(out) for f in fs if f.endswith(".tmp")]
    assert leftovers == []


def test_export_stream_numbers_across_batches(spark):
    from zipledger.sources.manifest import conform_ledger
    from zipledger.sinks.audit import read_audit
    from zipledger.streaming.export_stream import read_stream_ledger, run_export_stream, stream_report
    m, c = _inputs(spark)
    d = tempfile.mkdtemp()
    conform_ledger(m).repartitionByRange(3, "archive_id").write.parquet(d + "/in")
    cfg = ExportConfig(job_id="s", max_zip_mb=1)
    q = run_export_stream(spark, d + "/in", cfg, d + "/out", d + "/ck", content=c, now="2026-01-01 00:00:00",
                          audit_dir=d + "/audit")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    names = sorted(f for f in os.listdir(d + "/out/s") if f.endswith(".zip"))
    assert names == [f"emails_{i:04d}.zip" for i in range(1, len(names) + 1)]
    ledger = read_stream_ledger(spark, d + "/out", "s")
    assert ledger.count() == m.count()
    done = ledger.where("export_status = 'COMPLETED'").count()
    report = stream_report(spark, d + "/out", cfg).first()
    assert (report["total"], report["completed"]) == (ledger.count(), done) and report["zip_bytes"] > 0
    audit = read_audit(spark, d + "/audit")
    assert audit.where("channel = 'process'").count() == done - m.where("export_status = 'COMPLETED'").count()
    assert audit.select("run").distinct().count() == 3
    one = run_export(spark, m, ExportConfig(job_id="s", max_zip_mb=1), tempfile.mkdtemp(), content=c,
                     now="2026-01-01 00:00:00").ledger
    key = lambda df: sorted((r["archive_id"], r["export_status"], r["error_log"]) for r in df.collect())
    assert key(ledger) == key(one)


def test_export_stream_in_a_session_that_wrote_no_archive_before(spark, monkeypatch):
    """The ZIP format is known to the stream's session although nothing registered its name earlier."""
    from zipledger.sinks.zip_source import ZipArchives
    from zipledger.sources.manifest import conform_ledger
    from zipledger.streaming.export_stream import read_stream_ledger, run_export_stream
    monkeypatch.setattr(ZipArchives, "name", classmethod(lambda cls: "zip_archives_not_registered_yet"))
    m, c = _inputs(spark)
    d = tempfile.mkdtemp()
    conform_ledger(m).coalesce(1).write.parquet(d + "/in")
    run_export_stream(spark, d + "/in", ExportConfig(job_id="s", max_zip_mb=1), d + "/out", d + "/ck", content=c,
                      now="2026-01-01 00:00:00")
    assert read_stream_ledger(spark, d + "/out", "s").count() == m.count()
    assert any(f.endswith(".zip") for f in os.listdir(d + "/out/s"))


def test_retention_cleans_an_old_export(spark):
    """Archives and the ledger snapshots of an old export are deleted and its job dir removed."""
    from zipledger.plans.retention import run_retention
    from zipledger.schema import RetentionConfig
    m, c = _inputs(spark)
    out = tempfile.mkdtemp()
    run_export(spark, m, ExportConfig(job_id="old", max_zip_mb=1), out, content=c, now="2026-01-01 00:00:00")
    os.makedirs(os.path.join(out, "fresh"))
    with open(os.path.join(out, "fresh", "new.zip"), "wb") as f:
        f.write(b"x")
    old = 1_500_000_000
    for d, dirs, files in os.walk(os.path.join(out, "old")):
        for n in files:
            os.utime(os.path.join(d, n), (old, old))
    res = run_retention(spark, out, RetentionConfig(max_age_days=7))
    s = res.summary.first()
    assert s["errors"] == 0 and s["files"] > 0
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["fresh"]


def test_crashed_run_rewrites_its_own_archives(spark):
    """A run that wrote archives but never committed is redone under the same names."""
    import json
    m, c = _inputs(spark)
    out = tempfile.mkdtemp()
    cfg = ExportConfig(job_id="c", max_zip_mb=1)
    first = run_export(spark, m, cfg, out, content=c, now="2026-01-01 00:00:00")
    names = sorted(f for f in os.listdir(os.path.join(out, "c")) if f.endswith(".zip"))
    # simulate a crash before the commit of a second, identical run: the intent is still there
    with open(os.path.join(out, "c", "_uncommitted_run.json"), "w") as f:
        json.dump({"start": first.start_index}, f)
    again = run_export(spark, m, cfg, out, content=c, now="2026-01-01 00:00:00")
    assert again.start_index == first.start_index
    assert sorted(f for f in os.listdir(os.path.join(out, "c")) if f.endswith(".zip")) == names
    assert not os.path.exists(os.path.join(out, "c", "_uncommitted_run.json"))


def test_stream_pack_spans_micro_batches(spark):
    """Slot state carries across micro-batches: same archives as one sequential pass."""
    from zipledger.operators import packing as PK
    from zipledger.streaming.manifest_stream import run_available_now
    from zipledger.streaming.pack_state import stream_pack
    rows = spark.createDataFrame([(f"r{i}", i % 3, i, (i * 37) % 500, (i * 53) % 500) for i in range(300)],
                                 "archive_id string, slot int, claim_seq long, declared long, actual long")
    d = tempfile.mkdtemp()
    rows.repartitionByRange(3, "claim_seq").sortWithinPartitions("claim_seq").write.parquet(d + "/in")
    for i, f in enumerate(sorted(x for x in os.listdir(d + "/in") if x.endswith(".parquet"))):
        os.utime(os.path.join(d, "in", f), (1_000_000 + i, 1_000_000 + i))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    q = run_available_now(stream_pack(s, 1000), d + "/out", d + "/ck")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = {r["archive_id"]: r["k"] for r in spark.read.parquet(d + "/out").collect()}
    exp = {r["archive_id"]: r["k"] for r in PK.pack_next_fit(rows, 1000).collect()}
    assert got == exp


def test_duplicate_ids_fail_the_run(spark):
    m, c = _inputs(spark)
    dup = m.unionByName(m.limit(1).withColumn("export_status", F.lit("PENDING")))
    with pytest.raises(ValueError, match="appears 2 times"):
        run_export(spark, dup, ExportConfig(job_id="d"), tempfile.mkdtemp(), content=c, now="2026-01-01 00:00:00")


@pytest.mark.parametrize("rule", ["hash", "round_robin"])
def test_content_copies_archive_once(spark, rule):
    m, c = _inputs(spark)
    copies = c.unionByName(c).unionByName(c)
    out = tempfile.mkdtemp()
    cfg = ExportConfig(job_id="k", max_zip_mb=1, slot_rule=rule)
    res = run_export(spark, m, cfg, out, content=copies, now="2026-01-01 00:00:00")
    plain = run_export(spark, m, cfg, tempfile.mkdtemp(), content=c, now="2026-01-01 00:00:00")
    assert res.archives.agg(F.sum("entries")).first()[0] == res.entries.count() == plain.entries.count() > 0
    key = lambda df: sorted((r["archive_id"], r["export_status"], r["error_log"]) for r in df.collect())
    assert key(res.ledger) == key(plain.ledger)


def test_export_to_a_file_uri(spark):
    """Archives, markers and the ledger go through URI-aware writers."""
    m, c = _inputs(spark)
    out = tempfile.mkdtemp()
    res = run_export(spark, m, ExportConfig(job_id="u", max_zip_mb=1), "file://" + out, content=c,
                     now="2026-01-01 00:00:00")
    zips = [f for f in os.listdir(os.path.join(out, "u")) if f.endswith(".zip")]
    assert zips and res.report.first()["zip_bytes"] > 0
    assert os.path.exists(os.path.join(out, "u", "ledger", "_committed_1"))


def test_cli_export(spark, capsys):
    """A ledger exported through the command line gives the same statuses as the call."""
    import json
    from zipledger.__main__ import main
    m, c = _inputs(spark)
    d = tempfile.mkdtemp()
    m.write.parquet(d + "/ledger")
    c.write.parquet(d + "/content")
    assert main(["export", "--job-id", "sq", "--ledger", d + "/ledger", "--content", d + "/content",
                 "--output-dir", d + "/out", "--max-zip-size-mb", "1"]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    table = run_export(spark, m, ExportConfig(job_id="sq", max_zip_mb=1), tempfile.mkdtemp(), content=c)
    t = table.report.first()
    assert (rep["total"], rep["completed"], rep["failed"]) == (t["total"], t["completed"], t["failed"])
