import random

from zipledger.operators import packing as PK

CAP = 100


def brute(rows, cap, rotate=False):
    """Sequential next-fit per slot, as the original appends entries."""
    out, state = {}, {}
    for aid, slot, seq, dec, act, grp in sorted(rows, key=lambda r: (r[1], r[2])):
        k, fill, g = state.get(slot, (0, 0, None))
        if k == 0 or (rotate and grp != g) or (cap is not None and fill + dec > cap):
            k, fill, g = k + 1, 0, grp
        state[slot] = (k, fill + act, g)
        out[aid] = k
    return out


def _df(spark, rows):
    return spark.createDataFrame(rows, "archive_id string, slot int, claim_seq long, declared long, actual long, "
                                       "org_id string")


def test_edge_rows(spark):
    rows = [("a", 0, 1, 60, 60, "o"), ("b", 0, 2, 40, 40, "o"),   # exactly at the cap: fits
            ("c", 0, 3, 1, 1, "o"),                               # one byte over: rotates
            ("d", 0, 4, 500, 500, "o"),                           # above the cap: alone
            ("e", 0, 5, 10, 10, "o"),
            ("f", 1, 1, 90, 5, "o"), ("g", 1, 2, 95, 5, "o"),   # fill counts actual: 5 + 95 fits
            ("h", 1, 3, 91, 5, "o")]                              # 10 + 91 > 100 rotates
    got = {r["archive_id"]: r["k"] for r in PK.pack_next_fit(_df(spark, rows), CAP).collect()}
    assert got == {"a": 1, "b": 1, "c": 2, "d": 3, "e": 4, "f": 1, "g": 1, "h": 2}
    unlimited = {r["archive_id"]: r["k"] for r in PK.pack_next_fit(_df(spark, rows), (1 << 63) - 1).collect()}
    assert set(unlimited.values()) == {1}


def test_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(f"r{i}", i % 4, i, rnd.randint(0, 60), rnd.randint(0, 60), rnd.choice("xyz")) for i in range(2000)]
    df = _df(spark, rows)
    got = {r["archive_id"]: r["k"] for r in PK.pack_next_fit(df, CAP, num_partitions=3).collect()}
    assert got == brute(rows, CAP)
    rot = {r["archive_id"]: r["k"] for r in PK.pack_next_fit(df, CAP, mode="rotate", group_col="org_id").collect()}
    assert rot == brute(rows, CAP, rotate=True)
    part = {r["archive_id"]: r["k"] for r in
            PK.pack_next_fit(df, CAP, mode="partition", group_col="org_id").collect()}
    exp = {}
    for g in "xyz":
        exp.update(brute([r for r in rows if r[5] == g], CAP))
    assert part == exp


def test_numbering_unique_and_contiguous(spark):
    rnd = random.Random(3)
    rows = [(f"r{i}", i % 5, i, rnd.randint(1, 50), rnd.randint(1, 50), "o") for i in range(1500)]
    packed = PK.pack_next_fit(_df(spark, rows), CAP)
    numbered = PK.number_archives(packed, ["slot"], start=41).toPandas()
    per_archive = numbered.groupby("zip_idx")[["slot", "k"]].nunique()
    assert (per_archive == 1).all().all()
    idx = sorted(numbered["zip_idx"].unique())
    assert idx == list(range(42, 42 + len(idx)))
    # slot-major, k-minor
    first = numbered.groupby(["slot", "k"])["zip_idx"].first().reset_index().sort_values(["slot", "k"])
    assert list(first["zip_idx"]) == idx


def test_resume_index(spark):
    names = ["emails_0005.zip", "emails_0007.zip.tmp", "emails_0009.tar", "emails_0008.ZIP", "emails_10000.zip",
             "emails_99999999999.zip", "emails_x.zip"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert PK.resume_index(df, depth_col=None).first()["resume_index"] == 10000
    neg = spark.createDataFrame([("emails_-4.zip",)], "name string")
    assert PK.resume_index(neg, depth_col=None).first()["resume_index"] == 0
    empty = spark.createDataFrame([], "name string")
    assert PK.resume_index(empty, depth_col=None).first()["resume_index"] == 0


def test_partition_export_packs_like_the_packer(spark, tmp_path):
    """Per-group archives of the job: as many, with the same entries, as next-fit packing per (group, slot) makes."""
    import zipfile

    from zipledger.plans.export import run_export
    from zipledger.schema import ExportConfig, LEDGER

    n = 160
    rows = [(f"g{i}", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i % 80, 100 + i) for i in range(n)]
    ledger = spark.createDataFrame(rows, "archive_id string, t string, org long, raw_eml_size long").selectExpr(
        "archive_id", "cast(t as timestamp_ntz) as archive_time", "concat('10.0.0.1:org', org, ':example.com:20240101:', archive_id) as archive_location",
        "raw_eml_size", "'PENDING' as export_status", "cast(null as timestamp_ntz) as updated_at", "cast(null as string) as error_log",
        "cast(0 as int) as retries")
    ledger = ledger.select(*[ledger[f.name].cast(f.dataType) for f in LEDGER.fields])
    content = ledger.selectExpr("archive_id", "cast(repeat('z', cast(raw_eml_size as int)) as binary) as content")
    cfg = ExportConfig(job_id="j", zip_slots=2, max_zip_mb=1, group_mode="partition")
    res = run_export(spark, ledger, cfg, str(tmp_path), content=content, now="2026-01-01 00:00:00")
    done = {r.archive_id for r in res.ledger.where("export_status = 'COMPLETED'").collect()}
    assert len(done) == n
    names = [x for p in tmp_path.glob("j/*/*.zip") for x in zipfile.ZipFile(p).namelist()]
    assert sorted(names) == sorted(f"{a}.eml" for a in done)
    # 80 groups of two items each, both in one slot: one archive a group, however many groups there are
    assert len(list(tmp_path.glob("j/*/*.zip"))) == res.archives.count() == 80


def test_record_left_after_commit_keeps_committed_archives(spark, tmp_path):
    """A run that died after its ledger commit leaves its record; the next run must not reuse its archive numbers.
    A run that died before the commit is redone, and nothing of it is left over."""
    import json
    import zipfile

    from zipledger.plans.export import run_export
    from zipledger.schema import LEDGER, ExportConfig

    def ledger(ids):
        df = spark.createDataFrame([(i, 10) for i in ids], "archive_id string, raw_eml_size long").selectExpr(
            "archive_id", "timestamp_ntz'2024-01-01 00:00:00' as archive_time", "concat('10.0.0.1:o:example.com:20240101:', archive_id) as archive_location",
            "raw_eml_size", "'PENDING' as export_status", "cast(null as timestamp_ntz) as updated_at", "cast(null as string) as error_log",
            "cast(0 as int) as retries")
        return df.select(*[df[f.name].cast(f.dataType) for f in LEDGER.fields])

    def run(ids):
        rows = ledger(ids)
        body = rows.selectExpr("archive_id", "case when archive_id = 'null-body' then null else cast(archive_id as binary) end as content")
        return run_export(spark, rows, ExportConfig(job_id="j", zip_slots=1, max_zip_mb=1), str(tmp_path), content=body, now="2026-01-01 00:00:00")

    def stored():
        return sorted(x for p in tmp_path.glob("j/*.zip") for x in zipfile.ZipFile(p).namelist())

    record = tmp_path / "j" / "_uncommitted_run.json"
    first = run(["a", "b", "null-body"])
    assert {r.archive_id: r.export_status for r in first.ledger.collect()}["null-body"] != "COMPLETED"
    record.write_text(json.dumps({"start": 0, "version": first.version, "ledger": str(tmp_path / "j" / "ledger")}))
    run(["c"])
    assert stored() == ["a.eml", "b.eml", "c.eml"] and not record.exists()
    # a dead, uncommitted run: its archive goes, the next one takes its number
    with zipfile.ZipFile(tmp_path / "j" / "emails_0003.zip", "w") as z:
        z.writestr("dead.eml", b"x")
    record.write_text(json.dumps({"start": 2, "version": 99, "ledger": str(tmp_path / "j" / "ledger")}))
    run(["d"])
    assert stored() == ["a.eml", "b.eml", "c.eml", "d.eml"]


def test_retention_leaves_strangers_in_folders_named_like_snapshots(spark):
    import datetime as dt

    from zipledger.operators.retention import retention_plan
    old, root = dt.datetime(2020, 1, 1), "/data/ledger/store"
    paths = ["job/notes.txt", "job/ledger/notes.txt", "ledger/notes.txt", "job/ledger/version=1/part-0.parquet", "job/ledger/_committed_1",
             "job/ledger-stream/batch_id=3/version=1/part-0.parquet", "job/a.zip", "job/sub/ledger/version=1/x"]
    inv = spark.createDataFrame([(f"{root}/{p}", 1, old) for p in paths], "path string, length long, mtime timestamp_ntz")
    plan = retention_plan(inv, now="2026-01-01 00:00:00", snapshot_dirs=("ledger", "ledger-stream"), root=root)
    assert sorted(r.path[len(root) + 1:] for r in plan.collect()) == [
        "job/a.zip", "job/ledger-stream/batch_id=3/version=1/part-0.parquet", "job/ledger/_committed_1", "job/ledger/version=1/part-0.parquet"]
