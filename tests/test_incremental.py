"""The incremental inventory: merged listings, directories that aren't read again, the store's versions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from zipledger.sources import incremental as I
from zipledger.sources.inventory import list_files

OLD = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc).timestamp()


def _file(path, size=1, at=OLD):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.truncate(size)
    os.utime(path, (at, at))


def _age(root):
    for d, _, _ in os.walk(root, topdown=False):
        os.utime(d, (OLD, OLD))


def _state(df, root):
    return sorted((r["path"][len(root):], r["length"], r["is_dir"]) for r in df.collect())


def _files(changes, root):
    return sorted((r["path"][len(root):], r["change"]) for r in changes.where("not is_dir").collect())


def _same_as_listing(spark, store, root):
    got = {(r["path"], r["length"], r["modificationTime"]) for r in I.read(spark, store).where("not is_dir").collect()}
    want = {(r["path"], r["length"], r["modificationTime"]) for r in list_files(spark, root).collect()}
    assert got == want


def test_refresh_follows_the_tree(spark, tmp_path):
    root, store = str(tmp_path / "tree"), str(tmp_path / "store")
    for p in ("a/1.zip", "a/2.zip", "a/deep/er/3.db", "b/.hidden", "c/x.zip", "top.zip"):
        _file(f"{root}/{p}")
    first = I.refresh(spark, root, store)
    assert first.version.number == 1 and {c for _, c in _files(first.changes, root)} == {"new"}
    _same_as_listing(spark, store, root)
    assert I.refresh(spark, root, store).changes.count() == 0

    _file(f"{root}/a/2.zip", size=7)                     # changed in place
    os.remove(f"{root}/a/1.zip")
    os.remove(f"{root}/c/x.zip")
    os.rmdir(f"{root}/c")                                # a known directory is gone
    _file(f"{root}/n/e/w/4.zip")                         # three new levels
    os.remove(f"{root}/b/.hidden")
    os.rmdir(f"{root}/b")
    _file(f"{root}/b", size=5)                           # a directory became a file
    third = I.refresh(spark, root, store)
    assert _files(third.changes, root) == [("/a/1.zip", "gone"), ("/a/2.zip", "changed"), ("/b", "changed"), ("/b/.hidden", "gone"),
                                           ("/c/x.zip", "gone"), ("/n/e/w/4.zip", "new")]
    _same_as_listing(spark, store, root)
    assert _state(I.read(spark, store, I.version(store, 2)), root) == _state(I.read(spark, store, first.version), root)


def test_unchanged_directories_are_not_read(spark, tmp_path):
    root, store = str(tmp_path / "tree"), str(tmp_path / "store")
    for p in ("old/1.zip", "old/2.zip", "live/3.zip"):
        _file(f"{root}/{p}")
    _age(root)
    I.refresh(spark, root, store)
    _file(f"{root}/old/unseen.zip")                      # its directory claims to be unchanged: taken at its word
    _file(f"{root}/old/1.zip", size=9)                   # metadata is fetched all the same
    os.remove(f"{root}/old/2.zip")
    _file(f"{root}/live/4.zip")
    os.utime(f"{root}/old", (OLD, OLD))
    got = I.refresh(spark, root, store)
    assert _files(got.changes, root) == [("/live/4.zip", "new"), ("/old/1.zip", "changed"), ("/old/2.zip", "gone")]
    os.utime(f"{root}/old")                              # a new time: read again
    assert _files(I.refresh(spark, root, store).changes, root) == [("/old/unseen.zip", "new")]


def test_times_around_the_listing_are_not_trusted(spark, tmp_path):
    root, store = str(tmp_path / "tree"), str(tmp_path / "store")
    _file(f"{root}/d/1.zip")
    st = os.stat(f"{root}/d")
    I.refresh(spark, root, store)
    _file(f"{root}/d/2.zip")
    os.utime(f"{root}/d", ns=(st.st_mtime_ns, st.st_mtime_ns))  # as if both fell into one tick of the clock
    assert _files(I.refresh(spark, root, store).changes, root) == [("/d/2.zip", "new")]


def test_a_flat_directory_is_dealt_over_tasks(spark, tmp_path):
    root = str(tmp_path / "flat")
    for i in range(3000):
        _file(f"{root}/f{i}")
    none = spark.createDataFrame([], I.ENTRY)
    found = I.relist(spark, root, none, 0, num_partitions=8)
    shares = [r["n"] for r in found.where("not is_dir").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert sum(shares) == 3000 and len(shares) == 8 and max(shares) < 600
    known = found.drop("error")
    again = I.relist(spark, root, known, 1 << 60, num_partitions=8)  # the names come from the snapshot
    assert _state(again.drop("error"), root) == _state(known, root)


def test_uris_list_like_paths(spark, tmp_path):
    root = str(tmp_path / "tree")
    for p in ("a/1.zip", "a/b/2.db", "3.zip"):
        _file(f"{root}/{p}")
    _age(root)
    plain, uri = str(tmp_path / "s1"), str(tmp_path / "s2")
    for store, at in ((plain, root), (uri, "file://" + root)):
        I.refresh(spark, at, store)
    _file(f"{root}/a/b/4.db")
    got = [_files(I.refresh(spark, at, store).changes, at) for store, at in ((plain, root), (uri, "file://" + root))]
    assert got[0] == got[1] == [("/a/b/4.db", "new")]


def test_unread_entries_are_not_gone(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [("/t/d/1", 1, None, False), ("/t/d/2", 2, None, False), ("/t/e/3", 3, None, False), ("/t/4", 4, None, False)]
    base = I.commit(spark, store, spark.createDataFrame(rows, I.ENTRY), 0)
    unread = spark.createDataFrame([("/t/d",), ("/t/4",), ("/t/d",)], "path string")
    made = I.commit(spark, store, spark.createDataFrame([], I.ENTRY), 0, unread, base)
    assert [(r["path"], r["change"]) for r in I.changes_of(spark, store, 2).collect()] == [("/t/e/3", "gone")]
    assert _state(I.read(spark, store, made), "/t") == [("/4", 4, False), ("/d/1", 1, False), ("/d/2", 2, False)]


def test_an_unreadable_directory_is_read_next_time(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "tree"), str(tmp_path / "store")
    _file(f"{root}/d/1.zip")
    _age(root)
    found = spark.createDataFrame([(root, None, dt.datetime(2020, 1, 1), True, None), (f"{root}/d", None, dt.datetime(2020, 1, 1), True, None),
                                   (f"{root}/d", None, None, True, "Permission denied")], I._FOUND)
    with monkeypatch.context() as m:
        m.setattr(I, "relist", lambda *a, **k: found)
        got = I.refresh(spark, root, store)
    assert [r["path"] for r in got.unread.collect()] == [f"{root}/d"] and got.changes.where("not is_dir").count() == 0
    assert _files(I.refresh(spark, root, store).changes, root) == [("/d/1.zip", "new")]


def test_versions_compaction_and_conflicts(spark, tmp_path):
    store = str(tmp_path / "store")
    listing = lambda *n: spark.createDataFrame([(f"/t/{i}", i, None, False) for i in n], I.ENTRY)
    assert I.latest(store) is None and I.read(spark, store).count() == 0
    v = I.commit(spark, store, listing(1, 2), 0, compact_every=2)
    stale = v
    v = I.commit(spark, store, listing(2, 3), 0, base=v, compact_every=2)
    held = set(os.listdir(f"{store}/data"))
    with pytest.raises(FileExistsError):
        I.commit(spark, store, listing(9), 0, base=stale, compact_every=2)
    assert set(os.listdir(f"{store}/data")) == held and I.latest(store) == v
    v = I.commit(spark, store, listing(3, 4), 0, base=v, compact_every=2)
    assert len(v.writes) == 1 and _state(I.read(spark, store), "/t") == [("/3", 3, False), ("/4", 4, False)]
    assert {(r["path"], r["change"]) for r in I.changes_of(spark, store, 3).collect()} == {("/t/2", "gone"), ("/t/4", "new")}
    v = I.commit(spark, store, listing(), 0, base=v, compact_every=2)
    assert I.read(spark, store).count() == 0


def test_empty_and_missing_roots(spark, tmp_path):
    os.makedirs(tmp_path / "empty")
    got = I.refresh(spark, str(tmp_path / "empty"), str(tmp_path / "store"))
    assert [(r["path"], r["is_dir"]) for r in got.changes.collect()] == [(str(tmp_path / "empty"), True)]
    with pytest.raises(FileNotFoundError):
        I.refresh(spark, str(tmp_path / "none"), str(tmp_path / "store2"))
