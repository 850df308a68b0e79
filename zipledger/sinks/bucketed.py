"""Bucketed ledger: one ledger for many runs, updated in place of buckets and committed optimistically.

Rows lie in hash buckets of the id, ``<root>/data/<write>/bucket=<b>/``. A version is a small manifest,
``<root>/_commits/<version>.json``, that names for each bucket the write that holds it, so an update rewrites the
buckets of its ids only and every other bucket's files are shared with the version before.

A commit creates the next version's manifest exclusively (``fs.create_exclusive``): of two runs that started from the same
version one succeeds. The other reads what has been committed since. A keyed update carries its rewritten buckets over
and redoes only those that the others rewrote too. A claim checks the ids it chose: if all are still eligible they
stand, else it chooses again. So no update is lost and no id is claimed twice, without locks; a run that dies before its
manifest exists leaves nothing that a reader sees.

Manifests also carry each live run's claims (paths of claimed rows), so a run's unfinished rows can be given back
(``release``) while other runs go on with theirs.

The driver handles bucket numbers and directory names only (bounded by ``buckets``, chosen when the ledger is created; some
hundred megabytes a bucket is a good size). The bucket is Spark's own hash partition of the id, so the join of an
update leaves each bucket's rows in one task and no second shuffle is needed to write it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as C
from ..operators.ledger import apply_updates, claim_first_batch, eligible
from ..schema import CLAIM_COLUMNS, LEDGER, LEDGER_COLUMNS
from . import fs as fsx

MAX_ATTEMPTS = 50
CLAIM_ROWS = StructType([f for f in LEDGER.fields if f.name in CLAIM_COLUMNS])
UPDATE_ROWS = "archive_id string, export_status string, error_log string, seq long"


class CommitConflict(RuntimeError):
    """Other runs kept committing first."""


class ClaimLost(RuntimeError):
    """The claim was given back (``release``) before its outcome came."""


@dataclass(frozen=True)
class Snapshot:
    root: str
    version: int
    buckets: tuple[str, ...]                 # bucket -> the write that holds it ("": no rows)
    claims: dict[str, tuple[str, ...]] = field(default_factory=dict)  # run -> paths of its claimed rows
    touched: tuple[int, ...] = ()            # buckets that this version rewrote

    def paths(self, only: Iterable[int] | None = None) -> list[str]:
        wanted = range(len(self.buckets)) if only is None else only
        return [fsx.join(self.root, "data", self.buckets[b], f"bucket={b}") for b in wanted if self.buckets[b]]


@dataclass(frozen=True)
class Commit:
    snapshot: Snapshot
    rewritten: tuple[int, ...]
    attempts: int


@dataclass(frozen=True)
class Claim:
    snapshot: Snapshot
    rows: DataFrame      # the claimed rows: id, time, location, declared size
    path: str            # where they are kept, under the root ("": nothing was eligible)
    attempts: int


def bucket_of(id_col: Column | str, buckets: int) -> Column:
    return F.pmod(F.hash(id_col), F.lit(buckets))


# -- versions ------------------------------------------------------------------------------------

def _manifest(root: str, version: int) -> str:
    return fsx.join(root, "_commits", f"{version:012d}.json")


def versions(root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in fsx.list_dir(fsx.join(root, "_commits")) if n.endswith(".json") and not n.startswith(".")]


def snapshot(root: str, version: int | None = None) -> Snapshot:
    """A committed version (the newest without ``version``)."""
    if version is None:
        found = versions(root)
        if not found:
            raise FileNotFoundError(f"no bucketed ledger under {root}")
        version = found[-1]
    d = json.loads(fsx.read_text(_manifest(root, version)))
    where = {b: write for write, held in d["writes"].items() for b in held}
    return Snapshot(root, version, tuple(where.get(b, "") for b in range(d["buckets"])),
                    {r: tuple(p) for r, p in d["claims"].items()}, tuple(d["touched"]))


def _publish(snap: Snapshot) -> bool:
    writes: dict[str, list[int]] = {}
    for b, write in enumerate(snap.buckets):
        if write:
            writes.setdefault(write, []).append(b)
    return fsx.create_exclusive(_manifest(snap.root, snap.version), json.dumps(
        {"version": snap.version, "buckets": len(snap.buckets), "writes": writes, "claims": snap.claims, "touched": snap.touched}))


def read(spark: SparkSession, snap: Snapshot, only: Iterable[int] | None = None) -> DataFrame:
    """The ledger's rows in a version, of all buckets or ``only`` some."""
    paths = snap.paths(only)
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)


def _write(rows: DataFrame, root: str, buckets: int) -> tuple[str, list[int]]:
    """Write rows by bucket; returns the write's name and the buckets that got rows."""
    name = uuid.uuid4().hex
    path = fsx.join(root, "data", name)
    rows.select(*LEDGER_COLUMNS, bucket_of("archive_id", buckets).alias("bucket")).write.partitionBy("bucket").parquet(path)
    return name, sorted(int(d.split("=")[1]) for d in fsx.list_dir(path, files=False, dirs=True) if d.startswith("bucket="))


def create(ledger: DataFrame, root: str, buckets: int = 64) -> Snapshot:
    """A new bucketed ledger with the rows of ``ledger`` as version 1."""
    name, held = _write(ledger.repartition(buckets, "archive_id"), root, buckets)
    snap = Snapshot(root, 1, tuple(name if b in set(held) else "" for b in range(buckets)), {}, tuple(held))
    if not _publish(snap):
        fsx.remove_tree(fsx.join(root, "data", name))
        raise FileExistsError(f"a bucketed ledger exists under {root}")
    return snap


# -- commits -------------------------------------------------------------------------------------

class _Rewrite:
    """One update's rewritten buckets, redone as far as other commits make it necessary."""

    def __init__(self, spark: SparkSession, updates: DataFrame, now, keep_error: bool):
        self.spark, self.updates, self.now, self.keep_error = spark, updates, now, keep_error
        self.held: dict[int, str] = {}
        self.names: set[str] = set()
        self.touched: set[int] | None = None

    def onto(self, snap: Snapshot, changed: set[int] | None) -> None:
        """Make the rewritten buckets follow ``snap``; ``changed``: what others rewrote since the last call (None: first call)."""
        n = len(snap.buckets)
        if self.touched is None:
            self.touched = {r[0] for r in self.updates.select(bucket_of("archive_id", n)).distinct().collect()}  # at most n
        redo = sorted(b for b in (self.touched if changed is None else self.touched & changed) if snap.buckets[b])
        for b in redo:
            self.held.pop(b, None)
        if redo:
            name, held = _write(apply_updates(read(self.spark, snap, redo), self.updates, now=self.now, keep_error=self.keep_error), snap.root, n)
            self.held.update(dict.fromkeys(held, name))
            self.names.add(name)

    def drop(self, root: str, keep: Iterable[str] = ()) -> None:
        """Remove what was written, but for the writes that a committed version names."""
        for name in self.names - set(keep):
            fsx.remove_tree(fsx.join(root, "data", name))

    def over(self, snap: Snapshot) -> Snapshot:
        return Snapshot(snap.root, snap.version + 1, tuple(self.held.get(b, w) for b, w in enumerate(snap.buckets)),
                        snap.claims, tuple(sorted(self.held)))


def _since(snap: Snapshot, newer: Snapshot) -> set[int]:
    """Buckets rewritten after ``snap`` up to ``newer`` (told by the manifests' contents, not by the versions between them)."""
    return {b for b, (a, z) in enumerate(zip(snap.buckets, newer.buckets, strict=True)) if a != z}


def upsert(spark: SparkSession, root: str, updates: DataFrame, now=None, base: Snapshot | None = None, keep_error: bool = False,
           claims: Callable[[dict], dict] = dict, max_attempts: int = MAX_ATTEMPTS) -> Commit:
    """Commit keyed updates: ``apply_updates`` on the newest version, rewriting the buckets of the updated ids only.

    ``updates`` (``archive_id, export_status, error_log, seq``) must be stable: staged or read from a committed table. Ids not in
    the ledger are ignored. ``base`` is the version the caller read (a stale one costs a second look, never an update)."""
    snap = base or snapshot(root)
    work = _Rewrite(spark, updates, now, keep_error)
    try:
        work.onto(snap, None)
        for attempt in range(1, max_attempts + 1):
            new = work.over(snap)
            new = Snapshot(new.root, new.version, new.buckets, claims(dict(new.claims)), new.touched)
            if _publish(new):
                work.drop(root, keep=new.buckets)
                return Commit(new, new.touched, attempt)
            newer = snapshot(root)
            work.onto(newer, _since(snap, newer))
            snap = newer
    except ClaimLost:
        work.drop(root)
        raise
    work.drop(root)
    raise CommitConflict(f"{max_attempts} attempts to commit after version {snap.version}")


def claim(spark: SparkSession, root: str, run: str, limit: int | None = C.DEFAULT_BATCH_SIZE, now=None, base: Snapshot | None = None,
          max_attempts: int = MAX_ATTEMPTS) -> Claim:
    """Take the first ``limit`` eligible rows in claim order (None: all of them) for ``run``: they become PROCESSING in the same
    commit that makes them the run's, so no other run gets any of them."""
    snap = base or snapshot(root)
    path, work = None, None
    for attempt in range(1, max_attempts + 1):
        if path is None:
            ledger = read(spark, snap)
            path = f"claims/{uuid.uuid4().hex}"
            (eligible(ledger) if limit is None else claim_first_batch(ledger, limit)).write.parquet(fsx.join(root, path))
            chosen = spark.read.schema(CLAIM_ROWS).parquet(fsx.join(root, path))
            ups = chosen.select("archive_id", F.lit(C.PROCESSING).alias("export_status"), F.lit(None).cast("string").alias("error_log"),
                                F.lit(0).cast("long").alias("seq"))
            work = _Rewrite(spark, ups, now, keep_error=True)
            work.onto(snap, None)
            if not work.touched:
                fsx.remove_tree(fsx.join(root, path))
                return Claim(snap, spark.createDataFrame([], CLAIM_ROWS), "", attempt)
        new = work.over(snap)
        mine = {**new.claims, run: (*new.claims.get(run, ()), path)}
        if _publish(Snapshot(new.root, new.version, new.buckets, mine, new.touched)):
            work.drop(root, keep=new.buckets)
            return Claim(snapshot(root, new.version), chosen, path, attempt)
        newer = snapshot(root)
        changed = _since(snap, newer)
        snap = newer
        both = sorted(changed & work.touched)
        there = eligible(read(spark, snap, both))
        mine = ups.where(bucket_of("archive_id", len(snap.buckets)).isin(both))
        if both and mine.join(there, "archive_id", "left_anti").limit(1).count():
            work.drop(root)      # another run has some of these ids: choose again
            fsx.remove_tree(fsx.join(root, path))
            path = None
        else:
            work.onto(snap, changed)
    raise CommitConflict(f"{max_attempts} attempts to claim after version {snap.version}")


def held_by(spark: SparkSession, snap: Snapshot, run: str) -> DataFrame:
    """The ledger rows that ``run`` has claimed and not finished."""
    paths = [fsx.join(snap.root, p) for p in snap.claims.get(run, ())]
    if not paths:
        return spark.createDataFrame([], LEDGER)
    claimed = spark.read.schema(CLAIM_ROWS).parquet(*paths).select("archive_id")
    n = len(snap.buckets)
    some = [r[0] for r in claimed.select(bucket_of("archive_id", n)).distinct().collect()]
    return read(spark, snap, some).where(F.col("export_status") == C.PROCESSING).join(claimed, "archive_id", "left_semi")


def finish(spark: SparkSession, root: str, run: str, done: Claim, updates: DataFrame, now=None) -> Commit:
    """Commit the outcome of one claim: ``updates`` name every row of it, and the claim ends in the same commit. A claim that
    was released meanwhile (the run was taken for dead) is refused with ``ClaimLost``: its rows may be another run's."""

    def end(claims: dict) -> dict:
        if done.path not in claims.get(run, ()):
            raise ClaimLost(f"{run} no longer holds {done.path}")
        left = tuple(p for p in claims[run] if p != done.path)
        return {**{r: p for r, p in claims.items() if r != run}, **({run: left} if left else {})}

    return upsert(spark, root, updates, now=now, base=done.snapshot, claims=end)


def release(spark: SparkSession, root: str, run: str, now=None) -> Commit | None:
    """Give a dead or finished run's unfinished rows back (PROCESSING -> PENDING) and forget its claims. Other runs keep theirs."""
    snap = snapshot(root)
    if run not in snap.claims:
        return None
    path = fsx.join(root, "claims", uuid.uuid4().hex)
    held_by(spark, snap, run).select("archive_id", F.lit(C.PENDING).alias("export_status"), F.lit(None).cast("string").alias("error_log"),
                                     F.lit(0).cast("long").alias("seq")).write.parquet(path)
    ups = spark.read.schema(UPDATE_ROWS).parquet(path)
    return upsert(spark, root, ups, now=now, base=snap, keep_error=True, claims=lambda c: {r: p for r, p in c.items() if r != run})


def expire(root: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions and the writes and claims that only they named. Only versions that no run
    still reads may go, and no commit may be under way."""
    found = versions(root)
    gone, kept = found[:-keep], [snapshot(root, v) for v in found[-keep:]]
    used = {w for s in kept for w in s.buckets}
    claimed = {p for s in kept for paths in s.claims.values() for p in paths}
    for v in gone:
        old = snapshot(root, v)
        for w in {w for w in old.buckets if w} - used:
            fsx.remove_tree(fsx.join(root, "data", w))
        for p in {p for paths in old.claims.values() for p in paths} - claimed:
            fsx.remove_tree(fsx.join(root, p))
        fsx.remove(_manifest(root, v))
    return gone
