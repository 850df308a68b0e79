"""Status commits bounded by size and time, and the job's progress kept up from them.

``commit_timed``: finished ids wait in the state of their lane (a hash of the id, so no key is hot) until ``batch_size`` of
them are there or the oldest has waited ``interval_seconds`` of processing time, then leave as one commit of the update log.
Ids wait in state store and checkpoint, not in the driver; a restart on the same checkpoint goes on with them.

``stream_progress``: reads the update log as a stream and keeps, for each group of ids, their last counted status as state
(loaded once from the ledger's base version). A micro-batch reads its own log rows only and writes one row: by how much the
counts of completed and failed ids change. ``progress_now`` adds these rows to the base counts, so the numbers are there while
the job runs and the ledger is not read again.
"""

from __future__ import annotations

import json
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import constants as C
from ..functions import as_timestamp
from ..operators.ledger import completion_updates, progress_stats
from ..sinks import fs as fsx
from .commit import LOG_SCHEMA

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PENDING = T.StructType([T.StructField("archive_id", T.StringType())])
_OPEN = T.StructType([T.StructField("waiting", T.LongType()), T.StructField("commits", T.LongType())])
COMMIT_ROWS = T.StructType([
    T.StructField("archive_id", T.StringType()),
    T.StructField("lane", T.LongType()),
    T.StructField("commit_no", T.LongType()),   # a commit of a lane: these rows reach the log together
    T.StructField("waited_ms", T.LongType()),   # of the oldest row, at most; 0 when the commit was full
])


def _state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)


class TimedCommits(StatefulProcessor):
    """One lane. Waiting ids are a list in state, how many and the number of commits so far a value; a timer stands
    exactly while ids wait, set when the first of them came."""

    def __init__(self, batch_size: int, interval_ms: int):
        self.size, self.interval = batch_size, interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _PENDING)
        self.open = handle.getValueState("open", _OPEN)

    def _counts(self) -> tuple[int, int]:
        return self.open.get() if self.open.exists() else (0, 0)

    def _commit(self, key, ids: list, number: int, waited: int) -> pd.DataFrame:
        return pd.DataFrame({"archive_id": ids, "lane": key[0], "commit_no": number, "waited_ms": waited})

    def handleInputRows(self, key, rows, timerValues):
        waiting, commits = self._counts()
        begun_with = waiting
        new: list = []
        for pdf in rows:
            for aid in pdf["archive_id"].tolist():
                new.append((aid,))
                if waiting + len(new) == self.size:
                    ids = [r[0] for r in self.pending.get()] if waiting else []
                    self.pending.clear()
                    yield self._commit(key, ids + [r[0] for r in new], commits, 0)
                    new, waiting, commits = [], 0, commits + 1
        if new and waiting:
            self.pending.appendList(new)
        elif new:
            self.pending.put(new)
        waiting += len(new)
        kept = begun_with and commits == self._counts()[1]   # the oldest id is still the one the timer was set for
        if not kept:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            if waiting:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.interval)
        self.open.update((waiting, commits))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        waiting, commits = self._counts()
        if waiting:
            late = timerValues.getCurrentProcessingTimeInMs() - expiredTimerInfo.getExpiryTimeInMs()
            yield self._commit(key, [r[0] for r in self.pending.get()], commits, self.interval + max(late, 0))
            self.pending.clear()
            self.open.update((0, commits + 1))

    def close(self) -> None:
        pass


def timed_commits(completions: DataFrame, batch_size: int = C.DEFAULT_FLUSH_BATCH,
                  interval_seconds: float = C.DEFAULT_FLUSH_INTERVAL_SECONDS, lanes: int = 64) -> DataFrame:
    """Streaming ids -> the same ids grouped into commits (``COMMIT_ROWS``): at most ``batch_size`` rows each."""
    if batch_size < 1 or lanes < 1 or interval_seconds <= 0:
        raise ValueError("batch_size, lanes and interval_seconds must be positive")
    _state_store(completions.sparkSession)
    rows = completions.select("archive_id", F.pmod(F.xxhash64("archive_id"), F.lit(lanes)).alias("lane"))
    return rows.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=TimedCommits(batch_size, int(interval_seconds * 1000)), outputStructType=COMMIT_ROWS,
        outputMode="Update", timeMode="ProcessingTime")


def commit_timed(spark: SparkSession, completions: DataFrame, log_root: str, checkpoint: str, now=None,
                 batch_size: int = C.DEFAULT_FLUSH_BATCH, interval_seconds: float = C.DEFAULT_FLUSH_INTERVAL_SECONDS,
                 lanes: int = 64) -> StreamingQuery:
    """``completions`` (a stream with ``archive_id``) -> commits in the update log that ``streaming.commit`` reads. A trigger
    without a commit leaves nothing in the log. The query runs until it is stopped (see ``drain``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()   # looked at, then written: the lanes run once
        try:
            if not batch.isEmpty():
                ups = completion_updates(batch, seq=F.lit(batch_id)).withColumn("updated_at", as_timestamp(now))
                ups.write.mode("overwrite").parquet(fsx.join(log_root, f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    trigger = max(interval_seconds / 4, 0.5)   # an expired timer is seen at the next trigger
    return (timed_commits(completions, batch_size, interval_seconds, lanes).writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(processingTime=f"{int(trigger * 1000)} milliseconds")
            .foreachBatch(write).start())


def drain(query: StreamingQuery, interval_seconds: float, timeout_seconds: float = 600) -> None:
    """Stop a ``commit_timed`` query when its source has been quiet for longer than the interval and a trigger that began
    after that is done: every timer has expired by then, so nothing waits in state. (``processAllAvailable`` doesn't return
    here: timers keep batches coming.)"""
    give_up, fed_until, last_fed = time.time() + timeout_seconds, time.time(), -1
    while time.time() < give_up:
        if query.exception():
            raise query.exception()
        last = query.lastProgress
        if last and last["numInputRows"] and last["batchId"] > last_fed:
            fed_until, last_fed = time.time(), last["batchId"]
        began = pd.Timestamp(last["timestamp"]).timestamp() if last else 0
        never_fed = last_fed < 0 and time.time() > fed_until + interval_seconds + 1 and not query.status["isTriggerActive"]
        if began > fed_until + interval_seconds or never_fed:
            query.stop()
            return
        time.sleep(0.05)
    query.stop()
    raise TimeoutError(f"the stream did not become quiet in {timeout_seconds} seconds")


# ---- progress while running --------------------------------------------------------------

GROUP_IDS = 2_000   # ids that a group has on average, at most
_STATUSES = T.StructType([T.StructField("statuses", T.StringType())])
_CHANGE = T.StructType([T.StructField("completed", T.LongType()), T.StructField("failed", T.LongType())])


class StatusCounts(StatefulProcessor):
    """One group of ids: (seq, status) of each as one value, so a micro-batch reads and writes the state of a group once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("statuses", _STATUSES)

    def _known(self) -> dict:
        return json.loads(self.state.get()[0]) if self.state.exists() else {}

    def handleInitialState(self, key, initialState, timerValues):
        known = self._known()
        known.update((aid, [-1, status or ""]) for aid, status in zip(initialState["archive_id"], initialState["export_status"]))
        self.state.update((json.dumps(known),))

    def handleInputRows(self, key, rows, timerValues):
        known, change = self._known(), {C.COMPLETED: 0, C.FAILED: 0}
        for pdf in rows:
            for aid, status, seq in zip(pdf["archive_id"].tolist(), pdf["export_status"].tolist(), pdf["seq"].tolist()):
                was, now = known.get(aid), [int(seq), status or ""]
                if was is None or now <= was:   # not in the ledger, or an earlier (or the same) update
                    continue
                known[aid] = now
                for counted, by in ((was[1], -1), (now[1], 1)):
                    if counted in change:
                        change[counted] += by
        self.state.update((json.dumps(known),))
        if any(change.values()):
            yield pd.DataFrame({"completed": [change[C.COMPLETED]], "failed": [change[C.FAILED]]})

    def close(self) -> None:
        pass


def stream_progress(spark: SparkSession, base: DataFrame, log_root: str, progress_root: str, checkpoint: str,
                    groups: int = 1024, available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Follow the update log and keep (completed, failed, total) under ``progress_root``: one small record a micro-batch, the
    counts after it. ``base`` is the ledger the log started from; it is read once, when the checkpoint is new. There are
    ``groups`` groups of ids, or more where the ledger has more than ``GROUP_IDS`` ids for each: their number is settled
    when the checkpoint is new and recorded beside the counts. Ids must be there; updates of ids
    that the ledger doesn't have count nothing; of one id's updates the highest (seq, status) counts, as in ``apply_updates``."""
    _state_store(spark)
    if not fsx.exists(fsx.join(progress_root, "start")):
        fsx.makedirs(progress_root)
        counts = progress_stats(base).first().asDict()
        fsx.write_text(fsx.join(progress_root, "groups"), json.dumps(max(groups, -(-counts["total"] // GROUP_IDS))))
        fsx.write_text(fsx.join(progress_root, "start"), json.dumps(counts))
    if fsx.exists(fsx.join(progress_root, "groups")):   # else a checkpoint from before it was recorded
        groups = json.loads(fsx.read_text(fsx.join(progress_root, "groups")))
    group = F.pmod(F.xxhash64("archive_id"), F.lit(groups)).alias("lane")

    def write(batch: DataFrame, batch_id: int) -> None:
        change = batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("completed", "failed")]).first()
        before = _record(progress_root, batch_id - 1)
        counts = {**before, "completed": before["completed"] + change["completed"], "failed": before["failed"] + change["failed"]}
        fsx.write_text(fsx.join(progress_root, f"after-{batch_id}"), json.dumps(counts))

    log = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        log = log.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = log.parquet(log_root).select("archive_id", "export_status", "seq", group)
    counted = rows.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=StatusCounts(), outputStructType=_CHANGE, outputMode="Update", timeMode="None",
        initialState=base.select("archive_id", "export_status", group).groupBy("lane"))
    w = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def _record(progress_root: str, batch_id: int) -> dict:
    name = "start" if batch_id < 0 else f"after-{batch_id}"
    return json.loads(fsx.read_text(fsx.join(progress_root, name)))


def progress_now(spark: SparkSession, progress_root: str) -> DataFrame:
    """``progress_stats`` of the ledger as of the last micro-batch: one row, from one small record."""
    done = [int(n.split("-", 1)[1]) for n in fsx.list_dir(progress_root) if n.startswith("after-")]
    r = _record(progress_root, max(done, default=-1))
    return spark.createDataFrame([(r["completed"], r["failed"], r["total"])], "completed long, failed long, total long")
