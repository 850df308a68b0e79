"""Bodies as chunk rows ``(archive_id, copy, chunk_no, chunk)``, so that no body sits whole in Arrow or Python.

``chunk_bodies`` cuts the bodies of a content table inside Spark; ``fetch_chunks`` streams responses block by block
from a server. Both go, staged, into ``sinks.zip_source``, which appends chunks to an open archive entry.
"""

from __future__ import annotations

import http.client
import queue
import threading
import time
import urllib.parse
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .fetch import RequestBuildError

CHUNK_BYTES = 4 << 20
FETCHED = ("archive_id string, attempt int, chunk_no int, chunk binary, fetch_ok boolean, attempts_used int, http_status int, "
           "fetch_error string, failure_kind string")

# streamer(url, attempt) -> (http_status or None, iterator of byte blocks or None, error text or None); the iterator
# may raise, which fails the attempt. RequestBuildError: no request can be built, the item fails at once.
Streamer = Callable[[str, int], tuple]


def chunk_bodies(content: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of a content table, cut in one pass. A null body has none (a miss), an empty one has one empty chunk. ``copy``
    is the body's hash: of several bodies for one id the writer takes the one with the smallest and skips the rest."""
    rows = content.where(F.col("content").isNotNull()).select("archive_id", "content", F.xxhash64("content").alias("copy"))
    last = F.greatest(F.ceil(F.octet_length("content") / F.lit(chunk_bytes)).cast("int"), F.lit(1)) - 1
    cut = rows.select("archive_id", "copy", "content", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    return cut.select("archive_id", "copy", "chunk_no", F.substring(F.col("content"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("chunk"))


# -- streaming fetch -----------------------------------------------------------------------------

def http_streamer_factory(api_key: str, timeout: float = C.FETCH_TIMEOUT_SECONDS, block: int = 1 << 20,
                          connect=http.client.HTTPConnection) -> Callable[[], Streamer]:
    """GET with the API key header, read in blocks. Each thread keeps one connection per host and uses it again; a kept
    connection that the server has closed is opened anew once before the attempt counts as failed."""

    def make() -> Streamer:
        local = threading.local()

        def request(url: str):
            parts = urllib.parse.urlsplit(url)
            if parts.scheme != "http" or not parts.hostname:
                raise RequestBuildError(f"unsupported protocol scheme: {url!r}")
            try:
                host = (parts.hostname, parts.port or 80)
            except ValueError as e:
                raise RequestBuildError(str(e)) from e
            kept = local.__dict__.setdefault("kept", {})
            for fresh in (host not in kept, True):
                con = kept[host] = connect(*host, timeout=timeout) if fresh else kept[host]
                try:
                    con.request("GET", parts.path + (f"?{parts.query}" if parts.query else ""), headers={C.API_KEY_HEADER: api_key})
                    return con, con.getresponse()
                except http.client.InvalidURL as e:
                    raise RequestBuildError(str(e)) from e
                except (http.client.HTTPException, OSError):
                    con.close()
                    kept.pop(host, None)
                    if fresh:
                        raise
            raise AssertionError("unreachable")

        def fetch(url: str, attempt: int):
            try:
                con, answer = request(url)
            except (http.client.HTTPException, OSError) as e:
                return None, None, str(e) or type(e).__name__
            if answer.status != C.HTTP_OK:
                answer.read()  # drained, so that the connection can be used again
                return answer.status, None, None

            def blocks():
                done = False
                try:
                    while part := answer.read(block):
                        yield part
                    done = True
                finally:
                    if not done:  # broken off: what is left of this answer must not meet the next request
                        con.close()

            return answer.status, blocks(), None

        return fetch

    return make


def _attempts(stream: Streamer, archive_id: str, url: str, max_attempts: int, sleep: Callable[[float], None]) -> Iterator[tuple]:
    """Chunk rows of every attempt, then one outcome row (chunk_no -1)."""
    status = error = None
    for attempt in range(1, max_attempts + 1):
        try:
            status, blocks, error = stream(url, attempt)
            if error is None and status == C.HTTP_OK:
                n = 0
                for n, part in enumerate(blocks or (), 1):
                    yield archive_id, attempt, n - 1, part, None, None, None, None, None
                if not n:
                    yield archive_id, attempt, 0, b"", None, None, None, None, None
                yield archive_id, attempt, -1, None, True, attempt, status, None, None
                return
        except Exception as e:  # noqa: BLE001
            # by name: a streamer from an installed module brings its own copy of the class to the task
            if any(c.__name__ == RequestBuildError.__name__ for c in type(e).__mro__):
                yield archive_id, attempt, -1, None, False, attempt, None, str(e), "request"
                return
            status, error = None, str(e) or type(e).__name__  # broke off inside the body: a failed attempt
        if attempt < max_attempts:
            sleep(float(attempt * attempt))
    kind = "api" if status is not None else "network"
    yield archive_id, max_attempts, -1, None, False, max_attempts, status, None if status is not None else error or "", kind


def fetch_chunks(df: DataFrame, streamer_factory: Callable[[], Streamer], max_attempts: int = C.MAX_ATTEMPTS, concurrency: int | None = None,
                 threads_per_task: int = 8, batch_bytes: int = 8 << 20, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Fetch ``(archive_id, url)`` rows as chunk rows, those of failed attempts included, and an outcome row per id. Stage the
    result (it is nondeterministic and costly), then ``fetched_outcomes`` and ``fetched_chunks``.

    A task holds at most the blocks that its threads have in hand, two queued ones each, and a batch of ``batch_bytes``."""
    rows = df.select("archive_id", "url")
    if concurrency:
        threads_per_task = max(1, min(threads_per_task, concurrency))
        rows = rows.repartition(max(1, concurrency // threads_per_task))
    schema = [f.split()[0] for f in FETCHED.split(", ")]
    types = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, made, stop = streamer_factory(), queue.Queue(2 * threads_per_task), threading.Event()

        def put(item) -> None:
            while not stop.is_set():
                try:
                    return made.put(item, timeout=1)
                except queue.Full:
                    continue

        def work(todo: queue.SimpleQueue) -> None:
            try:
                while not stop.is_set():
                    item = todo.get()
                    if item is None:
                        break
                    for row in _attempts(stream, *item, max_attempts, sleep):
                        put(row)
            except BaseException as e:  # noqa: BLE001 - handed to the task's own thread
                put(e)
            put(None)

        def flush(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=schema)

        try:
            for batch in batches:
                todo: queue.SimpleQueue = queue.SimpleQueue()
                for item in zip(batch.column("archive_id").to_pylist(), batch.column("url").to_pylist(), strict=True):
                    todo.put(item)
                threads = [threading.Thread(target=work, args=(todo,), daemon=True) for _ in range(threads_per_task)]
                for t in threads:
                    todo.put(None)
                    t.start()
                some, size, left = [], 0, len(threads)
                while left:
                    row = made.get()
                    if row is None:
                        left -= 1
                        continue
                    if isinstance(row, BaseException):
                        raise row
                    some.append(row)
                    size += len(row[3] or b"") + 64
                    if size >= batch_bytes:
                        yield flush(some)
                        some, size = [], 0
                if some:
                    yield flush(some)
        finally:
            stop.set()

    return rows.mapInArrow(run, FETCHED)


def fetched_outcomes(staged: DataFrame) -> DataFrame:
    """One row per id: the outcome columns of ``sources.fetch``."""
    return staged.where("chunk_no = -1").select("archive_id", "fetch_ok", "attempts_used", "http_status", "fetch_error", "failure_kind")


def fetched_chunks(staged: DataFrame) -> DataFrame:
    """Chunk rows of the attempt that succeeded; what failed attempts left goes."""
    won = staged.where("chunk_no = -1 AND fetch_ok").select("archive_id", F.col("attempts_used").alias("attempt"))
    return staged.where("chunk_no >= 0").join(won, ["archive_id", "attempt"], "left_semi").select(
        "archive_id", F.lit(0).cast("long").alias("copy"), "chunk_no", "chunk")
