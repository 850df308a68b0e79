"""Bulk content retrieval: HTTP-style fetch with retries, or lookup in a content table.

Both produce the same outcome columns, so everything downstream is agnostic:
``archive_id, fetch_ok, attempts_used, http_status, fetch_error, content``.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C

# fetcher(url, attempt) -> (http_status or None, body bytes or None, error text or None)
# A fetcher raises RequestBuildError when no request can be built for the URL:
# that fails the item at once, without retries.
Fetcher = Callable[[str, int], tuple]


class RequestBuildError(Exception):
    pass

FETCH_OUTCOME = T.StructType([
    T.StructField("archive_id", T.StringType(), False),
    T.StructField("fetch_ok", T.BooleanType(), False),
    T.StructField("attempts_used", T.IntegerType(), False),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("fetch_error", T.StringType(), True),
    T.StructField("content", T.BinaryType(), True),
    T.StructField("failure_kind", T.StringType(), True),  # api | network | request; NULL on success
])


def http_fetcher_factory(api_key: str, timeout: float = C.FETCH_TIMEOUT_SECONDS) -> Callable[[], Fetcher]:
    """Plain GET with the API key header. The whole body is read inside the attempt,
    so a read error counts as a failed attempt rather than a half-written entry."""

    def make() -> Fetcher:
        opener = urllib.request.build_opener()

        def fetch(url: str, attempt: int):
            try:
                req = urllib.request.Request(url, method="GET", headers={C.API_KEY_HEADER: api_key})
            except ValueError as e:
                raise RequestBuildError(str(e)) from e
            try:
                with opener.open(req, timeout=timeout) as resp:
                    return resp.status, resp.read(), None
            except urllib.error.HTTPError as e:
                return e.code, None, None
            except Exception as e:  # noqa: BLE001 - network failures become outcomes
                return None, None, str(e)

        return fetch

    return make


def _fetch_one(fetch: Fetcher, url: str, max_attempts: int, sleep: Callable[[float], None]):
    status, err = None, None
    for attempt in range(1, max_attempts + 1):
        try:
            status, body, err = fetch(url, attempt)
        except RequestBuildError as e:
            return False, attempt, None, str(e), None, "request"
        if err is None and status == C.HTTP_OK:
            return True, attempt, status, None, body if body is not None else b"", None
        if attempt < max_attempts:
            sleep(float(attempt * attempt))
    if status is not None:
        return False, max_attempts, status, None, None, "api"
    return False, max_attempts, None, err or "", None, "network"


def fetch_content(df: DataFrame, fetcher_factory: Callable[[], Fetcher], max_attempts: int = C.MAX_ATTEMPTS,
                  concurrency: int | None = None, threads_per_task: int = 8,
                  sleep: Callable[[float], None] = time.sleep, url_col: str = "url") -> DataFrame:
    """Fetch every row's URL with up to ``max_attempts`` tries (sleep attempt**2 s between).

    ``concurrency`` bounds the requests in flight (the rate-limit knob): it is split into
    partitions of up to ``threads_per_task`` threads. One fetcher per task.
    The result is nondeterministic and costly: stage it (``stage``) once and
    read the staged copy everywhere downstream.
    """
    rows = df.select("archive_id", url_col)
    if concurrency:
        threads_per_task = max(1, min(threads_per_task, concurrency))
        rows = rows.repartition(max(1, concurrency // threads_per_task))

    def run(batches):
        fetch = fetcher_factory()
        with ThreadPoolExecutor(max_workers=max(1, threads_per_task)) as pool:
            for pdf in batches:
                urls = pdf[url_col].tolist()
                res = list(pool.map(lambda u: _fetch_one(fetch, u, max_attempts, sleep), urls))
                yield pd.DataFrame({
                    "archive_id": pdf["archive_id"].tolist(),
                    "fetch_ok": [r[0] for r in res],
                    "attempts_used": [r[1] for r in res],
                    "http_status": pd.array([r[2] for r in res], dtype="Int32"),
                    "fetch_error": [r[3] for r in res],
                    "content": [r[4] for r in res],
                    "failure_kind": [r[5] for r in res],
                })

    return rows.mapInPandas(run, FETCH_OUTCOME)


def resolve_content(df: DataFrame, content: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """Bodies that already live in a table: a left join on archive_id.

    A missing row is reported like a 404 from the server (all attempts used).
    Copies of one id in the content table collapse to one body first (a
    partial aggregate, so a much-copied id is combined map-side and never
    multiplies rows); the join reuses that aggregate's partitioning."""
    one = content.groupBy("archive_id").agg(F.max("content").alias("content"))
    found = F.col("content").isNotNull()
    return df.select("archive_id").join(one, "archive_id", "left").select(
        "archive_id",
        found.alias("fetch_ok"),
        F.when(found, 1).otherwise(max_attempts).cast("int").alias("attempts_used"),
        F.when(found, C.HTTP_OK).otherwise(404).cast("int").alias("http_status"),
        F.lit(None).cast("string").alias("fetch_error"),
        "content",
        F.when(~found, F.lit("api")).alias("failure_kind"),
    )


def attempt_rule_fetcher_factory(body: Callable[[str], bytes] | None = None) -> Callable[[], Fetcher]:
    """A fetcher whose answers follow the attempt rule of the test tables
    (``sources.adapters.attempts_from_manifest``): the item id is the last URL
    segment; status 200 / 503 / 204 / no response by (id, attempt)."""

    def make() -> Fetcher:
        def fetch(url: str, attempt: int):
            i = int(url.rsplit("/", 1)[-1])
            h = (i * 7 + attempt * 3) % 5
            if h < 1:
                return 200, (body(url) if body else url.encode()), None
            if h < 3:
                return 503, None, None
            if (i + attempt) % 5 == 4:
                return 204, None, None
            return None, None, "timeout"

        return fetch

    return make
