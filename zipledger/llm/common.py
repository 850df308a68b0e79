"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh3_64_intdigest

from ..session import checkpoint_root

SPACE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character unchanged (the fast path serves pure ASCII)."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def words(col: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]``; no words for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(col, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def with_fields(schema: StructType, *fields: tuple[str, str]) -> StructType:
    """A schema and (name, type) fields after it (``StructType.add`` would change the frame's own schema)."""
    return StructType(schema.fields + StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields)).fields)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``, scheme kept."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: what follows neither recomputes it
    nor depends on the executors that made it."""
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- word hashes (numpy side) ------------------------------------------------------------------

class WordHash(dict):
    """bytes -> 64-bit hash, remembered for the words a task meets again and again."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | None, cache: WordHash, lower: bool) -> np.ndarray:
    """64-bit hashes of the words of a text (``bytes.split()`` splits at exactly ``[\\x20\\x09-\\x0D]+``)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = (raw.lower() if lower else raw).split()
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))



_MUL = np.uint64(0x9E3779B97F4A7C15)
_FIN = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _FIN
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``len(w) - k + 1`` runs of ``k`` consecutive words (none if there are fewer words)."""
    n = len(w) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = w[:n].copy()
    for j in range(1, k):
        out = mix(out * _MUL + np.uint64(j)) + w[j:j + n]
    return mix(out)


def shingle_set(w: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingle hashes; fewer words: the whole sequence as one; no word: empty."""
    if len(w) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(w, min(k, len(w))))


# -- compact sorted keys -----------------------------------------------------------------------

def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as a first key and differences of 2, 4, 6 or 8 bytes, the least that fits all."""
    if len(keys) == 0:
        return b""
    diff = keys[1:] - keys[:-1]
    top = int(diff.max()) if len(diff) else 0
    width = next(w for w in (2, 4, 6, 8) if top < 1 << 8 * w)
    return bytes([width]) + keys[:1].tobytes() + diff.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, blob[0])
    diff = np.zeros((len(body) + 1, 8), np.uint8)
    diff[0] = np.frombuffer(blob, np.uint8, 8, offset=1)
    diff[1:, :blob[0]] = body
    return np.cumsum(diff.reshape(-1).view(np.uint64), dtype=np.uint64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash space: ascending keys have ascending shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """Borders of each shard's slice in an array sorted by shard."""
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


NULL_ID = np.iinfo(np.int64).min  # stands for a null id: sorts first


def ordered_ids(ids: np.ndarray) -> np.ndarray:
    """int64 ids as uint64 in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def id_column(name: str) -> Column:
    """An integer id column as a long that is never null."""
    return F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(NULL_ID))
