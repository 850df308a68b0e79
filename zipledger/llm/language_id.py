"""Language ID: nearest of several centroids per language over TF-IDF character n-grams.

Method: byte n-grams (1 to 3) of the text's lower-cased letters are hashed to ``DIMS`` features, weighted by
log term frequency and inverse document frequency and normalised. Each language gets ``CENTROIDS`` spherical
k-means centroids; a text takes the language of the centroid with the largest cosine. A text is rejected if
it has no letter, or if its distance to that centroid exceeds the reject distance of its length class.

Fit: document frequencies come from all training rows (one vector of ``DIMS`` counts per task is summed). The
centroids are fitted on at most ``SAMPLE`` rows per language, the ones with the smallest hash of their id and
text (a documented bound); clustering runs on the executors, one group of at most ``SAMPLE`` vectors per language.
The reject distance of a length class (powers of two of the number of letters) is the largest distance of the
sampled training rows of that class, the class below or longer ones to their own language's centroids, times
``SLACK`` (beyond the longest class seen, that class's), ``NEAR`` at least and ``FAR`` at most. The classes under ``MIN_LETTERS``
letters also count pieces of the sampled rows cut to that length, as short texts are farther from every centroid. The
model (languages x CENTROIDS x DIMS floats) goes through the driver; its size doesn't depend on the corpus,
given the number of languages.

Defined results: null text or text without a letter: ``und``, score 0, rejected. No training rows: every text is
``und``. Score is the cosine, 0 to 1; ties go to the language that sorts first. Every input row comes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import with_fields

DIMS, SAMPLE, CENTROIDS, SLACK, NEAR, FAR, MIN_LETTERS = 4096, 600, 4, 1.15, 0.35, 0.97, 32
UNKNOWN = "und"
_MARKS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in bytes(range(256)).lower())


def features(text: str | None) -> tuple[np.ndarray, int]:
    """(log term frequencies of the hashed n-grams as float32, number of letters as bytes) of a whole text."""
    if not text or not any(map(str.isalpha, text)):
        return np.zeros(DIMS, np.float32), 0
    raw = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_MARKS).split())
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, len(raw), 1 << 16):  # pieces overlap by two bytes, so memory doesn't grow with the text
        b = np.frombuffer(b" " + raw[max(at - 1, 0):at + (1 << 16)] + b" ", np.uint8).astype(np.uint32)
        two = b[:-1] << np.uint32(8) | b[1:]
        three = b[:-2] << np.uint32(16) | two[1:]
        for gram, seed in ((b, 0x85EBCA6B), (two, 0x27D4EB2F), (three, 0x165667B1)):
            h = (gram * np.uint32(0x9E3779B1) + np.uint32(seed)) >> np.uint32(20)
            counts += np.bincount(h, minlength=DIMS)
    return np.log1p(counts).astype(np.float32), len(raw) - raw.count(b" ")


def _length_class(letters: int) -> int:
    return max(0, int(letters)).bit_length()


def _pieces(text: str) -> list[str]:
    """The start of a text cut to 2, 4, 8, .. letters' bytes under ``MIN_LETTERS`` or so: whole words, one at least."""
    out, found = [], text[:4 * MIN_LETTERS].split()
    for bits in range(1, MIN_LETTERS.bit_length()):
        taken, room = [], 2 ** bits - 1
        for word in found:
            size = len(word.encode("utf-8", "surrogatepass"))
            if taken and size > room:
                break
            taken.append(word)
            room -= size
        out.append(" ".join(taken))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                tf, letters = features(text.as_py())
                if letters:
                    total += tf > 0
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(DIMS + 1), pa.int32()), pa.array([*total.tolist(), n], pa.int64())], names=["dim", "n"])

    rows = train.select("text").mapInArrow(run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows
    out = np.zeros(DIMS + 1, np.int64)
    for r in rows:
        out[r["dim"]] = r["n"]
    return out[:DIMS], int(out[DIMS])


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean and then the rows farthest from what is chosen."""
    k = min(k, len(vectors))
    chosen = [int(np.argmax(vectors @ vectors.mean(0)))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen].copy()
    for _ in range(rounds):
        best = np.argmax(vectors @ centres.T, axis=1)
        for j in range(k):
            if (best == j).any():
                centres[j] = vectors[best == j].mean(0)
        centres = _unit(centres)
    return centres


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> dict:
    """Model from the rows of ``train`` with text, a letter and a language."""
    rows = train.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h")).where(
        F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    df, n = _document_frequencies(rows)
    if not n:
        return {"langs": [], "idf": None, "centres": None, "owner": None, "reach": {}}
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    # a bounded sample per language: first the hash range that holds a little more than SAMPLE rows, then the cut
    # of distinct (id, text), so that repeated rows neither narrow the range nor fill the sample
    counts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("h").alias("n"))
    part = rows.join(F.broadcast(counts), "lang").where(  # one row per language
        (F.col("h").bitwiseAND(F.lit((1 << 40) - 1))) <= (F.lit(float(1 << 40)) * F.least(F.lit(1.0), F.lit(SAMPLE * 1.3 + 100) / F.col("n")))).dropDuplicates(["lang", "h"])
    in_lang = Window.partitionBy("lang").orderBy(F.col("h").bitwiseAND(F.lit((1 << 40) - 1)), "h", "text")
    sample = part.withColumn("i", F.row_number().over(in_lang)).where(F.col("i") <= SAMPLE).select("lang", "text")

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [features(t) for t in pdf["text"]]
        vectors = _unit(np.array([tf * idf for tf, _ in found], np.float32))
        centres = _clusters(vectors, CENTROIDS)
        short = [f for t in pdf["text"] for f in map(features, _pieces(t)) if 0 < f[1] < MIN_LETTERS]
        if short:
            found += short
            vectors = np.concatenate([vectors, _unit(np.array([tf * idf for tf, _ in short], np.float32))])
        best = (vectors @ centres.T).max(1)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "centres": [centres.tobytes()],
                             "classes": [[_length_class(n) for _, n in found]], "distances": [(1 - best).astype(float).tolist()]})

    fitted = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, centres binary, classes array<int>, distances array<double>").collect(),
                    key=lambda r: r["lang"])  # one row per language, a bounded number of distances each
    reach: dict[int, float] = {}
    for r in fitted:
        for c, d in zip(r["classes"], r["distances"], strict=True):
            for shorter in range(c + 2 if c >= MIN_LETTERS.bit_length() else c + 1):
                reach[shorter] = max(reach.get(shorter, 0.0), d)
    centres = [np.frombuffer(r["centres"], np.float32).reshape(-1, DIMS) for r in fitted]
    return {"langs": [r["lang"] for r in fitted], "idf": idf, "centres": np.concatenate(centres),
            "owner": np.repeat(np.arange(len(fitted)), [len(c) for c in centres]), "reach": reach}


def predict(docs: DataFrame, model: dict, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the predicted language, its cosine, and whether the distance rule rejects it. Only the text is used."""
    if set(names) & set(docs.columns):
        raise ValueError(f"columns {names} exist; name others")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = []
            for text in batch.column(text_col):
                tf, letters = features(text.as_py())
                if not letters or not m["langs"]:
                    out.append((UNKNOWN, 0.0, True))
                    continue
                cos = m["centres"] @ _unit(tf * m["idf"])
                best = int(np.argmax(cos))
                score = float(min(1.0, max(0.0, cos[best])))
                reach = m["reach"][min(_length_class(letters), max(m["reach"]))]
                limit = min(FAR, max(NEAR, reach * SLACK))
                out.append((m["langs"][m["owner"][best]], score, 1 - score > limit))
            cols = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    schema = with_fields(docs.schema, (names[0], "string"), (names[1], "double"), (names[2], "boolean"))
    return docs.mapInArrow(run, schema)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null"))) % folds == fold


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs.where(~out))
    return predict(docs.select("doc_id", out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
