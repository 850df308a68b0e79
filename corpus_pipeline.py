"""A training corpus from raw documents: language ID, line dedup, near-duplicate removal, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it back as the next stage's input. All stages but the last return the columns of ``docs``, whatever their names.

Nulls: a null text has no language (the first stage rejects it), no line, no shingle and no token; a null id is an id like any
other; null lang is filled in, null source is a source of its own. Repeated rows: one of an (id, text) is left by
``near_duplicates``, the other stages treat them alike. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zipledger.llm.common import stage
from zipledger.llm.decontaminate import drop_contaminated
from zipledger.llm.jaccard_join import keep_first
from zipledger.llm.language_id import fit, predict
from zipledger.llm.line_dedup import dedup_lines
from zipledger.llm.mixing import corpus_mix


def _free(docs: DataFrame, name: str, prefix: str = "_") -> str:
    """``name``, with ``prefix`` before it as often as it takes to meet no column of ``docs`` (in any letter case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = prefix + name
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; a missing label is filled with the prediction."""
    names = tuple(_free(docs, c) for c in ("_lang_pred", "_lang_score", "_lang_rejected"))
    found = predict(docs, fit(docs), names=names).where(f"not {names[2]}")
    return found.withColumn("lang", F.coalesce("lang", names[0])).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in their first document; a document that loses every line goes; ``n_chars`` follows the text."""
    done = dedup_lines(docs).where("n_dropped < n_lines")
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept_text")), "n_chars": F.when(
        F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays (five-word shingles, Jaccard similarity 0.8 or more)."""
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights: one row per document and epoch, with ``domain``, ``n_tokens`` and ``epoch`` added (under names
    with ``mix_`` before them where ``docs`` has such a column)."""
    new = ("domain", "n_tokens", "epoch")
    mix = corpus_mix(docs).select("doc", "text_key", *new).alias("m")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("m.doc")) & (F.col("d.key") == F.col("m.text_key"))
    return rows.join(mix, same).select(*[F.col("d.row").getField(c).alias(c) for c in docs.columns], *[F.col(f"m.{c}").alias(_free(docs, c, "mix_")) for c in new])


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("mix_sources", mix_sources)]

ORACLE_SQL = None  # a fitted classifier decides in the first stage: tests/llm holds each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
