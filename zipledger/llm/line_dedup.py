"""Line dedup: keep the first document's occurrence of every repeated line (DataFrame functions only).

Method: line hashes are range-partitioned, sorted within by document, and streamed with running
windows that know the first document of each hash; what comes back per document is not text but a
run-length bitmap of its kept lines.

Skew: a line may stand in a third of all documents. The range key is therefore (hash, slice) with
the slice taken from the document, as many slices as shuffle partitions. A row that isn't in the
first document of its slice is dropped for certain; the others (at most one document a slice) meet
in a second window, while the decided rows travel under keys of their own. No group grows beyond
1/partitions of a hot line's rows, no join on lines is needed and nothing is broadcast.

Defined results: a null or empty text is one empty line; rows of one ``doc_id`` (repeated rows too)
count as one document when lines are compared, and each row loses its own lines; a null ``doc_id`` is
an id like any other that sorts first. Lines are told apart by 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, let, partitions


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, text_key, n_dropped, keep_runs) for each document that loses lines; ``keep_runs`` lists its
    kept lines as (start, length) runs of 0-based line numbers."""
    slices = partitions(docs.sparkSession)
    lines = (docs.select(F.col(f"`{id_col}`").alias("doc"), _text(text_col).alias("text"))
             .select("doc", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .select("doc", "text_key", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
             .select("doc", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc"), F.lit(slices)).cast("int").alias("slice")))
    in_slice = Window.partitionBy("h1", "h2", "slice").orderBy("doc")
    # the range exchange already keeps (h1, h2, slice) together: the window adds a sort, no exchange
    first = (lines.repartitionByRange("h1", "h2", "slice")
             .withColumn("late", ~F.col("doc").eqNullSafe(F.first("doc").over(in_slice)))
             .withColumn("apart", F.when(F.col("late"), F.xxhash64("doc", "pos")).otherwise(F.lit(0))))
    overall = Window.partitionBy("h1", "h2", "late", "apart").orderBy("doc")
    dropped = first.withColumn("first_doc", F.first("doc").over(overall)).where(
        F.col("late") | ~F.col("doc").eqNullSafe(F.col("first_doc")))
    # a document's own lines meet in one row: bounded by the text they came from
    per_doc = dropped.groupBy("doc", "text_key").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    return per_doc.select("doc", "text_key", F.size("gone").cast("long").alias("n_dropped"), _runs(F.col("gone")).alias("keep_runs"))


def _runs(gone: Column) -> Column:
    """The gaps between the dropped line numbers; the last run is open (length -1: to the end)."""
    def gap(g, i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(g, i - 1) + 1)
        end = F.when(i == F.size(g), F.lit(None).cast("int")).otherwise(F.get(g, i))
        return F.struct(start.alias("start"), F.coalesce(end - start, F.lit(-1)).alias("len"))
    return let(gone, lambda g: F.filter(F.transform(F.sequence(F.lit(0), F.size(g)), lambda i: gap(g, i)), lambda r: r["len"] != 0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with ``n_lines``, ``n_dropped`` and ``kept_text`` (the kept lines joined
    by \\n). Every input row comes back once."""
    bitmaps = line_bitmaps(docs, id_col, text_col, min_chars).alias("b")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc"),
                       F.xxhash64(_text(text_col)).alias("text_key")).alias("d")
    joined = rows.join(bitmaps, F.col("d.doc").eqNullSafe(F.col("b.doc")) & (F.col("d.text_key") == F.col("b.text_key")), "left")
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))

    def kept(lines):
        part = lambda r: F.slice(lines, r["start"] + 1, F.when(r["len"] < 0, F.size(lines)).otherwise(r["len"]))
        return F.struct(F.size(lines).cast("long").alias("n"), F.when(F.col("keep_runs").isNull(), text).otherwise(
            F.array_join(F.flatten(F.transform("keep_runs", lambda r: F.when(r["start"] < F.size(lines), part(r)).otherwise(
                F.array().cast("array<string>")))), "\n")).alias("text"))

    return (joined.select("row", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                          let(F.split(text, "\n"), kept).alias("kept"))
            .select("row", F.col("kept.n").alias("n_lines"), "n_dropped", F.col("kept.text").alias("kept_text")))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
marked AS (
  SELECT doc_id, pos, line, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
