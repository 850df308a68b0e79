"""Benchmark decontamination: test items inside documents, by size-partitioned min-wise sketches (DataFrame functions only).

Method: containment search by minimal hashes. Items are partitioned by the size of their shingle set
(powers of two). An item of n shingles that a document contains to the share t has at most n - ceil(t n)
shingles missing, so one of its k = n - ceil(t n) + 1 smallest shingle hashes is in the document: those k
are its sketch, and a size partition needs from documents only hashes up to its largest sketch hash. A
document's own fixed-length MinHash can't do this: 33 shingles among 20,000 have a Jaccard similarity of
0.0016, which no banding finds surely; the one-sided sketch has no false negative at any length.
Candidates are verified by exact containment of shingle strings.

Scale: documents are exploded into hashes below the bound, probed and reduced to (document, item) pairs
before any shuffle. The sketches are broadcast only if their counted rows stay under ``broadcast_rows``,
else the same join shuffles. A passage in a third of all documents makes pairs keyed by document, so no
group grows with it.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` of the lower-cased text; fewer words than a
shingle: the whole sequence is the only shingle, on both sides, and such an item is also looked for as a run of its own
length in longer texts (op8 leaves this out, as its SQL does); null, empty or blank texts have none and match
nothing. Repeated rows give each (document, item) pair once, with its largest count; ids may be null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words


def _shingle_hashes(text: Column, k: int) -> Column:
    grams = lambda ws: F.when(F.size(ws) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(ws) - k, F.lit(0))), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)])))
    return let(words(F.lower(text)), grams)


def _shingles(text: Column, k: int) -> Column:
    grams = lambda ws: F.when(F.size(ws) == 0, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(ws) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(ws, i, k), " ")))
    return F.array_distinct(let(words(F.lower(text)), grams))


def _runs(text: Column, width: int, each: Callable[[Column], Column], kind: str) -> Column:
    """``each`` of the runs of ``width`` words; none if there are fewer words."""
    return let(words(F.lower(text)), lambda ws: F.when(F.size(ws) >= width, F.transform(
        F.sequence(F.lit(1), F.size(ws) - width + 1), lambda i: each(F.slice(ws, i, width)))).otherwise(F.array().cast(f"array<{kind}>")))


def _run_hashes(text: Column, width: int, bound: int) -> Column:
    """As an item of so few words is hashed: absent words leave xxhash64 unchanged."""
    found = _runs(text, width, lambda r: F.xxhash64(*[F.get(r, F.lit(j)) for j in range(width)]), "bigint")
    return F.filter(found, lambda h: h <= F.lit(bound))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", k: int = 5, percent: int = 80, broadcast_rows: int = 2_000_000,
                    short: bool = True) -> DataFrame:
    """(doc, text_key, item, n_item_shingles, n_shared) for every document text that holds at least ``percent`` per
    cent of an item's distinct ``k``-word shingles; ``text_key`` tells texts of one id apart. ``short``: items of fewer than
    ``k`` words are also found inside longer texts, as runs of their own length."""
    its = (items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("item_text")).distinct()
           .withColumn("item_key", F.xxhash64("item", "item_text"))
           .withColumn("hashes", F.sort_array(F.array_distinct(_shingle_hashes(F.col("item_text"), k)))).where(F.size("hashes") > 0)
           .withColumn("width", F.least(F.size(words(F.lower("item_text"))), F.lit(k))))
    n = F.size("hashes")
    need = F.ceil(n * percent / 100)
    sketch = its.select("item_key", "width", F.floor(F.log2(n)).alias("part"), F.explode(F.slice(
        "hashes", F.lit(1), (n - need + 1).cast("int"))).alias("h"))
    bounds = sketch.groupBy("width", "part").agg(F.max("h").alias("bound"), F.count("h").alias("n")).collect()  # widths by powers of two
    small = sum(r["n"] for r in bounds) <= broadcast_rows
    bound = max((r["bound"] for r in bounds), default=-(2**63))
    widths = {r["width"]: r["bound"] for r in bounds if short and r["width"] < k}  # a short item is its one shingle
    if widths:
        bound = max((r["bound"] for r in bounds if r["width"] == k), default=-(2**63))
    hint = F.broadcast if small else (lambda df: df)

    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")).withColumn("text_key", F.xxhash64("text"))
    hashes = [F.filter(_shingle_hashes(F.col("text"), k), lambda h: h <= F.lit(bound)),
              *[_run_hashes(F.col("text"), w, top) for w, top in sorted(widths.items())]]
    low = texts.select("doc", "text_key", F.explode(F.array_distinct(F.concat(*hashes)) if widths else hashes[0]).alias("h"))
    pairs = low.join(hint(sketch.select("h", "item_key")), "h").select("doc", "text_key", "item_key").distinct()
    cand = pairs.groupBy("doc", "text_key").agg(F.collect_set("item_key").alias("item_keys"))  # at most the items, per document

    c, t = cand.alias("c"), texts.alias("t")
    doc_shingles = _shingles(F.col("t.text"), k)
    for w in sorted(widths):
        doc_shingles = F.array_union(doc_shingles, _runs(F.col("t.text"), w, lambda r: F.array_join(r, " "), "string"))
    found = (t.join(c, F.col("t.doc").eqNullSafe(F.col("c.doc")) & (F.col("t.text_key") == F.col("c.text_key")))
             .select("t.doc", "t.text_key", doc_shingles.alias("doc_shingles"), "item_keys")
             .withColumn("item_key", F.explode("item_keys")).drop("item_keys"))
    exact = its.select("item_key", "item", _shingles(F.col("item_text"), k).alias("shingles"))
    return (found.join(hint(exact), "item_key")
            .select("doc", "text_key", "item", F.size("shingles").cast("long").alias("n_item_shingles"),
                    F.size(F.array_intersect("shingles", "doc_shingles")).cast("long").alias("n_shared"))
            .where(F.col("n_shared") * 100 >= F.col("n_item_shingles") * percent))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose text holds an item; columns unchanged."""
    hit = contained_items(docs, items, id_col, text_col, **how).select("doc", "text_key").distinct().alias("h")
    return docs.alias("d").join(hit, F.col(f"d.`{id_col}`").eqNullSafe(F.col("h.doc")) & (
        F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("h.text_key")), "left_anti")


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    pairs = contained_items(docs, items, short=False).groupBy("doc", "item").agg(F.max(F.struct("n_shared", "n_item_shingles")).alias("m"))
    return pairs.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("m.n_item_shingles").alias("n_item_shingles"),
                        F.col("m.n_shared").alias("n_shared"), (F.col("m.n_shared") / F.col("m.n_item_shingles")).alias("containment"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
       lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
       lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM bs GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
FROM p JOIN n USING (item_id) WHERE n_shared * 100 >= n_item_shingles * 80
"""
