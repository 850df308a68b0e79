"""Document fingerprints by Order MinHash (DataFrame functions only).

Method (Marcais et al. 2019): a text's k-mers (here of ``k`` words; the last k - 1 are shorter) are numbered
by occurrence, each (k-mer, number) gets a hash, ``m`` hash orders each select the ``l`` smallest, which are put
back into text order, and the tuple is hashed to one element of the signature. Two signatures' share of
equal elements falls with the edit distance, also when words only change places.

The m orders are rotations of one hash: order j compares (hash - j/m) on the unit circle, so each selects
the first ``l`` hashes at or after its own point (one-permutation hashing with rotation). One sorted
array serves all orders: a text costs one hash and one sort per word, whatever m is, and short texts need no
special case. An element is 16 bits, four hex digits.

Skew and scale: one document is one row; the work is linear (n log n for the sort) in its words and no
step groups documents. Texts are shuffled once, to meet the head of their successor.

Defined results: null text is empty; an empty or blank text has the one k-mer of the empty word; equal texts
have equal fingerprints. Positions beyond 4 million words share one position when tuples are ordered. Rows of
one id share the successor; the successor of several rows of one id is their smallest head, its
fingerprint the smallest one. A null id is an id that sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_global_rank
from .common import let, stage, words

M_ORDERS, L_TUPLE, K_WORDS = 64, 2, 3
_POS_BITS = 22
_HASH_BITS = 63 - _POS_BITS
_POS, _HASH = (1 << _POS_BITS) - 1, (1 << _HASH_BITS) - 1


def _pack(h: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, 64 - _HASH_BITS), _POS_BITS).bitwiseOR(pos.cast("long"))


def _hash(x: Column) -> Column:
    return F.shiftright(x, _POS_BITS)


def _numbered(q: Column) -> Column:
    """Sorted (hash, position) longs -> the same with the hash of every further copy of a k-mer mixed with its number."""
    firsts = F.filter(q, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(q, i - 1))))
    copies = F.filter(q, lambda x, i: (i > 0) & (_hash(x) == _hash(F.get(q, i - 1))))

    def number(d):
        starts = F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: (i == 0) | (_hash(F.get(d, i)) != _hash(F.get(d, i - 1))))
        run = lambda s, e: F.transform(F.sequence(s, e - 1), lambda t: _pack(
            F.xxhash64(_hash(F.get(d, t)), t - s + 1), F.get(d, t).bitwiseAND(F.lit(_POS))))
        return let(starts, lambda st: F.flatten(F.transform(st, lambda s, j: run(s, F.coalesce(F.get(st, j + 1), F.size(d))))))

    return let(copies, lambda d: F.when(F.size(d) == 0, firsts).otherwise(F.sort_array(F.concat(firsts, number(d)))))


def order_minhash(text: Column, m: int = M_ORDERS, l: int = L_TUPLE, k: int = K_WORDS) -> Column:  # noqa: E741
    """The fingerprint of a text, ``4 * m`` hex digits. ``m`` is a power of two."""
    shift = 63 - (m.bit_length() - 1)
    own = let(words(text), lambda w: F.when(F.size(w) == 0, F.array(F.lit(""))).otherwise(w))
    kmers = lambda ws: F.sort_array(F.transform(ws, lambda w, i: _pack(
        F.xxhash64(w, *[F.get(ws, i + j) for j in range(1, k)]), F.least(i, F.lit(_POS)))))
    bucket = lambda x: F.shiftright(x, shift)
    # the first l hashes after any of the m points are among the first l of their intervals
    near = lambda p: F.filter(p, lambda x, i: (i < l) | (bucket(x) != bucket(F.get(p, i - l))))
    points = [j << shift for j in range(m)]

    def elements(s):
        merged = F.sort_array(F.concat(s, F.array(*[F.lit(p).cast("long") for p in points])))

        def element(at):  # at: how many selected hashes lie before the order's point
            tuple_ = F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(l - 1)), lambda t: let(
                F.get(s, ((at + t) % F.size(s)).cast("int")), lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POS)), _HASH_BITS).bitwiseOR(_hash(x)))))
            h = F.xxhash64(F.transform(tuple_, lambda y: y.bitwiseAND(F.lit(_HASH))))
            return F.substring(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(0x10000)))), 2, 4)

        return let(merged, lambda ms: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda j: element(
            F.array_position(ms, F.shiftleft(j.cast("long"), shift)) - 1 - j)), ""))

    return let(own, lambda ws: let(kmers(ws), lambda q: let(_numbered(q), lambda p: let(near(p), elements))))


def likeness(a: Column, b: Column, m: int = M_ORDERS) -> Column:
    """The share of equal elements of two fingerprints, 0 to 1."""
    part = lambda f, j: F.substring(f, j * 4 + 1, F.lit(4))
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(m - 1)), lambda j: part(a, j) == part(b, j))) / F.lit(float(m))


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, next_key, head_chars): each id's successor in ascending order (the last one's is the first) and a
    quarter of its longest text's length. Ids only; positions come from a distributed sort."""
    ids = docs.groupBy(F.col(f"`{id_col}`").alias("doc")).agg(F.max(F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("n"))
    ranked = with_global_rank(ids, [F.col("doc").asc_nulls_first()], "rank").select(_key(F.col("doc")).alias("key"), "n", "rank")
    total = ranked.count()
    before = ranked.select("key", F.floor(F.col("n") / 4).cast("int").alias("head_chars"), (F.col("rank") % max(total, 1) + 1).alias("rank"))
    return before.join(ranked.select(F.col("key").alias("next_key"), "rank"), "rank").drop("rank")


def _key(doc: Column) -> Column:
    return F.coalesce(F.concat(F.lit("v"), doc.cast("string")), F.lit("null"))


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its text with the last quarter replaced by the head of the next document, and
    their likeness to each other and to the next document's."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = texts.schema["doc"].dataType
    keyed = texts.select(_key(F.col("doc")).alias("key"), "text")
    nexts = stage(successors(texts, "doc", "text"), "successors")
    # both joins read the same columns, so the one exchange of the texts by key serves them
    heads = (keyed.join(nexts.withColumnsRenamed({"key": "for_key", "next_key": "key"}), "key")
             .groupBy("for_key").agg(F.min(F.substring(F.col("text"), F.lit(1), F.col("head_chars"))).alias("head")))
    both = keyed.join(heads.withColumnRenamed("for_key", "key"), "key", "left").withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")),
                      F.substring(F.coalesce("head", F.lit("")), F.lit(1), cut))
    prints = both.select("key", "n_chars", "text", edited.alias("edited")).select(
        "key", "n_chars", F.unhex(F.sha2("edited", 256)).alias("sha"), F.unhex(order_minhash(F.col("text"))).alias("print"),
        F.unhex(order_minhash(F.col("edited"))).alias("edited_print"))
    prints = stage(prints, "fingerprints")  # in binary: half the bytes to store and to move
    after = prints.groupBy("key").agg(F.min("print").alias("next_print")).withColumnRenamed("key", "next_key")
    hexed = lambda c, name: F.lower(F.hex(c)).alias(name)
    done = prints.join(nexts.select("key", "next_key").join(after, "next_key"), "key", "left").select(
        F.when(F.col("key") != "null", F.substring("key", 2, 2**31 - 1)).cast(kind).alias("doc"), "n_chars", hexed("sha", "edited_sha256"),
        hexed("print", "fingerprint"), hexed("edited_print", "edited_fingerprint"), hexed("next_print", "next_fingerprint"))
    return done.select("doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op1_fingerprint(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fingerprint_with_edits(docs).withColumnRenamed("doc", "doc_id")
