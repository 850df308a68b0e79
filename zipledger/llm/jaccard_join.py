"""N-gram Jaccard join: exact set-similarity self-join of documents, as components of similar documents.

A document's set holds its distinct ``k``-word shingles; two documents link when 100 * |A & B| >= percent * |A | B|.

Method: set relations are used to skip work that an index join would repeat.

1. Equal sets are one class: everything below handles each distinct set once.
2. Index: each distinct shingle goes to the shard of its hash range, which knows how many sets hold it. A set
   links to another only if at least percent of its shingles are in another set too, so most sets end here.
3. Block skipping by position: shingles are ordered by (frequency, hash); two sets that link share one
   of the first n - ceil(t n) + 1 positions. Shingles of frequency 1 fill the first positions of an
   edited copy and shorten its list entries further. Lists of one entry are skipped.
4. Derived answers: all lists led by the same set (the smallest member) form one group, so sets that are
   in many lists together are compared once, not once a list. In a group, sets go by ascending size and sizes
   beyond the bound end a scan. Every pair is verified by exact intersection of whole sets; a pair that is in
   several groups is the smallest common leader's, so each link is found once and nothing has to drop repeats.
5. Each set's links are counted where they are found, weighted by the documents of the other set, and every group
   hands on a spanning forest of its links: these form components (min-label propagation with pointer jumping, on
   Spark). ``similar_pairs`` hands on the links themselves.

Skew: a group larger than ``tile`` members is cut into tiles and every pair of tiles is a group of its
own, so one hot shingle's list never sits in one task; only counts and spanning links leave a group, all pairs only
for ``similar_pairs``.
Shards hold hash ranges; a shingle in a third of all sets has one 8-byte entry per set. Nothing is broadcast and
nothing is collected.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; fewer than ``k`` words: the whole
sequence is the one shingle; null, empty or blank text: empty set, linked with nothing. Ids are integers; a null id
is returned as null and sorts first. Rows of one id count as one document if their text is the same, else each
text links on its own and the id's component is the smallest of them. Sets are of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import (NULL_ID, WordHash, by_shard, id_column, pack_keys, partitions, shard_of, shingle_set, stage, unpack_keys,
                     word_hashes)

TILE = 4096


def _signature(s: np.ndarray) -> int:
    return int(np.uint64(xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _send(batches: Iterator[pa.RecordBatch], k: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Rows for the shards: a batch's shingle hashes in the shard's range, with the sets that hold them."""
    cache, seen_limit = WordHash(), 200_000
    seen: set[int] = set()  # sets sent by this task before: copies add nothing to the index
    for batch in batches:
        sigs, sizes, keys = [], [], []
        for text in batch.column("text"):
            s = shingle_set(word_hashes(text.as_py(), cache, lower=True), k)
            sig = _signature(s)
            if len(s) and sig not in seen:
                if len(seen) >= seen_limit:
                    seen.clear()
                seen.add(sig)
                sigs.append(sig)
                sizes.append(len(s))
                keys.append(s)
        if not keys:
            continue
        owner = np.repeat(np.arange(len(keys), dtype=np.uint32), sizes)
        flat = np.concatenate(keys)
        del keys
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        at = by_shard(shard_of(flat, shards), shards)
        sigs, sizes, out = np.array(sigs, np.int64), np.array(sizes, np.int64), []
        for p in np.flatnonzero(np.diff(at)):
            own, index = np.unique(owner[at[p]:at[p + 1]], return_inverse=True)
            out.append((int(p), pack_keys(flat[at[p]:at[p + 1]]), sigs[own].tobytes(), sizes[own].astype(np.uint32).tobytes(),
                        index.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (
            pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["shard", "keys", "sigs", "sizes", "index"])


def _shared(pdf: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The shard's shingles that at least two sets hold, sent on to the sets' buckets with their frequency."""
    keys, sigs, sizes = [], [], []
    for kb, sb, nb, ib in zip(pdf["keys"], pdf["sigs"], pdf["sizes"], pdf["index"], strict=True):
        own = np.frombuffer(sb, np.int64)
        index = np.frombuffer(ib, np.uint16 if len(own) <= 1 << 16 else np.uint32)
        keys.append(unpack_keys(kb))
        sigs.append(own[index])
        sizes.append(np.frombuffer(nb, np.uint32)[index])
    keys, sigs, sizes = np.concatenate(keys), np.concatenate(sigs), np.concatenate(sizes)
    order = np.lexsort((sigs, keys))
    keys, sigs, sizes = keys[order], sigs[order], sizes[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sigs[1:] != sigs[:-1])])  # a set sent by several tasks counts once
    keys, sigs, sizes = keys[new], sigs[new], sizes[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    runs = np.diff(np.append(starts, len(keys)))
    freq = np.repeat(runs, runs)
    more = freq > 1
    keys, sigs, sizes, freq = keys[more], sigs[more], sizes[more], freq[more]
    bucket = sigs.view(np.uint64) % np.uint64(buckets)
    order = np.lexsort((sigs, bucket))
    keys, sigs, sizes, freq = keys[order], sigs[order], sizes[order], freq[order]
    at, out = by_shard(bucket[order], buckets), []
    for b in np.flatnonzero(np.diff(at)):
        part = slice(at[b], at[b + 1])
        first = np.flatnonzero(np.concatenate([[True], sigs[part][1:] != sigs[part][:-1]]))
        out.append((int(b), sigs[part][first].tobytes(), sizes[part][first].tobytes(),
                    np.diff(np.append(first, at[b + 1] - at[b])).astype(np.uint32).tobytes(), keys[part].tobytes(),
                    np.minimum(freq[part], 2**32 - 1).astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["bucket", "sigs", "sizes", "counts", "keys", "freq"])


def _candidates(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Sets that can link at all: their shared shingles and the ones among them in the prefix."""
    sigs = np.concatenate([np.repeat(np.frombuffer(s, np.int64), np.frombuffer(c, np.uint32)) for s, c in zip(pdf["sigs"], pdf["counts"], strict=True)])
    sizes = np.concatenate([np.repeat(np.frombuffer(s, np.uint32), np.frombuffer(c, np.uint32)) for s, c in zip(pdf["sizes"], pdf["counts"], strict=True)])
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
    freq = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["freq"]])
    order = np.lexsort((keys, freq, sigs))
    sigs, sizes, keys = sigs[order], sizes[order], keys[order]
    starts = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
    out = []
    for a, b in zip(starts, np.append(starts[1:], len(sigs)), strict=True):
        n = int(sizes[a])
        need = -(-n * percent // 100)  # the least overlap that any link of this set has
        if b - a >= need:
            prefix = keys[a:a + (b - a) - need + 1]
            out.append((int(sigs[a]), n, np.sort(keys[a:b]).tobytes(), prefix.view(np.int64).tolist()))
    return pd.DataFrame(out, columns=["sig", "n", "shared", "prefix"])


def _group_links(sets: list[np.ndarray], sizes: np.ndarray, percent: int, side: np.ndarray, across: bool,
                 leaders: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(j, the members before j that link to it, the overlaps): each link of one group. Members come by ascending size.
    ``across``: the group is a pair of different tiles, sides 1 and 2, whose inner pairs are another group's. ``leaders``
    are each member's leaders before this group's: a pair that shares one of them is that leader's."""
    m = len(sets)
    if m <= 12:
        for j in range(1, m):
            near, inter = [], []
            for i in range(j - 1, -1, -1):
                if 100 * int(sizes[i]) < percent * int(sizes[j]):
                    break  # sizes only fall from here: the rest of the block is out of reach
                if (across and side[i] == side[j]) or len(np.intersect1d(leaders[i], leaders[j], assume_unique=True)):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (int(sizes[i]) + int(sizes[j]) - both):
                    near.append(i)
                    inter.append(both)
            if near:
                yield j, np.array(near), np.array(inter)
        return
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    tokens, index = np.unique(flat, return_inverse=True)
    order = np.lexsort((owner, index))
    lists, ends = owner[order], np.searchsorted(index[order], np.arange(len(tokens) + 1))
    led: dict[int, list[int]] = {}
    for j, before in enumerate(leaders):
        for x in before.tolist():
            led.setdefault(x, []).append(j)
    theirs = {x: np.array(js) for x, js in led.items()}
    at = 0
    for j in range(m):
        mine = index[at:at + len(sets[j])]
        at += len(sets[j])
        begin, stop = ends[mine], ends[mine + 1]
        count = stop - begin
        spread = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        over = np.bincount(lists[spread], minlength=m)
        ok = 100 * over >= percent * (sizes + sizes[j] - over)
        ok[j:] = False
        if across:
            ok &= side != side[j]
        for x in leaders[j].tolist():
            ok[theirs[x]] = False
        near = np.flatnonzero(ok)
        if len(near):
            yield j, near, over[near]


def _verify(pdf: pd.DataFrame, percent: int, pairs: bool) -> pd.DataFrame:
    """All groups of one shard, one after another. ``pairs``: each link (a, b) with its overlap n. Else what grows with the
    sets only: links (a, b) that span each group's components, and for each set a (b null) its links here, n documents."""
    pdf = pdf.sort_values(["leader", "i", "j", "n", "sig"], kind="stable")
    codes = pdf[["leader", "i", "j"]].to_numpy()
    new = np.concatenate([[True], (codes[1:] != codes[:-1]).any(axis=1)]) if len(pdf) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sigs, sizes, side, docs = (pdf[c].to_numpy().astype(np.int64) for c in ("sig", "n", "side", "n_docs"))
    blobs, led = pdf["shared"].tolist(), pdf["leaders"].tolist()
    out_a, out_b, out_n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    counted, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
        if b - a < 2:
            continue
        sig, n_docs, links, label = sigs[a:b], docs[a:b], np.zeros(b - a, np.int64), np.arange(b - a)
        leaders = [np.asarray(x, np.int64) for x in led[a:b]]
        found = _group_links([np.frombuffer(x, np.uint64) for x in blobs[a:b]], sizes[a:b], percent, side[a:b],
                             bool(codes[a, 1] != codes[a, 2]), [x[x < codes[a, 0]] for x in leaders])
        for j, near, inter in found:
            links[j] += n_docs[near].sum()
            links[near] += n_docs[j]
            if not pairs:
                met, first = np.unique(label[near], return_index=True)  # one link to each component so far
                label[np.isin(label, met)] = j
                near, inter = near[first], inter[first]
            out_a.append(np.minimum(sig[near], sig[j]))
            out_b.append(np.maximum(sig[near], sig[j]))
            out_n.append(inter)
        counted.append(sig[links > 0])
        counts.append(links[links > 0])
    out = pd.DataFrame({"a": np.concatenate(out_a), "b": pd.array(np.concatenate(out_b), "Int64"), "n": np.concatenate(out_n)})
    if pairs:
        return out
    return pd.concat([out, pd.DataFrame({"a": np.concatenate(counted), "b": pd.array([None] * sum(map(len, counted)), "Int64"),
                                         "n": np.concatenate(counts)})], ignore_index=True)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node each node of ``links`` reaches. Each round hooks components onto the smallest
    neighbour label and halves paths; every round is written to the shared folder."""
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = stage(pairs.union(pairs.select("v", "u")).where("u <> v").distinct(), "edges")
    label = stage(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        best = (edges.join(label.withColumnsRenamed({"node": "v", "label": "lv"}), "v").groupBy("u").agg(F.min("lv").alias("m")))
        hooked = label.join(best, label["node"] == best["u"], "left").select("node", "label", F.least("label", "m").alias("new"))
        # a root takes the best offer made to any of its members, then everyone jumps to the root's label
        offers = hooked.groupBy("label").agg(F.min("new").alias("offer")).withColumnRenamed("label", "root")
        step = hooked.join(offers, hooked["label"] == offers["root"]).select("node", "label", F.col("offer").alias("to"))
        up = label.select(F.col("node").alias("to"), F.col("label").alias("jump"))
        after = stage(step.join(up, "to", "left").select("node", F.least("to", F.coalesce("jump", "to")).alias("label"),
                                                        (F.least("to", F.coalesce("jump", "to")) != F.col("label")).alias("moved")), "labels")
        done = after.where("moved").limit(1).count() == 0
        label = after.select("node", "label")
        if done:
            return label


def _links(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, tile: int, pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(each distinct (id, text) with its set, the sets with ``n_docs`` and their first document, the rows of ``_verify``)."""
    spark = docs.sparkSession
    n = 2 * partitions(spark)
    rows = docs.select(id_column(id_col).alias("doc"), F.col(f"`{text_col}`").alias("text")).withColumn("text_key", F.xxhash64("text"))
    meta = stage(rows.mapInArrow(lambda it: _meta(it, k), "doc long, text_key long, n_shingles long, sig long").distinct(), "sets")
    classes = meta.where("n_shingles > 0").groupBy("sig").agg(F.min(F.struct("doc", "text_key")).alias("first"), F.count("doc").alias("n_docs"))

    sent = rows.select("text").mapInArrow(lambda it: _send(it, k, n), "shard int, keys binary, sigs binary, sizes binary, index binary")
    shared = sent.groupBy("shard").applyInPandas(lambda pdf: _shared(pdf, n), "bucket int, sigs binary, sizes binary, counts binary, keys binary, freq binary")
    cand = stage(shared.groupBy("bucket").applyInPandas(
        lambda pdf: _candidates(pdf, percent), "sig long, n int, shared binary, prefix array<long>"), "candidates")

    entries = cand.select("sig", F.explode("prefix").alias("token"))
    heads = entries.groupBy("token").agg(F.min("sig").alias("leader"), F.count("sig").alias("m")).where("m > 1").select("token", "leader")
    members = stage(entries.join(heads, "token").select("leader", "sig").distinct(), "members")
    sizes = members.groupBy("leader").agg(F.count("sig").alias("m")).where("m > 1").select(
        "leader", F.ceil(F.col("m") / tile).cast("int").alias("tiles"))
    tiled = (members.join(sizes, "leader").withColumn("s", F.pmod(F.xxhash64("sig"), "tiles").cast("int"))
             .select("leader", "sig", "s", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
             .select("leader", "sig", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j"),
                     F.when(F.col("s") <= F.col("o"), 1).otherwise(2).alias("side")))
    leaders = members.groupBy("sig").agg(F.collect_list("leader").alias("leaders"))  # no longer than the set's prefix
    grouped = (tiled.join(cand.select("sig", "n", "shared"), "sig").join(leaders, "sig").join(classes.select("sig", "n_docs"), "sig")
               .withColumn("part", F.pmod(F.xxhash64("leader", "i", "j"), F.lit(4 * n)).cast("int")))
    found = grouped.groupBy("part").applyInPandas(lambda pdf: _verify(pdf, percent, pairs), "a long, b long, n long")
    return meta, classes, stage(found, "links")


def _id_back(c: str) -> Column:
    return F.when(F.col(c) != NULL_ID, F.col(c)).alias(c.replace(".", "_"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """(doc, text_key, n_shingles, component, component_key, n_docs, n_links) for each distinct (id, text): ``component`` is
    the smallest id reachable by links, ``component_key`` the smallest text key there, ``n_docs`` the number of documents with exactly this set and ``n_links`` the number of other
    documents that link to this one (equal sets included)."""
    meta, classes, found = _links(docs, id_col, text_col, k, percent, tile, pairs=False)
    labels = components(found.where("b IS NOT NULL"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("sig")).agg(F.sum("n").alias("linked"))
    classes = (classes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").join(counts, "sig", "left")
               .withColumn("label", F.coalesce("label", "sig")).withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("n_docs") - 1))
    first = classes.groupBy("label").agg(F.min("first").alias("c"))
    named = classes.join(first, "label").select("sig", F.col("c.doc").alias("component"), F.col("c.text_key").alias("component_key"), "n_docs", "n_links")
    cols = ["doc", "text_key", "n_shingles", "component", "component_key", "n_docs", "n_links"]
    out = meta.where("n_shingles > 0").join(named, "sig").select(*cols).union(
        meta.where("n_shingles = 0").select("doc", "text_key", "n_shingles", "doc", "text_key", F.lit(1).cast("long"), F.lit(0).cast("long")).toDF(*cols))
    return out.select(*[_id_back(c) if c in ("doc", "component") else c for c in cols])


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """(a_doc, a_text_key, a_n_docs, b_doc, b_text_key, b_n_docs, n_shared): every link between different sets, once. A
    set is named by its first document and stands for ``n_docs`` of them. The rows are as many as the links."""
    _, classes, found = _links(docs, id_col, text_col, k, percent, tile, pairs=True)
    end = lambda c: classes.select(F.col("sig").alias(c), F.struct("first.doc", "first.text_key", "n_docs").alias(f"{c}_set"))
    both = found.join(end("a"), "a").join(end("b"), "b").select(
        F.least("a_set", "b_set").alias("a"), F.greatest("a_set", "b_set").alias("b"), F.col("n").alias("n_shared"))
    return both.select(*[x for s in "ab" for x in (_id_back(f"{s}.doc"), F.col(f"{s}.text_key").alias(f"{s}_text_key"),
                                                   F.col(f"{s}.n_docs").alias(f"{s}_n_docs"))], "n_shared")


def _meta(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for batch in batches:
        counts, sigs = [], []
        for text in batch.column("text"):
            s = shingle_set(word_hashes(text.as_py(), cache, lower=True), k)
            counts.append(len(s))
            sigs.append(_signature(s))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(sigs, pa.int64())],
                                         names=["doc", "text_key", "n_shingles", "sig"])


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component stays, the one with the smallest id and, of those, the smallest text key; columns
    unchanged. An (id, text) is one document: of its repeated rows one stays, also without a shingle or an id."""
    found = similar_components(docs, id_col, text_col, **how)
    gone = (found.where(~(F.col("doc").eqNullSafe(F.col("component")) & (F.col("text_key") == F.col("component_key"))))
            .select(id_column("doc").alias("_doc"), F.col("text_key").alias("_key")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_column(id_col).alias("_doc"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("_key")).join(gone, ["_doc", "_key"], "left_anti")
    others = [F.col("row").getField(f.name) for f in docs.schema if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
    same = Window.partitionBy("_doc", "_key").orderBy(*(others or [F.col("_key")]))
    return rows.withColumn("_i", F.row_number().over(same)).where("_i = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = similar_components(docs, k=4, percent=85)
    return found.groupBy(F.col("doc").alias("doc_id")).agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component_id"))


OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE list_transform(range(1, greatest(len(ws) - 3, 1) + 1),
      lambda i: array_to_string(ws[i:i+3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""
