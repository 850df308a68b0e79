"""Substring dedup: remove passages of at least ``window`` words that an earlier document has.

A window is ``window`` consecutive words of one document. Each word covered by a window whose word sequence
also starts in a document with a smaller id is removed: matching statistics against all earlier documents,
cut at the threshold, and the maximal spans above it go.

Method: suffix automata of reference shards. A shard holds all windows of its anchors: the anchor of a window is the
least hash of its ``ANCHOR``-word runs, so equal windows meet in one shard and consecutive windows mostly share an
anchor. Such a run of windows is one segment of text. Each shard builds generalised suffix automata of its distinct
segments, in ascending order of their first documents, every state labelled with the first document of its
strings; then the segments stream through: where the matching statistic reaches ``window``, the label of the state
that holds the window's words is the first document with them. Segments of anchors that one document alone has are
not sent. The automata are not broadcast: the reference is the corpus itself, which has no size bound, and a
stream of all documents through all shards would be the square of it. Here work and shuffle are linear in the words.

Three exchanges by hash: anchors (6 bytes and a count each) and two bits back; segments, as word codes; the first
document of each window back. Skew: equal anchors and segments collapse to one entry per bucket of documents before
they are sent. An anchor with more than ``crowd`` occurrences sends single windows, sharded by their own hash, so
neither an automaton nor a shard grows with one frequent phrase. A shard's segments go to ``PARTS`` automata by
anchor range, one held at a time. Buckets are hash ranges of (id, text); nothing is broadcast.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged; null, empty or blank texts have none; texts
shorter than a window keep all. Ids are integers; a null id sorts first; rows of one id are one document for
the comparison (a window repeated inside one document is not removed). Repeated rows each come back.
Words are told apart by 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (_MUL, NULL_ID, WordHash, by_shard, gram_hashes, id_column, mix, ordered_ids, pack_keys, partitions,
                     shard_of, unpack_keys, word_hashes)

WINDOW = 13
ANCHOR = 5
CROWD = 1 << 14
PARTS = 64
SEEN, MATCHED = 0, 1  # kinds of answers


class SuffixAutomaton:
    """Of several word sequences; ``first[state]`` is the owner of the earliest added one that holds its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]

    def _state(self, moves: dict, link: int, length: int, owner) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(owner)
        return len(self.link) - 1

    def _reach(self, state: int, word) -> int:
        """The state after ``word``, split off where it also holds longer strings than ``state`` gives."""
        old = self.next[state][word]
        size = self.length[state] + 1
        if self.length[old] == size:
            return old
        new = self._state(dict(self.next[old]), self.link[old], size, self.first[old])
        self.link[old] = new
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def add(self, sequence: list, owner) -> None:
        moves, link, last = self.next, self.link, 0
        for word in sequence:
            if word in moves[last]:
                last = self._reach(last, word)
                continue
            at, last = last, self._state({}, 0, self.length[last] + 1, owner)
            while at >= 0 and word not in moves[at]:
                moves[at][word] = last
                at = link[at]
            if at >= 0:
                link[last] = self._reach(at, word)

    def first_owners(self, sequence: list, window: int) -> list:
        """For each place where the longest match reaches ``window`` words: the first owner of the last ``window``."""
        moves, link, length, out = self.next, self.link, self.length, []
        state = size = 0
        for word in sequence:
            while state and word not in moves[state]:
                state = link[state]
                size = length[state]
            if word in moves[state]:
                state = moves[state][word]
                size += 1
            if size >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    size = length[state]
                out.append(self.first[state])
        return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``count`` values long."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _encode(values: np.ndarray) -> bytes:
    """Distinct values and narrow indexes into them."""
    table, index = np.unique(values, return_inverse=True)
    width = next(w for w in (1, 2, 4) if len(table) <= 1 << 8 * w)
    return bytes([width]) + len(table).to_bytes(8, "little") + table.tobytes() + index.astype(f"u{width}").tobytes()


def _decode(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[1:9], "little")
    return np.frombuffer(blob, np.uint64, size, 9)[np.frombuffer(blob, f"u{blob[0]}", offset=9 + 8 * size)]


class _Bucket:
    """A bucket of documents in ascending id order: their words, and their segments of windows with one anchor."""

    def __init__(self, pdf: pd.DataFrame, window: int):
        self.window, self.rows = window, pdf.sort_values("doc", kind="stable")
        self.ids = ordered_ids(self.rows["doc"].to_numpy())
        cache = WordHash()
        found = [word_hashes(t, cache, lower=False) for t in self.rows["text"]]
        self.counts = np.array([len(w) for w in found], np.int64)
        self.words = np.concatenate([np.zeros(0, np.uint64), *found])
        self.owner = np.repeat(np.arange(len(found)), self.counts)
        del found
        n, width = max(len(self.words) - window + 1, 0), min(ANCHOR, window)
        runs = gram_hashes(self.words, width)
        least, offset = runs[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - width + 1):
            less = runs[j:j + n] < least
            least[less] = runs[j:j + n][less]
            offset[less] = j
        starts = np.flatnonzero(self.owner[:n] == self.owner[window - 1:]) if n else np.zeros(0, np.int64)
        place = starts + offset[starts]
        head = np.ones(len(starts), bool)
        head[1:] = (np.diff(starts) != 1) | (np.diff(place) != 0)
        self.starts, heads = starts[head], np.flatnonzero(head)
        self.sizes = np.diff(np.append(heads, len(starts)))
        self.anchors = mix(least[self.starts])
        self.keys, self.inverse = np.unique(self.anchors, return_inverse=True)

    def seeds(self) -> np.ndarray:
        """For each distinct anchor its occurrences, and in the highest bit whether several documents have it."""
        total = np.bincount(self.inverse, minlength=len(self.keys))
        low = np.full(len(self.keys), len(self.ids), np.int64)
        high = np.zeros(len(self.keys), np.int64)
        at = self.owner[self.starts]
        np.minimum.at(low, self.inverse, at)
        np.maximum.at(high, self.inverse, at)
        several = self.ids[low] != self.ids[high] if len(low) else np.zeros(0, bool)
        return np.minimum(total, (1 << 31) - 1).astype(np.uint32) | several.astype(np.uint32) << np.uint32(31)

    def _window_hash(self, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for j in range(self.window):
            out = mix(out * _MUL + np.uint64(j)) + self.words[starts + j]
        return mix(out)

    def pick(self, seen: np.ndarray, crowded: np.ndarray, shards: int) -> None:
        """Segments with an anchor of several documents; crowded anchors' segments as single windows; the distinct ones."""
        split = crowded[self.inverse]
        whole = seen[self.inverse] & ~split
        singles = _ranges(self.starts[split], self.sizes[split])
        self.at = np.concatenate([self.starts[whole], singles])
        self.long = np.concatenate([self.sizes[whole], np.ones(len(singles), np.int64)])
        last = self._window_hash(self.at + self.long - 1)
        same = mix(self._window_hash(self.at) * _MUL + last) + self.long.astype(np.uint64)  # at most 2 windows long
        key = np.concatenate([self.anchors[whole], last[int(whole.sum()):]])
        _, first, index = np.unique(same, return_index=True, return_inverse=True)
        order = np.argsort(key[first], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.index, self.key = rank[index], key[first][order]
        low = np.full(len(order), len(self.ids), np.int64)
        np.minimum.at(low, self.index, self.owner[self.at])
        self.first, self.u_at, self.u_long = low, self.at[first][order], self.long[first][order]
        self.borders = by_shard(shard_of(self.key, shards), shards)


def _seeds(pdf: pd.DataFrame, window: int, shards: int) -> pd.DataFrame:
    b = _Bucket(pdf, window)
    at, counts = by_shard(shard_of(b.keys, shards), shards), b.seeds()
    out = [(int(s), int(pdf["bucket"].iloc[0]), pack_keys(b.keys[at[s]:at[s + 1]]), counts[at[s]:at[s + 1]].tobytes())
           for s in np.flatnonzero(np.diff(at))]
    return pd.DataFrame(out, columns=["shard", "bucket", "keys", "counts"])


def _known(pdf: pd.DataFrame, crowd: int) -> pd.DataFrame:
    """For each anchor sent: do several documents have it, and more than ``crowd`` places?"""
    keys = [unpack_keys(k) for k in pdf["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    table, index = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in pdf["counts"]])
    senders = np.bincount(index, minlength=len(table)) + np.bincount(index, counts >> np.uint32(31), len(table))
    places = np.bincount(index, counts & np.uint32((1 << 31) - 1), len(table))
    seen = senders[index] > 1
    crowded = seen & (places[index] > crowd)
    data = [np.packbits(np.concatenate(x)).tobytes() for x in zip(np.split(seen, ends[:-1]), np.split(crowded, ends[:-1]), strict=True)]
    return pd.DataFrame({"bucket": pdf["bucket"], "shard": pdf["shard"], "data": data})


def _bits(data: bytes, n: int) -> np.ndarray:
    """Two rows of ``n`` flags: seen, crowded."""
    return np.unpackbits(np.frombuffer(data, np.uint8), count=2 * n).astype(bool).reshape(2, n)


def _segments(docs: pd.DataFrame, answers: pd.DataFrame, window: int, shards: int) -> pd.DataFrame:
    """The bucket's segments for each shard, and one row with its anchors' bits, which comes back with the answers."""
    b, out = _Bucket(docs, window), []
    flags, at = np.zeros((2, len(b.keys)), bool), by_shard(shard_of(b.keys, shards), shards)
    for s, data in zip(answers["shard"], answers["data"], strict=True):
        flags[:, at[s]:at[s + 1]] = _bits(data, int(at[s + 1] - at[s]))
    b.pick(*flags, shards)
    parts = (shard_of(b.key, shards * PARTS) % np.uint64(PARTS)).astype(np.uint8)
    for s in np.flatnonzero(np.diff(b.borders)):
        cut = slice(b.borders[s], b.borders[s + 1])
        text = b.words[_ranges(b.u_at[cut], b.u_long[cut] + window - 1)]
        out.append((int(s), int(docs["bucket"].iloc[0]), b.u_long[cut].astype(_size_type(window)).tobytes(), parts[cut].tobytes(),
                    _encode(b.ids[b.first[cut]]), _encode(text), None))
    bucket, none = int(docs["bucket"].iloc[0]), _encode(np.zeros(0, np.uint64))
    out.append((bucket % shards, bucket, b"", b"", none, none, np.packbits(flags).tobytes()))
    return pd.DataFrame(out, columns=["shard", "bucket", "sizes", "parts", "owners", "words", "flags"])


def _size_type(window: int) -> np.dtype:
    """The least unsigned type for a segment's number of windows, which is less than ``window``."""
    return np.min_scalar_type(window)


def _match(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """For each window of each segment sent: the first document that has it, from the shard's automata."""
    sizes = [np.frombuffer(x, _size_type(window)).astype(np.int64) for x in pdf["sizes"]]
    rows = np.cumsum([s.sum() for s in sizes])
    sizes = np.concatenate(sizes)
    parts = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["parts"]])
    owners = np.concatenate([_decode(x) for x in pdf["owners"]])
    _, text = np.unique(np.concatenate([_decode(x) for x in pdf["words"]]), return_inverse=True)
    text = text.astype(np.uint32)
    width = sizes + window - 1
    ends, filled = np.cumsum(width), np.cumsum(sizes) - sizes
    first = np.empty(int(sizes.sum()), np.uint64)
    order = np.lexsort((owners, parts))
    for group in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
        automaton, distinct = SuffixAutomaton(), {}
        for i in group.tolist():
            piece = text[ends[i] - width[i]:ends[i]]
            same = distinct.setdefault(piece.tobytes(), [])
            if not same:
                automaton.add(piece.tolist(), int(owners[i]))
            same.append(i)
        for piece, same in distinct.items():
            found = automaton.first_owners(np.frombuffer(piece, np.uint32).tolist(), window)
            for i in same:
                first[filled[i]:filled[i] + sizes[i]] = found
    data = [_encode(x) if f is None else f for x, f in zip(np.split(first, rows[:-1]), pdf["flags"], strict=True)]
    kind = [MATCHED if f is None else SEEN for f in pdf["flags"]]
    return pd.DataFrame({"bucket": pdf["bucket"], "kind": kind, "shard": pdf["shard"], "data": data})


def _cut(docs: pd.DataFrame, answers: pd.DataFrame, window: int, shards: int) -> pd.DataFrame:
    b, out = _Bucket(docs, window), []
    b.pick(*_bits(answers.loc[answers["kind"] == SEEN, "data"].iloc[0], len(b.keys)), shards)
    told = answers[answers["kind"] == MATCHED].sort_values("shard")
    first = np.concatenate([np.zeros(0, np.uint64), *map(_decode, told["data"])])
    starts = _ranges(b.at, b.long)
    asked = _ranges((np.cumsum(b.u_long) - b.u_long)[b.index], b.long)
    gone = starts[first[asked] < b.ids[b.owner[starts]]]
    step = np.zeros(len(b.words) + 1, np.int64)
    step[gone] += 1
    step[gone + window] -= 1
    covered, end = np.cumsum(step[:-1]) > 0, 0
    for text, n in zip(b.rows["text"], b.counts.tolist(), strict=True):
        mask, end = covered[end:end + n], end + n
        found = (text or "").encode("utf-8", "surrogatepass").split()
        edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
        spans = [{"start": int(i), "end": int(j)} for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
        kept = b" ".join([found[i] for i in np.flatnonzero(~mask)] if spans else found).decode("utf-8", "surrogatepass")
        out.append((n, int(mask.sum()), spans, kept))
    done = pd.DataFrame(out, columns=["n_words", "n_removed", "removed", "kept_text"])
    done.insert(0, "doc", b.rows["doc"].to_numpy())
    return done


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     crowd: int = CROWD) -> DataFrame:
    """(doc, n_words, n_removed, removed, kept_text) for each row; ``removed`` lists the word spans [start, end)."""
    n = 2 * partitions(docs.sparkSession)
    rows = docs.select(id_column(id_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc", "text"), F.lit(n)).cast("int"))
    by_bucket = rows.groupBy("bucket")
    asked = by_bucket.applyInPandas(lambda pdf: _seeds(pdf, window, n), "shard int, bucket int, keys binary, counts binary")
    known = asked.groupBy("shard").applyInPandas(lambda pdf: _known(pdf, crowd), "bucket int, shard int, data binary")
    sent = by_bucket.cogroup(known.groupBy("bucket")).applyInPandas(
        lambda d, a: _segments(d, a, window, n), "shard int, bucket int, sizes binary, parts binary, owners binary, words binary, flags binary")
    told = sent.groupBy("shard").applyInPandas(lambda pdf: _match(pdf, window), "bucket int, kind int, shard int, data binary")
    done = by_bucket.cogroup(told.groupBy("bucket")).applyInPandas(
        lambda d, a: _cut(d, a, window, n), "doc long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string")
    return done.withColumn("doc", F.when(F.col("doc") != NULL_ID, F.col("doc")))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS s FROM starts),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first_doc FROM windows) WHERE first_doc < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM late),
gone AS (SELECT doc_id, list(i) AS gs FROM covered GROUP BY doc_id),
words AS (SELECT d.doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gs), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
