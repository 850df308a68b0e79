"""LM scoring with an n-gram trie in Elias-Fano form.

Model: interpolated n-grams (``order`` 2 or 3) with absolute discounting, P(w|c) = max(n(cw) - D, 0) / n(c) + D N1+(c.) / n(c) * P'(w),
where P' is the model of the next shorter context and P1 adds one: P1(w) = (n(w) + 1) / (N + V + 1); an unseen context
leaves P'. The first token of a text has the start as its context, the second the start and the first.

Method: a trie level (bigrams, trigrams) is cut by hash range of the context into shards, each built where its
n-grams meet: its sorted contexts, monotone pointers to their successors, and the successors made monotone by the context's
rank, each as an Elias-Fano sequence: low bits packed at their width, high bits in unary with a sample of the zeros before
each word of 64. Probabilities and back-off weights are 8-bit codes on a log scale, rounded down (so they still sum to
at most one). A level is written to an unnamed local file and mapped; queries read the packed bits where they need them.
Documents don't pull the model in: each text is read once into a bucket of texts as ranks in the bucket's words. A bucket
sends each distinct n-gram once to its shard, with its training count, and gets codes back in the order it sent them. A shard
looks each distinct n-gram up once, whichever buckets sent it. The words' counts are those of the bigrams' contexts. A trigram context that no other bucket has (or training doesn't
have) is complete where it is and isn't sent.

Scale: the model is never in one place and grows with the corpus by adding shards; a bucket ends with the text that fills it, and what
it sends is collapsed to distinct n-grams first, so a frequent word costs one entry per bucket. No broadcast is asked for.

Defined results: A-Z lower-cased; tokens are runs of ``[^\\x20\\x09-\\x0D]`` and one end token per text, which is
counted as a token; null, empty or blank text has the end token alone. The start is a context only. Without
training rows N = V = 0. Repeated rows each come back. Words and contexts are told apart by 64-bit hashes, successors in
one context by 32 bits, in a trigram's context too.
"""

from __future__ import annotations

import itertools
import mmap
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructType
from xxhash import xxh3_64_intdigest

from .common import by_shard, mix, partitions, shard_of

DISCOUNT = 0.75
BUCKET_TOKENS = 1_500_000
_START, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_DECADES = 10.0  # codes 1..255 cover probabilities from 1 down to 10^-10; code 0 is zero
_LOW32, _32 = np.uint64(0xFFFFFFFF), np.uint64(32)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE, _TEXT_AT_ONCE = 1 << 15, 8 << 20


def encode_prob(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        code = 1 + np.ceil(-np.log10(p) / _DECADES * 254 - 1e-9)
    return np.where(code <= 255, np.maximum(code, 1), 0).astype(np.uint8)


_TABLE = np.concatenate([[0.0], 10.0 ** (-_DECADES / 254 * np.arange(255))])


def decode_prob(code: np.ndarray) -> np.ndarray:
    return _TABLE[code]


# -- Elias-Fano levels -------------------------------------------------------------------------

_BYTE = np.array([[next((i for i in range(8) if b >> i & 1 and bin(b & (1 << i) - 1).count("1") == k), 0) for k in range(8)]
                  for b in range(256)], np.int64).reshape(-1)  # place of a byte's k-th one


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) in each 64-bit word."""
    at = np.zeros(len(k), np.int64)
    for half in (32, 16, 8):
        ones = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.int64)
        up = k >= ones
        k = k - ones * up
        at += half * up
        words = words >> (half * up).astype(np.uint64)
    return at + _BYTE[((words & np.uint64(255)).astype(np.int64) << 3) + k]


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` (0 to 63) bits of each value, one after the other in 64-bit words, and a word after them."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        values = values & np.uint64((1 << width) - 1)
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))    # a value begins in every word, up to the last one's
        out[:len(first)] = np.add.reduceat(values << shift, first)
        over = np.flatnonzero((at & 63) + width > 64)
        out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out


class EliasFano:
    """A monotone sequence of integers below ``universe``: low bits packed at their width, high bits in unary. Both stay as they
    are for queries; ``zeros`` has the zeros before each word of the high bits."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, zeros: bytes):
        self.n, self.width = n, width
        self.low, self.high, self.zeros = np.frombuffer(low, np.uint64), np.frombuffer(high, np.uint64), np.frombuffer(zeros, np.int64)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> tuple[int, int, bytes, bytes, bytes]:
        n = len(values)
        width = min(63, max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros((n + (int(high[-1]) if n else 0) + 64) // 64 * 64, np.uint8)  # a zero at least after the last one
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.cumsum(64 - np.bitwise_count(words).astype(np.int64))
        return n, width, _pack(values, width).tobytes(), words.tobytes(), np.append(0, zeros).tobytes()

    def _lows(self, i: np.ndarray) -> np.ndarray:
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        over = (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return (self.low[word] >> shift | over) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        ones = np.arange(len(self.zeros)) * 64 - self.zeros          # before each word
        word = np.searchsorted(ones, i, "right") - 1
        high = (word << 6) + _select(self.high[word], i - ones[word]) - i
        return high.astype(np.uint64) << np.uint64(self.width) | self._lows(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """Elements whose high part is less than ``high``: the ones before as many zeros."""
        at = np.zeros(len(high), np.int64)
        k = high - 1
        beyond = k >= self.zeros[-1]
        i = np.flatnonzero((k >= 0) & ~beyond)
        word = np.searchsorted(self.zeros, k[i], "right") - 1
        at[i] = (word << 6) + _select(~self.high[word], k[i] - self.zeros[word]) - k[i]
        at[beyond] = self.n
        return at

    def locate(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the index of the first element >= it, and whether that equals it: the elements with its high part
        lie between two zeros, their low parts ascend."""
        if len(value) > _AT_ONCE:                                    # so that what a step leaves stays in the processor's cache
            parts = [self.locate(value[i:i + _AT_ONCE]) for i in range(0, len(value), _AT_ONCE)]
            return tuple(np.concatenate(part) for part in zip(*parts, strict=True))
        high, want = (value >> np.uint64(self.width)).astype(np.int64), value & np.uint64((1 << self.width) - 1)
        lo, end = self._before(high), self._before(high + 1)
        hi = end.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._lows(mid) < want[open_]
            lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        same = lo < end
        same[same] = self._lows(lo[same]) == want[same]
        return lo, same

    def successor(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Index of the first element >= value within [begin, end), for many queries at once."""
        return np.clip(self.locate(value)[0], begin, end)


def build_level(contexts: np.ndarray, keys: np.ndarray, counts: np.ndarray, discount: float = DISCOUNT) -> dict:
    """One shard: its sorted contexts, sorted (context's rank << 32 | successor) keys and their counts -> the trie's levels as
    buffers. Each context has a key."""
    rank = keys >> _32
    starts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(keys) else np.zeros(0, np.int64)
    pointers = np.append(starts, len(keys)).astype(np.uint64)
    fan = np.diff(pointers).astype(np.int64)
    total = np.add.reduceat(counts, starts) if len(keys) else counts
    contexts = contexts.astype(np.uint64)
    first = int(contexts[0]) if len(contexts) else 0
    return {"first": first,
            "contexts": EliasFano.encode(contexts - np.uint64(first), int(contexts[-1]) - first + 1 if len(contexts) else 1),
            "pointers": EliasFano.encode(pointers, len(keys) + 1),
            "successors": EliasFano.encode(keys, max(len(contexts), 1) << 32),
            "probs": encode_prob((counts - discount) / np.repeat(total, fan)).tobytes(),
            "backoff": encode_prob(discount * fan / total).tobytes()}


def map_level(level: dict) -> dict:
    """The same level with its buffers in a local file that has no name (it goes with its last reader), mapped for reading."""
    parts = {k: list(v) if isinstance(v, tuple) else [v] for k, v in level.items()}
    with tempfile.TemporaryFile() as f:
        places = []
        for part in parts.values():
            for i, buffer in enumerate(part):
                if isinstance(buffer, bytes):
                    places.append((part, i, f.tell(), len(buffer)))
                    f.write(buffer + b"\0" * (8 + -len(buffer) % 8))
        f.flush()
        view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    for part, i, at, size in places:
        part[i] = view[at:at + size]
    return {k: tuple(parts[k]) if isinstance(v, tuple) else parts[k][0] for k, v in level.items()}


class Level:
    """A level opened for queries, on the buffers as they are."""

    def __init__(self, level: dict):
        self.first = np.uint64(level["first"])
        self.probs, self.backoffs = np.frombuffer(level["probs"], np.uint8), np.frombuffer(level["backoff"], np.uint8)
        self.contexts, self.pointers, self.successors = (EliasFano(*level[k]) for k in ("contexts", "pointers", "successors"))

    def find(self, contexts: np.ndarray, fan: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct contexts, how many words are asked of each, and these: (rank of each context, place of each word after
        its context); unseen: -1."""
        rank, place = np.full(len(contexts), -1), np.full(len(words), -1)
        inside = np.flatnonzero(contexts >= self.first) if self.contexts.n else np.zeros(0, np.int64)
        at, same = self.contexts.locate(contexts[inside] - self.first)
        rank[inside[same]] = at[same]
        asked = np.repeat(rank, fan)
        known = np.flatnonzero(asked >= 0)
        if len(known):
            seen = np.maximum(rank, 0)
            begin, end = (np.repeat(self.pointers.get(seen + i).astype(np.int64), fan)[known] for i in (0, 1))
            at, same = self.successors.locate(asked[known].astype(np.uint64) << _32 | words[known])
            hit = np.flatnonzero(same & (at >= begin) & (at < end))
            place[known[hit]] = at[hit]
        return rank, place

    def codes(self, rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``find`` found -> (back-off code of each context, probability code of each word); unseen: 1 and 0."""
        backoff, prob = np.ones(len(rank), np.uint8), np.zeros(len(place), np.uint8)
        backoff[rank >= 0] = self.backoffs[rank[rank >= 0]]
        prob[place >= 0] = self.probs[place[place >= 0]]
        return backoff, prob

    def query(self, contexts: np.ndarray, fan: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct contexts, how many words are asked of each, and these: (probability code, back-off code) of each word
        after its context; unseen: 0, unseen context: back-off 1."""
        backoff, prob = self.codes(*self.find(contexts, fan, words))
        return prob, np.repeat(backoff, fan)


# -- what buckets and shards send --------------------------------------------------------------

def squeeze(values: np.ndarray) -> bytes:
    """Unsigned integers as planes of bytes, as many as the largest needs, compressed."""
    wide = np.ascontiguousarray(values)
    width = (int(wide.max()).bit_length() + 7) // 8 if len(wide) else 0
    head = struct.pack("<BQ", width, len(wide))
    return head + pa.compress(wide.view(np.uint8).reshape(len(wide), -1)[:, :width].T.tobytes(), "zstd", asbytes=True) if width else head


def unsqueeze(blob: bytes) -> np.ndarray:
    """In the narrowest type that holds the planes."""
    width, n = struct.unpack_from("<BQ", blob)
    size = next(s for s in (1, 2, 4, 8) if width <= s)
    out = np.zeros((n, size), np.uint8)
    if width:
        planes = pa.decompress(memoryview(blob)[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(f"<u{size}")


def _squeeze_sorted(keys: np.ndarray) -> bytes:
    """Differences (modulo 2^64, so an order in parts is kept too)."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def _unsqueeze_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(blob), dtype=np.uint64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of its rows with about ``_TEXT_AT_ONCE`` bytes of text, or one longer text."""
    until = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(until // _TEXT_AT_ONCE)) + 1
    for begin, end in itertools.pairwise([0, *cuts.tolist(), len(until)]):
        yield batch.slice(begin, end - begin)


def _tokenised(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(tokens of each text, its end counted; the words of all texts): A-Z lower-cased and split at runs of ``[\\x20\\x09-\\x0D]``."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, borders = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    borders -= borders[0]
    some = pc.not_equal(found, "")                                   # at the ends of a text, and of a blank one
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False), dtype=np.int64))
    return np.diff(before[borders]) + 1, found.filter(some)


def _bucket(ids: list[pa.Array], train: list[np.ndarray], lengths: list[np.ndarray], words: list[pa.Array], doc: pa.DataType,
            where: tuple[int, int]) -> pa.RecordBatch:
    ids, train, lengths = pa.concat_arrays(ids), np.concatenate(train), np.concatenate(lengths)
    coded = pa.concat_arrays(words).dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    hashes = np.append(np.fromiter(map(xxh3_64_intdigest, names), np.uint64, len(names)), _END)
    ends = np.zeros(lengths.sum(), bool)
    ends[np.cumsum(lengths) - 1] = True
    tokens = np.full(len(ends), len(names), np.int32)                # no word equals the end
    tokens[~ends] = coded.indices.to_numpy()
    order = np.lexsort((hashes, -np.bincount(tokens)))
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    blobs = [train.tobytes(), squeeze(lengths), _squeeze_sorted(hashes[order]), squeeze(rank[tokens])]
    name = xxh3_64_intdigest(b"".join([str((*where, ids.to_pylist())).encode("utf-8", "surrogatepass"), *blobs]))
    ids = pa.array([ids.to_pylist()], pa.list_(doc))
    return pa.RecordBatch.from_arrays([pa.array([name - (1 << 63)], pa.int64()), ids, *(pa.array([b], pa.binary()) for b in blobs)],
                                      ["bucket", "docs", "train", "lengths", "words", "tokens"])


def _read_texts(batches: Iterator[pa.RecordBatch], doc: pa.DataType, size: int) -> Iterator[pa.RecordBatch]:
    """Texts -> buckets, full with ``size`` tokens: ids, training flags, lengths, distinct words (most frequent first, then by
    hash) and tokens as ranks of these. A bucket's name depends on its content: one that is read anew in another
    order gets no answers meant for the first."""
    part, made, n, held = TaskContext.get().partitionId(), 0, 0, []
    for batch in itertools.chain.from_iterable(map(_slices, batches)):
        ids, train = batch.column("doc"), batch.column("train").to_numpy(zero_copy_only=False)
        lengths, words = _tokenised(batch.column("text"))
        until, at = np.cumsum(lengths), 0
        while at < len(lengths):
            begun = int(until[at - 1]) if at else 0
            end = int(np.searchsorted(until, begun + size - n))      # the text that fills the bucket
            stop = min(end + 1, len(lengths))
            last = int(until[stop - 1])
            held.append((ids[at:stop], train[at:stop], lengths[at:stop], words[begun - at:last - stop]))
            n, at = n + last - begun, stop
            if n >= size:
                yield _bucket(*zip(*held, strict=True), doc, (part, made))
                made, n, held = made + 1, 0, []
    if held:
        yield _bucket(*zip(*held, strict=True), doc, (part, made))


def _distinct(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the keys (below 2^``bits``), where in it each distinct key begins, and these keys."""
    below = len(keys).bit_length()
    if bits + below <= 64:                                           # with their places: one plain sort
        keys = np.sort(keys << np.uint64(below) | np.arange(len(keys), dtype=np.uint64))
        order, keys = (keys & np.uint64((1 << below) - 1)).astype(np.int64), keys >> np.uint64(below)
    else:
        order = np.argsort(keys)
        keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, first, keys[first]


def _place_of(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which of the distinct keys each key is."""
    out = np.empty(len(order), np.int32)
    out[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(order)))
    return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


class _Grams:
    """Distinct n-grams of a bucket: its contexts sorted by hash, sorted (context's rank << 32 | successor) keys, and their training
    counts."""

    def __init__(self, hashes: np.ndarray, context: np.ndarray, successor: np.ndarray, successors: np.ndarray, train: np.ndarray):
        """``successor``: each token's place in the sorted ``successors``."""
        order = np.argsort(hashes)
        self.place = np.empty(len(order), np.uint64)
        self.place[order] = np.arange(len(order), dtype=np.uint64)
        self.contexts = hashes[order]
        low = np.uint64(len(successors).bit_length())                # dense, so a key and a token's place fit a word
        self.order, self.first, keys = _distinct(self.place[context] << low | successor, len(order).bit_length() + int(low))
        self.rank = (keys >> low).astype(np.int32)
        self.keys = keys >> low << _32 | successors[(keys & np.uint64((1 << int(low)) - 1)).astype(np.int64)]
        self.counts = _sums(train[self.order], self.first)

    def key_of(self) -> np.ndarray:
        """The key of each token."""
        return _place_of(self.order, self.first)

    def asks(self, bucket: int, shards: int, kept: np.ndarray) -> pa.Table:
        """A message to every shard: the kept contexts in its range, their keys and counts."""
        contexts, mine = self.contexts[kept], kept[self.rank]
        keys = (np.cumsum(kept) - 1).astype(np.uint64)[self.rank[mine]] << _32 | self.keys[mine] & _LOW32
        counts = self.counts[mine].astype(np.uint64)
        at = by_shard(shard_of(contexts, shards), shards)
        key_at = np.searchsorted(keys, at.astype(np.uint64) << _32)
        cut = [(a, b, np.uint64(a) << _32, c, d) for a, b, c, d in zip(at[:-1], at[1:], key_at[:-1], key_at[1:], strict=True)]
        return pa.table({"shard": pa.array(np.arange(shards), pa.int32()), "bucket": pa.array([bucket] * shards, pa.int64()),
                         "contexts": pa.array([_squeeze_sorted(contexts[a:b]) for a, b, *_ in cut], pa.binary()),
                         "keys": pa.array([_squeeze_sorted(keys[c:d] - base) for *_, base, c, d in cut], pa.binary()),
                         "counts": pa.array([squeeze(counts[c:d]) for *_, c, d in cut], pa.binary())})


_ASKED = "shard int, bucket long, contexts binary, keys binary, counts binary"
_TOLD = "bucket long, shard int, n long, v long, probs binary, backoffs binary, totals binary, shared binary"


def _joined(answers: pa.Table | pa.StructArray, shards: int) -> dict:
    """A bucket's answers in the order of the shards."""
    rows = sorted(answers.to_pylist(), key=lambda r: r["shard"])
    if [r["shard"] for r in rows] != list(range(shards)):
        raise RuntimeError("a bucket of texts was read anew in another order and has no answers; the input has to be repeatable")
    return {c: np.concatenate([unsqueeze(r[c]) for r in rows]) for c in ("probs", "backoffs", "totals", "shared")} | {
        c: sum(r[c] for r in rows) for c in ("n", "v")}


class _Bucket:
    """Tokens and bigrams of a bucket of texts, and, where the bigrams' answers are there, its trigrams."""

    def __init__(self, row: pa.Table, shards: int):
        self.docs = row.column("docs").combine_chunks().flatten()
        self.name, train, lengths, words, tokens = (row.column(c)[0].as_py() for c in ("bucket", "train", "lengths", "words", "tokens"))
        self.doc_train, self.lengths = np.frombuffer(train, bool), unsqueeze(lengths).astype(np.int64)
        self.words, self.tokens = _unsqueeze_sorted(words), unsqueeze(tokens).astype(np.int32)
        self.train = np.repeat(self.doc_train, self.lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.end = int(self.tokens[-1])                              # its context stands for the start
        before = np.roll(self.tokens, 1)
        before[self.starts] = self.end
        self.hashes = np.where(np.arange(len(self.words)) == self.end, mix(np.array([_START]))[0], mix(self.words))
        order, first, self.successors = _distinct(mix(self.words) & _LOW32, 32)
        self.successor = _place_of(order, first).astype(np.uint32)[self.tokens]
        self.two = _Grams(self.hashes, before, self.successor, self.successors, self.train)

    def trigrams(self, shared: np.ndarray) -> None:
        """``shared``: of each bigram, whether training has it and other buckets have it too."""
        two, later = self.two, np.ones(len(self.tokens), bool)
        later[self.starts] = False
        self.later = np.flatnonzero(later)
        context = two.key_of()[self.later - 1]
        used = np.zeros(len(two.keys), bool)                         # no text goes on after its end
        used[context] = True
        number = np.cumsum(used, dtype=np.int32) - np.int32(1)
        hashes = mix(two.contexts[two.rank[used]] * _MUL + (two.keys[used] & _LOW32))
        self.three = _Grams(hashes, number[context], self.successor[self.later], self.successors, self.train[self.later])
        self.asked = np.zeros(len(hashes), bool)
        self.asked[self.three.place] = shared[used]

    def trigram_codes(self, answers: pa.Table, shards: int, discount: float) -> tuple[np.ndarray, np.ndarray]:
        """(probability code of each trigram, back-off code of each of its contexts): from the shards, or from this bucket's counts."""
        three, told = self.three, _joined(answers, shards)
        starts = np.flatnonzero(np.diff(three.rank, prepend=-1))     # each context has a key
        total, fan = _sums(three.counts, starts), _sums(three.counts > 0, starts)
        backoff, seen = np.ones(len(total), np.uint8), total > 0
        backoff[seen] = encode_prob(discount * fan[seen] / total[seen])
        prob, some = np.zeros(len(three.keys), np.uint8), three.counts > 0
        prob[some] = encode_prob((three.counts[some] - discount) / total[three.rank[some]])
        backoff[self.asked], prob[self.asked[three.rank]] = told["backoffs"], told["probs"]
        return prob, backoff


def _ask_bigrams(row: pa.Table, shards: int) -> pa.Table:
    b = _Bucket(row, shards)
    return b.two.asks(b.name, shards, np.ones(len(b.two.contexts), bool))


def _level_two(row: pa.Table, shards: int) -> dict:
    return _joined(row.column("two").combine_chunks().flatten(), shards)


def _ask_trigrams(row: pa.Table, shards: int) -> pa.Table:
    b = _Bucket(row, shards)
    b.trigrams(_level_two(row, shards)["shared"] > 0)
    return b.three.asks(b.name, shards, b.asked)


def _answers(pdf: pd.DataFrame, discount: float, words: bool) -> pd.DataFrame:
    """A shard's level from all buckets' n-grams, and what it says of each bucket's. ``words``: also the contexts' counts, and which trained
    n-grams several buckets have. The level is asked once for each distinct n-gram, whoever sent it."""
    asked = [(_unsqueeze_sorted(c), _unsqueeze_sorted(k)) for c, k in zip(pdf["contexts"], pdf["keys"], strict=True)]
    at, key_at = (np.cumsum([0, *map(len, part)]) for part in zip(*asked, strict=True))
    keys = np.concatenate([k for _, k in asked])
    order, first, contexts = _distinct(np.concatenate([c for c, _ in asked]))
    context_of = _place_of(order, first)
    del asked
    context = (keys >> _32).astype(np.int64) + np.repeat(at[:-1], np.diff(key_at))
    order, first, keys = _distinct(context_of[context].astype(np.uint64) << _32 | keys & _LOW32)
    del context
    counts = _sums(np.concatenate([unsqueeze(n) for n in pdf["counts"]])[order], first)
    senders = np.diff(first, append=len(order))                      # a bucket asks for a key once
    key_of = _place_of(order, first)
    del order, first
    rank = (keys >> _32).astype(np.int64)
    starts = np.flatnonzero(np.diff(rank, prepend=-1))               # each context has a key
    totals, fan = _sums(counts, starts), np.diff(starts, append=len(keys))
    seen, trained = totals > 0, counts > 0
    level = Level(map_level(build_level(contexts[seen], (np.cumsum(seen) - 1).astype(np.uint64)[rank[trained]] << _32 | keys[trained] & _LOW32,
                                        counts[trained], discount)))
    found, place = level.find(contexts, fan, keys & _LOW32)
    backoff, prob = level.codes(found, place)
    shared = (place >= 0) & (senders > 1)
    nothing, shard, n, v = squeeze(np.zeros(0, np.uint8)), int(pdf["shard"].iloc[0]), int(totals.sum()), int(seen.sum())
    out = []
    for i, bucket in enumerate(pdf["bucket"]):
        mine, my_keys = context_of[at[i]:at[i + 1]], key_of[key_at[i]:key_at[i + 1]]
        more = (squeeze(totals[mine]), squeeze(shared[my_keys])) if words else (nothing, nothing)
        out.append((bucket, shard, n, v, squeeze(prob[my_keys]), squeeze(backoff[mine]), *more))
    return pd.DataFrame(out, columns=["bucket", "shard", "n", "v", "probs", "backoffs", "totals", "shared"])


def _score(row: pa.Table, answers: pa.Table | None, shards: int, discount: float, schema: pa.Schema) -> pa.Table:
    b, told = _Bucket(row, shards), _level_two(row, shards)
    n, v = told["n"], told["v"]
    c = told["totals"].astype(np.int64)[b.two.place.astype(np.int64)]     # as many ends as starts
    single = (c + 1) / (n + 1 * (v + 1))
    base, single, key_of = np.log10(single)[b.tokens], single[b.tokens], b.two.key_of()
    score = decode_prob(told["probs"])[key_of] + decode_prob(told["backoffs"])[b.two.rank][key_of] * single
    if answers is not None:
        b.trigrams(told["shared"] > 0)
        prob, backoff = b.trigram_codes(answers, shards, discount)
        key_of = b.three.key_of()
        score[b.later] = decode_prob(prob)[key_of] + decode_prob(backoff)[b.three.rank][key_of] * score[b.later]
    sums = [_sums((c > 0)[b.tokens], b.starts), np.full(len(b.starts), n), np.add.reduceat(base, b.starts),
            np.add.reduceat(np.log10(score), b.starts)]
    return pa.Table.from_arrays([b.docs, pa.array(b.doc_train), pa.array(b.lengths), *map(pa.array, sums)], schema=schema)


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", discount: float = DISCOUNT,
                order: int = 2, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(doc, train, n_tokens, n_known, train_tokens, base_score, score) for each row; the model (bigrams, or trigrams by ``order``) learns from the
    rows where ``train`` holds. Scores are log10 probabilities of whole texts."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    n = partitions(docs.sparkSession)                                # a shard takes less memory than a bucket; each pair costs a message
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    id_type = rows.schema["doc"].dataType
    doc = to_arrow_type(id_type)
    out = StructType().add("doc", id_type).add("train", "boolean").add("n_tokens", "long").add("n_known", "long").add(
        "train_tokens", "long").add("base_score", "double").add("score", "double")
    schema = pa.schema([("doc", doc), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    buckets = rows.mapInArrow(lambda it: _read_texts(it, doc, bucket_tokens), StructType().add("bucket", "long").add("docs", ArrayType(id_type)).add(
        "train", "binary").add("lengths", "binary").add("words", "binary").add("tokens", "binary")).repartition("bucket")  # once for all that follows
    asked = buckets.groupBy("bucket").applyInArrow(lambda t: _ask_bigrams(t, n), _ASKED)
    told = asked.groupBy("shard").applyInPandas(lambda pdf: _answers(pdf, discount, True), _TOLD)
    two = told.groupBy("bucket").agg(F.collect_list(F.struct(*[c for c in told.columns if c != "bucket"])).alias("two"))
    known = buckets.join(two, "bucket", "left")
    if order == 2:
        return known.groupBy("bucket").applyInArrow(lambda t: _score(t, None, n, discount, schema), out)
    asked = known.groupBy("bucket").applyInArrow(lambda t: _ask_trigrams(t, n), _ASKED)
    three = asked.groupBy("shard").applyInPandas(lambda pdf: _answers(pdf, discount, False), _TOLD)
    return known.groupBy("bucket").cogroup(three.groupBy("bucket")).applyInArrow(lambda t, a: _score(t, a, n, discount, schema), out)


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 7 == 2
    scored = score_texts(docs, ~held, order=3)
    return scored.select(F.col("doc").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
