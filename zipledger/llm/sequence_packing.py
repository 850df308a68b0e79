"""Packing: token ids of whole documents into sequences of a fixed length with next to no padding.

Method: first-fit decreasing with a tournament tree of bin capacities, run independently in randomised groups of documents.
A text's ids (and the end id after them) are cut into pieces of the sequence length; pieces are dealt to groups by a
seeded hash. In a group, pieces go by descending length; each inner node of the tree holds the largest free
capacity below it, so the first bin with room is found in one descent. Then the emptiest bins are taken apart and
their pieces, cut where needed, fill the gaps of the others. What remains in the group's one unfilled bin goes into
sequences whose lengths are powers of two, which need no padding.

Tokenizer: a public tokenizer file (its path is a parameter) loaded in each task. Its pre-tokenizer never joins characters
across white space, so ids of a text are those of its words, one after another, and each distinct word is encoded
once a batch at most. For that ASCII letters are lower-cased and words are cut between an ASCII letter and one of ``.,;:!?``, as the
tokenizer does itself; a file that doesn't work so (``word_pieces``) encodes whole texts.

Scale: the number of groups grows with the input's bytes (``group_bytes`` each), pieces of one long document go to
different groups and no piece is longer than a sequence, so a group's memory has a fixed bound however skewed ids,
sources or lengths are. Ids travel once, two bytes each where the vocabulary allows it.

Defined results: every id of every row lies in exactly one piece, with ``start`` counted in its own row's ids; a null or
empty text is the end id alone; repeated rows are documents of their own; ids may be null; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, with_fields

GROUP_BYTES = 4 << 20
CHUNK_WORDS = 500_000
SEED = 12
PIECES = "doc_id long, start long, length long, doc_tokens long, grp long, ids binary"
PACKED = (("start", "long"), ("length", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), ("ids", "binary"))


# -- tokens --------------------------------------------------------------------------------------

class WordIds(dict):
    """word (no white space) -> its ids as little-endian bytes; encoded on first sight, all the new words of some texts in one
    call, refilled from empty when it has grown to ``limit``."""

    limit = 600_000

    def __init__(self, tokenizer, dtype: np.dtype):
        super().__init__()
        self.tokenizer, self.dtype = tokenizer, dtype
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.added = [t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()]

    def words(self, texts: pa.StringArray) -> pa.ListArray:
        """Words whose ids, one after another, are those of each text."""
        low = pc.ascii_lower(texts)
        cut = pc.replace_substring_regex(low, pattern="([a-z])([.,;:!?])", replacement=r"\1 \2")
        for token in self.added:  # letter case tells an added token's string from others: such a text stays as it is
            cut = pc.if_else(pc.match_substring(low, token), texts, cut)
        return pc.ascii_split_whitespace(cut)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = words
        self.update(zip(new, self.encode(new), strict=True))
        found = list(map(self.__getitem__, words))
        return np.frombuffer(b"".join(found), self.dtype), np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize

    def encode(self, words: list[str]) -> list[bytes]:
        # a word of letters is one pre-token, whose last piece alone bears the end mark: many of these in one text
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        some = [" ".join([words[i] for i in plain[at:at + 500]]) for at in range(0, len(plain), 500)]
        ids = np.concatenate([np.zeros(0, self.dtype), *[np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(plain):  # a letter that turns into several pre-tokens, as a dotted capital I does
            plain, stops = [], stops[:0]
        out: list[bytes] = [b""] * len(words)
        blob, width, at = ids.tobytes(), self.dtype.itemsize, 0
        for i, stop in zip(plain, (stops * width).tolist(), strict=True):
            out[i] = blob[at:stop]
            at = stop
        plain = set(plain)
        rest = [i for i in range(len(words)) if i not in plain]
        for i, found in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, self.dtype).tobytes()
        return out


def word_pieces(tokenizer_json: str) -> bool:
    """Whether a tokenizer file encodes word by word: it lower-cases, turns white space into one space, its pre-tokenizer drops
    spaces, keeps runs of letters apart from marks, and its pieces end words with ``</w>``."""
    import json

    spec = json.loads(tokenizer_json)
    steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return ("Lowercase" in steps and set(steps) <= {"NFC", "Replace", "Lowercase"} and first.get("behavior") == "Removed"
            and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and spec["model"].get("end_of_word_suffix") == "</w>"
            and not spec.get("post_processor") and not any(t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]))


def encoder(path: str) -> tuple[Callable[[pa.Array | list[str]], list[bytes]], np.dtype]:
    """texts (none null) -> ids of each as little-endian integers of the returned type."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    dtype = np.dtype("<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
    with open(path, encoding="utf-8") as f:
        by_word = word_pieces(f.read())
    cache = WordIds(tokenizer, dtype) if by_word else None

    def encode_words(texts: pa.Array) -> Iterator[bytes]:
        words = cache.words(texts)
        found = words.flatten().dictionary_encode()
        ids, lengths = cache.ids(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        starts = np.cumsum(lengths) - lengths
        index = found.indices.to_numpy()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        at = 0
        while at < len(texts):  # some words at a time, one text at least
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_WORDS)) - 1)
            mine = index[bounds[at]:bounds[stop]]
            n = lengths[mine]
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = ids[np.repeat(starts[mine] - ends[:-1], n) + np.arange(ends[-1])]
            edges = ends[bounds[at:stop + 1] - bounds[at]].tolist()
            for a, b in zip(edges, edges[1:]):
                yield flat[a:b].tobytes()
            at = stop

    def encode(texts: pa.Array | list[str]) -> list[bytes]:
        if by_word:
            return list(encode_words(pa.array(texts, pa.string()) if isinstance(texts, list) else texts))
        found = tokenizer.encode_batch_fast(texts if isinstance(texts, list) else texts.to_pylist(), add_special_tokens=False)
        return [np.array(e.ids, dtype).tobytes() for e in found]

    return encode, dtype


def cut_pieces(docs: DataFrame, path: str, end_id: int, length: int, groups: int, seed: int) -> DataFrame:
    """Pieces of at most ``length`` ids, each with its randomised group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, dtype = encoder(path)
        end, width, seen = np.array([end_id], dtype).tobytes(), dtype.itemsize, 0
        place = np.uint64(TaskContext.get().partitionId()) << np.uint64(36)  # a piece's number in its task: the deal's only input
        for batch in batches:
            rows = [[] for _ in range(5)]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(pc.fill_null(batch.column("text"), "")), strict=True):
                ids += end
                n = len(ids) // width
                for start in range(0, n, length):
                    for column, value in zip(rows, (doc, start, min(length, n - start), n, ids[start * width:(start + length) * width]), strict=True):
                        column.append(value)
            deal = mix(mix((np.arange(seen, seen + len(rows[0]), dtype=np.uint64) + place) ^ mix(np.array([seed], np.uint64))))
            seen += len(rows[0])
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in rows[:4]], pa.array((deal % np.uint64(groups)).astype(np.int64)),
                                              pa.array(rows[4], pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "grp", "ids"])

    return docs.mapInArrow(run, PIECES)


# -- packing -------------------------------------------------------------------------------------

class CapacityTree:
    """Tournament tree over bins, all empty at first: ``place`` puts a length into the first bin with room for it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> int:
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        found = node - self.leaves
        free[node] -= length
        while node > 1:
            node //= 2
            most = free[2 * node] if free[2 * node] >= free[2 * node + 1] else free[2 * node + 1]
            if free[node] == most:
                break
            free[node] = most
        return found


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; ``lengths`` descend."""
    tree, bins = CapacityTree(len(lengths), capacity), []
    for item, length in enumerate(lengths):
        found = tree.place(length)
        if found == len(bins):
            bins.append([])
        bins[found].append(item)
    return bins


def fill_gaps(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) -> full bins, and bins of powers of two for what remains. The emptiest bins' pieces, cut
    where needed, fill the gaps of the others."""
    room = [capacity - sum(length for _, _, length in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: room[i])  # stable: equal bins stay in order
    bins, room = [list(bins[i]) for i in order], [room[i] for i in order]
    at, last = 0, len(bins) - 1
    while at < last:
        if not room[at]:
            at += 1
        elif not bins[last]:
            last -= 1
        else:
            item, start, length = bins[last].pop()
            take = min(length, room[at])
            bins[at].append((item, start + length - take, take))
            room[at] -= take
            if take < length:
                bins[last].append((item, start, length - take))
    out = bins[:at]
    left = bins[at] if bins else []
    rest = sum(length for _, _, length in left)
    for power in ([capacity] if rest == capacity else [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]):
        some = []
        while power:
            item, start, length = left.pop(0)
            take = min(length, power)
            some.append((item, start, take))
            power -= take
            if take < length:
                left.insert(0, (item, start + take, length - take))
        out.append(some)
    return out


def _pack_group(pdf: pd.DataFrame, capacity: int, width: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "start", "ids"], ascending=[False, True, True, True], kind="stable")
    ids, starts = pdf["ids"].tolist(), pdf["start"].tolist()
    lengths = pdf["length"].tolist()
    whole = [[(i, 0, lengths[i]) for i in b] for b in first_fit_decreasing(lengths, capacity)]
    item, start, length, sequence, offset = [], [], [], [], []
    for number, members in enumerate(fill_gaps(whole, capacity)):
        at = 0
        for i, begin, n in members:
            for column, value in zip((item, start, length, sequence, offset), (i, begin, n, number, at), strict=True):
                column.append(value)
            at += n
    took = pdf.iloc[item]
    return pd.DataFrame({
        "doc_id": took["doc_id"].array, "start": [starts[i] + s for i, s in zip(item, start, strict=True)], "length": length,
        "doc_tokens": took["doc_tokens"].array, "sequence_id": (int(pdf["grp"].iloc[0]) << 24) + np.array(sequence, np.int64), "offset": offset,
        "ids": [np.frombuffer(ids[i], f"<u{width}", n, s * width).astype("<u4").tobytes() for i, s, n in zip(item, start, length, strict=True)]})


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = 4096, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = GROUP_BYTES, seed: int = SEED) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and ``ids`` (little-endian 32-bit). Sequences have
    ``length`` ids, or a smaller power of two: the last ones of a group. ``length`` is a power of two."""
    if length < 1 or length & length - 1:
        raise ValueError("length must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # an id stands for one byte of text at least, so a group has at most a few times group_bytes of ids
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    groups = max(1, -(-total // group_bytes))
    width = encoder(tokenizer)[1].itemsize
    pieces = cut_pieces(rows, tokenizer, end_id, length, groups, seed)
    schema = with_fields(rows.select("doc_id").schema, *PACKED)
    return pieces.groupBy("grp").applyInPandas(lambda pdf: _pack_group(pdf.astype({"doc_id": "Int64"}), length, width), schema)


def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
