"""Token counts: greedy longest-match word pieces without building the pieces.

Method: the vocabulary's trie gets failure links with precomputed popped-token counts. Reading a word, a byte
either follows its trie edge or takes the failure link, which stands for the pieces that are complete by then
and adds their number; every byte is read once and every link taken pays for bytes already read, so a
word costs time linear in its length, whatever the pieces are.

Vocabulary: a public byte-level vocabulary file (its path is a parameter). A word is looked up with the
vocabulary's space mark before it, so pieces with the mark are word starts and pieces without it
continuations. The automaton is built once from the file on the driver (its size is the vocabulary's, some
ten thousand pieces) and broadcast; documents stream through it in Arrow batches.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text; null, empty or blank texts have no
token; a word with a byte that no piece covers counts one token (unknown word). Every input row comes back.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import with_fields

SPACE_MARK = b" "  # what the vocabulary file writes before a word start, decoded
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class PieceAutomaton:
    """Trie with failure links; node 0 is the root. ``edges`` is one dict keyed by node * 256 + byte."""

    def __init__(self, pieces: Iterable[bytes]):
        edges: dict[int, int] = {}
        ends: list[bool] = [False]
        parents: list[int] = [0]
        via: list[int] = [0]
        for piece in pieces:
            node = 0
            for byte in piece:
                nxt = edges.get(node << 8 | byte)
                if nxt is None:
                    nxt = edges[node << 8 | byte] = len(ends)
                    ends.append(False)
                    parents.append(node)
                    via.append(byte)
                node = nxt
            ends[node] = node != 0
        # fail[v] = where matching goes on after popping the longest pieces of the string of v, or -1
        # pops[v] = how many pieces that pops
        children: list[list[int]] = [[] for _ in ends]
        for node in range(1, len(ends)):
            children[parents[node]].append(node)
        fail, pops = [-1] * len(ends), [0] * len(ends)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for node in children[parent]:
                queue.append(node)
                if ends[node]:
                    fail[node], pops[node] = 0, 1
                    continue
                at, count = fail[parent], pops[parent]
                while at >= 0 and (at << 8 | via[node]) not in edges:
                    count += pops[at]
                    at = fail[at]
                if at >= 0:
                    fail[node], pops[node] = edges[at << 8 | via[node]], count
        self.edges, self.fail, self.pops = edges, fail, pops

    def tables(self) -> tuple[dict[int, int], list[int], list[int]]:
        """Plain data to broadcast (workers need not have this package installed)."""
        return self.edges, self.fail, self.pops

    @classmethod
    def of(cls, tables: tuple[dict[int, int], list[int], list[int]]) -> PieceAutomaton:
        self = cls(())
        self.edges, self.fail, self.pops = tables
        return self

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of ``word``; -1 if they can't cover it."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = total = 0
        for byte in word:
            nxt = edges.get(node << 8 | byte)
            while nxt is None:
                if fail[node] < 0:
                    return -1
                total += pops[node]
                node = fail[node]
                nxt = edges.get(node << 8 | byte)
            node = nxt
        while node:  # what is left in the trie at the end of the word
            if fail[node] < 0:
                return -1
            total += pops[node]
            node = fail[node]
        return total


class _Counts(dict):
    """word -> tokens, remembered for repeated words; refilled from empty when it has grown to ``limit``."""

    limit = 300_000

    def __init__(self, automaton: PieceAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = self.automaton.count(SPACE_MARK + word)
        self[word] = n = 1 if n < 0 else n
        return n


def read_vocabulary(path: str = DEFAULT_VOCABULARY) -> list[bytes]:
    """Pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def token_counts(docs: DataFrame, vocabulary: Iterable[bytes], text_col: str = "text", words_out: str = "n_words",
                 tokens_out: str = "n_tokens") -> DataFrame:
    """``docs`` with two more columns: words and tokens of the whole text. The new names must be free."""
    if {words_out, tokens_out} & set(docs.columns):
        raise ValueError(f"columns {words_out}, {tokens_out} exist; name others")
    shared = docs.sparkSession.sparkContext.broadcast(PieceAutomaton(vocabulary).tables())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(PieceAutomaton.of(shared.value))
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(text_col):
                found = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(found))
                n_tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=[*batch.schema.names, words_out, tokens_out])

    return docs.mapInArrow(run, with_fields(docs.schema, (words_out, "long"), (tokens_out, "long")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, read_vocabulary()).drop("text")
