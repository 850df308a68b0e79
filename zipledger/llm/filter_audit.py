"""Filter interaction audit: what each of five quality filters removes, in every order and by Shapley value.

Method: exact constrained least squares. A document's failures are a 5-bit mask, so all that orders of filters can
do to a part follows from 32 counts, v(S) = documents that fail at least one filter of the coalition S. A filter's
Shapley value is the solution of the kernel-weighted least squares fit of v by an additive game under the efficiency
constraint; its normal equations (the constraint by a Lagrange multiplier) are solved in rationals, so the values
are exact and their sum over all orders is an integer. Steps of an order are differences v(S + filter) - v(S).

Filters (words: maximal runs of ``[^\\x20\\x09-\\x0D]``, case-sensitive; whole texts; null text: empty). A fails under 50
words; B if 100 * distinct words < 65 * words; C if 100 * ``[A-Z]`` characters > 5 * code points; D if the text holds any of
``#$%&*|``; E if a document with a smaller id has the same text, in any part, removed or not.

Scale: texts are read once, in Arrow batches, and leave as (id, 128-bit text key, part, mask). The smallest id of a text
comes from an aggregate that combines on the map side, and meets the rows by (text key, id): a text that a third
of all documents share has one row there and no hot join key. Rows of one id combine before labels join by id. What
is left is at most 32 cells a part; nothing is collected.

Defined results: a null id counts as smaller than any other; rows of one id have one age, so repeated rows of the first
id all pass E; a null or empty source is the part ``""``; labels of one id are combined (any row with quality 1 or toxic
1 counts), a document without a label is neither; empty tables give no rows. Texts are told apart by a
128-bit cryptographic hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, stage

TEXT_FILTERS = "ABCD"
LETTERS = "ABCDE"
MARKS = b"#$%&*|"


def text_mask(raw: bytes, n_chars: int) -> int:
    """Bits 0-3: failures of filters A-D."""
    found = raw.split()
    n = len(found)
    upper = len(raw) - len(raw.translate(None, UPPER.encode()))
    return ((n < 50) | (100 * len(set(found)) < 65 * n) << 1 | (100 * upper > 5 * n_chars) << 2
            | (len(raw.translate(None, MARKS)) < len(raw)) << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        raw = texts.cast(pa.binary()).to_pylist()
        chars = pc.utf8_length(texts).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
             pc.fill_null(batch.column("part"), ""), pa.array(map(text_mask, raw, chars), pa.int32())],
            names=["doc_id", "text_key", "part", "mask"])


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters. ``docs``: doc_id, text, source; ``labels``: doc_id,
    quality, toxic."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("source").cast("string").alias("part"))
    rows = stage(src.mapInArrow(_masks, "doc_id long, text_key binary, part string, mask int")
                 .groupBy("doc_id", "text_key", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    first = rows.groupBy("text_key").agg(F.min("doc_id").alias("low"), F.bool_or(F.col("doc_id").isNull()).alias("unnamed")).select(
        F.col("text_key").alias("key"), F.when(~F.col("unnamed"), F.col("low")).alias("id"), F.lit(0).alias("late"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    same = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    rows = rows.join(first, same, "left").join(known, F.col("doc_id") == F.col("labelled"), "left")
    late = F.when(F.col("late").isNull(), 1 << len(TEXT_FILTERS)).otherwise(0)
    return rows.groupBy("part", F.col("mask").bitwiseOR(late).alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


# -- the game of one part ------------------------------------------------------------------------

def solve(matrix: Sequence[Sequence[Fraction]], right: Sequence[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows = [[Fraction(x) for x in r] + [Fraction(b)] for r, b in zip(matrix, right, strict=True)]
    for i in range(len(rows)):
        pivot = next(j for j in range(i, len(rows)) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j, row in enumerate(rows):
            if j != i and row[i]:
                rows[j] = [x - row[i] * y for x, y in zip(row, rows[i], strict=True)]
    return [r[-1] for r in rows]


def shapley(v: Sequence[int], n: int) -> list[Fraction]:
    """Shapley values of the game ``v`` (by coalition mask; v[0] = 0) with ``n`` players: least squares over all proper
    coalitions with the Shapley kernel's weights, under the constraint that the values add up to v of all."""
    inner = [(s, Fraction(n - 1, comb(n, k) * k * (n - k))) for s in range(1, 2**n - 1) for k in (s.bit_count(),)]
    normal = [[sum((w for s, w in inner if s >> i & s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    right = [sum((w * v[s] for s, w in inner if s >> i & 1), Fraction(0)) for i in range(n)]
    return solve([*normal, [Fraction(1)] * n + [Fraction(0)]], [*right, Fraction(v[-1])])[:n]


def coalitions(cells: Sequence[int]) -> list[int]:
    """v(S) for every coalition S: how many fail at least one filter of S, from the counts by failure mask."""
    return [sum(c for mask, c in enumerate(cells) if mask & s) for s in range(len(cells))]


STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def order_steps(part: str, n: list[int], good: list[int], toxic: list[int], letters: str = LETTERS) -> list[tuple]:
    """All steps of all orders of one part, from its counts by failure mask."""
    everyone = 2 ** len(letters) - 1
    v, v_good, v_toxic, total = coalitions(n), coalitions(good), coalitions(toxic), sum(n)
    orders = ["".join(p) for p in permutations(letters)]
    values = [x * len(orders) for x in shapley(v, len(letters))]
    assert all(x.denominator == 1 for x in values)
    out = []
    for order in orders:
        done = 0
        for step, letter in enumerate(order, 1):
            i = letters.index(letter)
            now = done | 1 << i
            removed = v[now] - v[done]
            out.append((part, order, step, total - v[now], removed, v[1 << i] - removed, v[everyone] - v[everyone ^ 1 << i],
                        v_good[now] - v_good[done], v_toxic[now] - v_toxic[done], int(values[i])))
            done = now
    return out


def interaction_audit(cells: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from ``failure_cells``."""
    size = 2 ** len(LETTERS)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, found in zip(pdf["part"], pdf["cells"], strict=True):
                counts = [[0] * size for _ in range(3)]
                for cell in found:
                    for column, name in zip(counts, ("n", "good", "toxic"), strict=True):
                        column[cell["mask"]] = int(cell[name])
                yield pd.DataFrame(order_steps(part, *counts), columns=[f.split()[0] for f in STEPS.split(", ")])

    return parts.mapInPandas(run, STEPS)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return interaction_audit(failure_cells(read("documents"), read("labels")))


OP11_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
       list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT doc_id, part, [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
       100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
       doc_id > min(doc_id) OVER (PARTITION BY text)] AS f FROM w),
m AS (SELECT part, f, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad, count(*) AS n
       FROM d LEFT JOIN labels USING (doc_id) GROUP BY ALL),
a AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM (SELECT unnest(['A','B','C','D','E']) AS x) a,
       (SELECT unnest(['A','B','C','D','E']) AS x) b, (SELECT unnest(['A','B','C','D','E']) AS x) c,
       (SELECT unnest(['A','B','C','D','E']) AS x) d, (SELECT unnest(['A','B','C','D','E']) AS x) e
       WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, filter_order, step, good, bad, n, list_transform(string_split(filter_order, ''), lambda x: f[ascii(x) - 64]) AS g
       FROM m, a, (SELECT unnest(range(1, 6)) AS step)),
t AS (SELECT part, filter_order, step, good, bad, n, g[step] AS fails, list_contains(g[1:step-1], true) AS earlier,
       len(list_filter(g, lambda x: x)) AS fs FROM s),
r AS (SELECT part, filter_order, CAST(step AS INT) AS step, coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS kept,
       coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed, coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant,
       coalesce(sum(n) FILTER (fails AND fs = 1), 0) AS unique_fails, coalesce(sum(n) FILTER (fails AND NOT earlier AND good), 0) AS good_lost,
       coalesce(sum(n) FILTER (fails AND NOT earlier AND bad), 0) AS toxic_lost FROM t GROUP BY part, filter_order, t.step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM r
"""
