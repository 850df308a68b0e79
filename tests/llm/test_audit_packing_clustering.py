"""Filter audit, sequence packing and centroid clustering against brute-force versions."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import floor, isfinite

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zipledger.llm import centroid_clustering as cc
from zipledger.llm import filter_audit as fa
from zipledger.llm import sequence_packing as sp

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask int, part string, n long, key binary, grp int"


# -- filter audit --------------------------------------------------------------------------------

def test_least_squares_gives_shapley_values():
    rng = random.Random(1)
    for n in (2, 3, 5):
        v = [0] + [rng.randint(-50, 50) for _ in range(2**n - 1)]
        total = [0] * n
        orders = list(permutations(range(n)))
        for order in orders:
            done = 0
            for i in order:
                total[i] += v[done | 1 << i] - v[done]
                done |= 1 << i
        assert fa.shapley(v, n) == [Fraction(t, len(orders)) for t in total]


def _audit_brute(docs, labels):
    """Documents run through every order one by one. ``docs``: (id, text, source) rows."""
    age = lambda i: (i is not None, i or 0)
    first = {}
    for i, text, _ in docs:
        first[text or ""] = min(first.get(text or "", age(i)), age(i))
    out = defaultdict(lambda: [0] * 6)
    shap = defaultdict(int)
    parts = {s or "" for _, _, s in docs}
    for i, text, source in docs:
        text = text or ""
        ws = text.encode().split()
        fails = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * sum(c in fa.UPPER for c in text) > 5 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": age(i) > first[text]}
        good = any(q == 1 for j, q, _ in labels if j == i and i is not None)
        bad = any(t == 1 for j, _, t in labels if j == i and i is not None)
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                row = out[source or "", order, step]
                removed = fails[f] and not gone
                row[0] += not gone and not removed
                row[1] += removed
                row[2] += fails[f] and gone
                row[3] += fails[f] and sum(fails.values()) == 1
                row[4] += removed and good
                row[5] += removed and bad
                shap[source or "", f] += removed
                gone = gone or fails[f]
    return {(p, o, s, *out[p, o, s], shap[p, o[s - 1]]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)}


def _audit(spark, docs, labels):
    rows = spark.createDataFrame([(i, t, "en", s, 1, 7, "clash", 9, b"k", 3) for i, t, s in docs], DOCS).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return [tuple(r) for r in fa.interaction_audit(fa.failure_cells(rows, marks)).collect()]


def test_filter_audit_is_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}é" for i in range(400)]
    say = lambda n, k=400: " ".join(rng.choices(vocab[:k], k=n))
    long, dull = say(200), say(120, 20)
    texts = [None, "", " \n\t", long, long, long, dull, dull, "SHOUT " + long, "SHOUT ME $ " + say(10), say(49), say(50), "# " + dull, "ABC",
             "x y " * 40, "\x00|", say(30000), "日本 " * 60, long + " ", long]
    docs = [(i * 2 if i != 9 else None, t, f"s{i % 3}" if i % 5 else (None if i % 2 else "")) for i, t in enumerate(texts)]
    docs += [docs[3], docs[4], (6, long, "s2"), (-(2**63), "ABC", "s1"), (None, dull, "s1")]  # repeated rows, ids, null ids
    labels = [(6, 1, 0), (6, 0, 1), (8, 1, 1), (12, None, None), (None, 1, 1), (18, 0, 1), (20, 1, 0), (999, 1, 1)]
    got = _audit(spark, docs, labels)
    assert len(got) == len(set(got)) == 600 * 4
    assert set(got) == _audit_brute(docs, labels)


def test_filter_audit_of_empty_tables(spark):
    assert _audit(spark, [], []) == []
    assert set(_audit(spark, [(1, "a b", "x")], [])) == _audit_brute([(1, "a b", "x")], [])


# -- packing -------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def _ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


NASTY = ["", " ", "Hello, World. It's 3:45!?", "DON'T don't 'S x's. #. .# foo.bar, a.", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b <|startoftext|>.",
         "İstanbul ÀÉ é É. x́. ΟΔΟΣ ος", " nbsp em sep", "日本語 テキスト 한국어", "a\x1cb \x85 c\x0bd\x0ce", "ﬁ ﬀ Ǆ ß ẞ", "x" * 3000,
         "1234567890 ½ ² ① IX Ⅸ", "🙂🙂 👍🏽 e‍f", "</w> foo</w> w>", "ͅ ́a", "tail.,;:!? É. É"]


def test_ids_by_word_are_the_tokenizers(tokenizer):
    assert sp.word_pieces(open(TOKENIZER, encoding="utf-8").read())
    encode, dtype = sp.encoder(TOKENIZER)
    for texts in (NASTY, NASTY[::-1], [" ".join(NASTY)]):
        assert [np.frombuffer(b, dtype).tolist() for b in encode(texts)] == [_ids(tokenizer, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aZéÉİ .,'sS\n\t!?<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_of_any_text(text):
    encode, dtype = _ENCODER
    assert np.frombuffer(encode([text])[0], dtype).tolist() == _ids(_TOKENIZER, text)


_TOKENIZER, _ENCODER = Tokenizer.from_file(TOKENIZER), sp.encoder(TOKENIZER)


def test_other_tokenizer_files_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not sp.word_pieces(open(path, encoding="utf-8").read())
    encode, dtype = sp.encoder(path)
    other = Tokenizer.from_file(path)
    assert [np.frombuffer(b, dtype).tolist() for b in encode(NASTY)] == [_ids(other, t) for t in NASTY]


def test_tournament_tree_is_first_fit():
    rng = random.Random(2)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 60))), reverse=True)
        fills, bins = [], []
        for item, n in enumerate(lengths):
            found = next((b for b, f in enumerate(fills) if f + n <= 64), None)
            if found is None:
                fills.append(0)
                bins.append([])
                found = len(bins) - 1
            fills[found] += n
            bins[found].append(item)
        assert sp.first_fit_decreasing(lengths, 64) == bins


def test_gaps_are_filled_and_no_id_lost():
    rng = random.Random(4)
    for _ in range(100):
        lengths = sorted((rng.choice([rng.randint(1, 64), 64]) for _ in range(rng.randint(1, 40))), reverse=True)
        out = sp.fill_gaps([[(i, 0, lengths[i]) for i in b] for b in sp.first_fit_decreasing(lengths, 64)], 64)
        sizes = [sum(n for _, _, n in b) for b in out]
        assert all(s == 64 or s & (s - 1) == 0 for s in sizes) and sum(s < 64 for s in sizes) <= 6
        pieces = sorted(p for b in out for p in b)
        at = dict.fromkeys(range(len(lengths)), 0)
        for i, start, n in pieces:
            assert start == at[i] and n > 0
            at[i] += n
        assert list(at.values()) == lengths
    assert sp.fill_gaps([], 64) == []


def test_packing_holds_every_id_once(spark, tokenizer):
    rng = random.Random(7)
    texts = [None, *NASTY, *[" ".join(rng.choices(["alpha", "Béta,", "gamma.", "x1"], k=rng.randint(0, 300))) for _ in range(150)], "word " * 9000, "same", "same"]
    rows = [(i if i != 20 else None, t, "en", "s", 1, 1, "clash", 1, b"k", 5) for i, t in enumerate(texts)]
    rows += [rows[5], rows[40]]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    out = sp.pack_documents(docs, TOKENIZER, 2, length=256, group_bytes=20000)
    got = out.collect()
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    found, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        found[r.doc_id].append((r.start, r.doc_tokens, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(_ids(tokenizer, t or "") + [2])
    assert found.keys() == want.keys()
    for i, whole in want.items():
        every = sorted(found[i])
        assert all(n == len(whole[0]) for _, n, _ in every)
        pieces = sorted((s, ids) for s, _, ids in every)
        if len(whole) == 1:
            assert [x for _, ids in pieces for x in ids] == whole[0]
            assert [s for s, _ in pieces] == np.cumsum([0, *[len(ids) for _, ids in pieces]])[:-1].tolist()
        else:
            assert sum(len(ids) for _, ids in pieces) == sum(map(len, whole))
            assert all(ids == whole[0][s:s + len(ids)] for s, ids in pieces)
    groups = {s >> 24 for s in sequences}
    for members in sequences.values():
        members.sort()
        ends = [o + n for o, n in members]
        assert [o for o, _ in members] == [0, *ends[:-1]]
        assert ends[-1] == 256 or ends[-1] & (ends[-1] - 1) == 0
    assert len(groups) > 3 and sum(sum(n for _, n in m) < 256 for m in sequences.values()) <= 8 * len(groups)


def test_packing_of_no_documents(spark):
    assert sp.pack_documents(spark.createDataFrame([], DOCS), TOKENIZER, 2).collect() == []
    with pytest.raises(ValueError):
        sp.pack_documents(spark.createDataFrame([], DOCS), TOKENIZER, 2, length=100)


# -- clustering ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, norm string, planes int, hash int"


def _cluster_brute(rows, k, rounds, scale=1024):
    kept = [(i, [floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (a, _) in zip(kept, found, strict=True) if a == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, *a) for (i, _), a in zip(kept, assign(), strict=True)), key=repr), centroids


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "clash", 3, 4) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("spread", [0.5, 90.0, 0.002])
def test_clusters_are_exact(spark, spread):
    rng = np.random.default_rng(11)
    middles = rng.normal(0, spread, (6, 64))
    rows = [(i, (middles[i % 6] + rng.normal(0, spread / 3, 64)).astype(np.float32).tolist()) for i in range(160)]
    rows += [rows[4], rows[4], (4, rows[9][1]), (None, rows[3][1]), (500, None), (501, []), (502, rows[0][1][:63]), (503, [*rows[0][1], 0.0]),
             (504, [float("nan"), *rows[0][1][1:]]), (505, [float("inf"), *rows[0][1][1:]]), (506, [None, *rows[0][1][1:]]), (507, [0.0] * 64), (508, [-0.0] * 64)]
    found, centroids = cc.cluster_vectors(_vectors(spark, rows), k=8, rounds=10)
    want, final = _cluster_brute(rows, 8, 10)
    assert centroids == final
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    out = [r.asDict() for r in cc.with_inertia(found, centroids).collect()]
    assert {r["inertia"] for r in out} == {sum(d for *_, d in want)}
    for r in out:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, final[r["cluster"]])).encode()).hexdigest()


def test_few_equal_or_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0] * 64)], [(i, [0.25] * 64) for i in range(20)], [(1, [1.0] * 64), (2, [-1.0] * 64), (2, [-1.0] * 64)]):
        found, centroids = cc.cluster_vectors(_vectors(spark, rows), k=8, rounds=10)
        want, final = _cluster_brute(rows, 8, 10)
        assert (sorted((tuple(r) for r in cc.with_inertia(found, centroids).select("vec_id", "cluster", "distance").collect()), key=repr), list(centroids)) == (want, final)


def test_components_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        cc.cluster_vectors(_vectors(spark, [(1, [1e9] * 64)]), k=2, rounds=1)
    rows = [(i, [(-1) ** i * 131071.0] * 64) for i in range(9)]
    found, centroids = cc.cluster_vectors(_vectors(spark, rows), k=2, rounds=3)
    assert (sorted((tuple(r) for r in found.collect()), key=repr), centroids) == _cluster_brute(rows, 2, 3)


def test_popcounts_are_dot_products():
    rng = np.random.default_rng(5)
    for top in (1, 2, 7, 1000, 2**27 - 1):
        a, b = rng.integers(-top, top + 1, (20, 64)), rng.integers(-top, top + 1, (3, 64))
        bits = int(max(a.max(), b.max(), -a.min() - 1, -b.min() - 1)).bit_length() + 1
        assert (cc.dot_products(cc.bit_planes(a, bits), cc.bit_planes(b, bits)) == a @ b.T).all()
        assert (cc.plane_sums(cc.bit_planes(a, bits)) == a.sum(axis=0)).all()
