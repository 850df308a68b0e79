"""Each operator against a brute-force version on a small table with nulls, empty, long, repeated and tied rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import mmap
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zipledger.llm import (chat_format, common, decontaminate, fingerprint, jaccard_join, language_id, line_dedup, mixing, ngram_lm,
                           substring_dedup, token_count)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, h1 int, shard int, bucket int, sig int"


def _texts() -> list[str | None]:
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    base, passage = say(80), say(30)
    near = base.split()
    near[40] = "changed"
    shared = "\n  A Shared Line of text \t\nshort\n"
    return [None, "", "   \n\t ", base, base, " ".join(near), base.upper(), say(40) + shared + say(20), say(25) + shared + "tail",
            say(20) + " " + passage + " " + say(20), "zz " + passage, passage + " yy", say(3), say(3), "one", "one", "\n\n",
            "x " * 3000, "x " * 2999, say(4000), "\\<turn> 日本語 text\u00a0joined", base + "\n" + passage, "a b c d", "A b c D"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = _texts()
    rows = [(i * 3 if i != 7 else None, t, "en" if i % 3 else "fr", f"src{i % 4}" if i != 5 else None, 1, "clash", 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def _words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


# -- helpers ------------------------------------------------------------------------------------

def test_packed_keys_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 2**63), (2, 2**64 - 1), (1000, 2**64 - 1), (1000, 5000), (50, 2**40)):
        keys = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        assert (common.unpack_keys(common.pack_keys(keys)) == keys).all()


def test_words_are_the_same_on_both_sides(docs):
    got = docs.select("text", common.words(F.col("text")).alias("ws")).collect()
    assert all([w.encode() for w in r.ws] == _words(r.text) for r in got)


# -- 1 ------------------------------------------------------------------------------------------

def test_fingerprints(docs, empty):
    got = fingerprint.fingerprint_with_edits(docs).collect()
    rows = _rows(docs)
    ids = sorted({r[0] for r in rows}, key=lambda i: (i is not None, i or 0))
    text = {i: min((t or "") for k, t in rows if k == i) for i in ids}
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    for r in got:
        by_text[text[r.doc]].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())  # equal texts, equal fingerprints
    fp = {r.doc: r.fingerprint for r in got}
    for r in got:
        nxt = ids[(ids.index(r.doc) + 1) % len(ids)]
        t, q = text[r.doc], len(text[r.doc]) // 4
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - q] + text[nxt][:q]).encode()).hexdigest()
        same = sum(r.fingerprint[4 * j:4 * j + 4] == fp[nxt][4 * j:4 * j + 4] for j in range(64)) / 64
        assert r.near_next == pytest.approx(same)
        assert len(r.fingerprint) == 256
    assert next(r.near_edited for r in got if r.n_chars > 9000) > 0.15
    assert fingerprint.fingerprint_with_edits(empty).count() == 0


def test_fingerprint_equals_direct_order_minhash(spark):
    """The signature against a plain Python version of the same orders, given Spark's hashes of the numbered k-mers."""
    texts = ["a b c d e f g", "a a a a b a a a", "q", "w e r t y u i o p w e r t y"]
    m, l, k, pos_bits, hash_bits = 64, 2, 3, 22, 41  # noqa: E741
    for t in texts:
        ws = t.split()
        hs = [spark.range(1).select(F.xxhash64(*[F.lit(x) for x in ws[i:i + k]], *[F.lit(None).cast("string")] * max(0, i + k - len(ws))))
              .first()[0] for i in range(len(ws))]
        hs = [(h % 2**64) >> (64 - hash_bits) for h in hs]
        seen, items = Counter(), []
        for i, h in enumerate(hs):
            seen[h] += 1
            g = h if seen[h] == 1 else (spark.range(1).select(F.xxhash64(F.lit(h).cast("long"), F.lit(seen[h] - 1).cast("int"))).first()[0] % 2**64) >> (64 - hash_bits)
            items.append((g, i))
        items.sort(key=lambda x: (x[0] << pos_bits) | x[1])
        want = []
        for j in range(m):
            point = j << (hash_bits - 6)
            order = [x for x in items if x[0] >= point] + [x for x in items if x[0] < point]
            pick = sorted([order[i % len(order)] for i in range(l)], key=lambda x: (x[1], x[0]))
            h = spark.range(1).select(F.xxhash64(F.array(*[F.lit(x[0]).cast("long") for x in pick]))).first()[0]
            want.append(f"{h % 65536:04x}")
        got = spark.createDataFrame([(t,)], "t string").select(fingerprint.order_minhash(F.col("t"))).first()[0]
        assert got == "".join(want)


# -- 2 ------------------------------------------------------------------------------------------

def test_token_counts(docs, empty):
    pieces = [b" ", b" a", b" ab", b"a", b"b", b"c", b"d", b"e", b"bc", b"bcd", b"cde", b"de", b"\xc3", b"\xa9", b"abc"]

    def brute(word):
        i = n = 0
        while i < len(word):
            j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
            if j is None:
                return 1
            i, n = j, n + 1
        return n

    got = token_count.token_counts(docs, pieces).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.n_tokens) == (len(_words(r.text)), sum(brute(b" " + w) for w in _words(r.text)))
    assert token_count.token_counts(empty, pieces).count() == 0


# -- 3 ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(20))
def test_suffix_automaton(seed):
    rng = random.Random(seed)
    texts = [rng.choices(range(rng.choice([1, 2, 5])), k=rng.randint(0, 30)) for _ in range(12)]
    automaton = substring_dedup.SuffixAutomaton()
    for owner, text in enumerate(texts):
        automaton.add(text, owner)
    for window in (1, 3, 7):
        has = [{tuple(t[i:i + window]) for i in range(len(t) - window + 1)} for t in texts]
        for text in [*texts, rng.choices(range(3), k=40)]:
            spans = [tuple(text[i:i + window]) for i in range(len(text) - window + 1)]
            want = [next(o for o, h in enumerate(has) if s in h) for s in spans if any(s in h for h in has)]
            assert automaton.first_owners(text, window) == want


def test_substring_dedup(docs, empty):
    rows, first = _rows(docs), {}
    key = lambda i: -1 if i is None else i
    for i, t in rows:
        ws = _words(t)
        for s in range(len(ws) - 12):
            w = tuple(ws[s:s + 13])
            first[w] = min(first.get(w, key(i)), key(i))
    want = []
    for i, t in rows:
        ws = _words(t)
        gone = {s + j for s in range(len(ws) - 12) if first[tuple(ws[s:s + 13])] < key(i) for j in range(13)}
        want.append((i, len(ws), len(gone), b" ".join(w for j, w in enumerate(ws) if j not in gone).decode()))
    for crowd in (substring_dedup.CROWD, 2):  # 2: frequent anchors send single windows
        got = substring_dedup.dedup_substrings(docs, crowd=crowd).collect()
        assert sorted(map(repr, want)) == sorted(repr((r.doc, r.n_words, r.n_removed, r.kept_text)) for r in got)
        assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)
    assert substring_dedup.dedup_substrings(empty).count() == 0


# -- 4 ------------------------------------------------------------------------------------------

def test_language_id(spark, empty):
    rng = random.Random(3)
    words = {"aa": ["abra", "cada", "bana", "kara"], "zz": ["zuzu", "xoxo", "wuxo", "zoxu"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(8, 40))), lang, "s") for i in range(120) for lang in ("aa", "zz")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    probes = spark.createDataFrame([(1, "kara bana abra", "x"), (2, None, "x"), (3, "", "x"), (4, "12 !!", "x"), (5, "zoxu zuzu " * 9000, "x"),
                                    (6, "qqqq " * 400, "x"), (None, "xoxo wuxo", "x"), (1, "kara bana abra", "x")], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in language_id.predict(probes, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "aa", False), (2, "und", True), (3, "und", True), (4, "und", True), (5, "zz", False),
                                           (6, got[5][1], True), (None, "zz", False), (1, "aa", False)], key=str)
    none = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.predict(probes, none).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_short_foreign_texts_are_rejected(spark):
    rng = random.Random(6)
    vocab = {"aa": ["abra", "cada", "bana", "kara", "da"], "zz": ["zuzu", "xoxo", "wuxo", "zoxu", "ux"]}
    rows = [(i, " ".join(rng.choices(vocab[lang], k=rng.randint(8, 40))), lang) for i in range(120) for lang in vocab]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    clean = [" ".join(rng.choices(vocab[lang], k=n)) for lang in vocab for n in (1, 2, 3, 5, 7) for _ in range(10)]
    foreign = ["日本語の文章です。短い", "".join(rng.choices("efghijlmnpqstvy", k=29)), "qqq", "где мы"]
    probes = spark.createDataFrame([(t,) for t in clean + foreign], "text string")
    got = {r.text: r.rejected for r in language_id.predict(probes, model).collect()}
    assert got == dict.fromkeys(clean, False) | dict.fromkeys(foreign, True)


# -- 5 ------------------------------------------------------------------------------------------

def _line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_line_dedup(docs, empty):
    rows, first = _rows(docs), {}
    key = lambda i: -1 if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = _line_key(line)
            first[k] = min(first.get(k, key(i)), key(i))
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(_line_key(x)) >= 10 and first[_line_key(x)] < key(i))]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text)) for r in got)
    assert {r.row.doc for r in got} == {"clash"}
    assert line_dedup.dedup_lines(empty).count() == 0


# -- 6 ------------------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    nasty = ["</turn>", "\\</turn>\n", "<turn>user\n<text>", "\\", "", None, "é\n<text>x", "plain", "\n</turn>\n", "\\\\<text>"]
    rows = [(c, t, ["user", "assistant", "assistant", None, "a<turn>\nb"][(c + t) % 5], nasty[(c * 3 + t) % len(nasty)]) for c in range(8) for t in range(2 + 3 * c)]
    rows += [(None, 1, "assistant", "x"), (None, None, "assistant", "y"), (99, 1, "user", "b"), (99, 1, "user", "a"), (99, 1, "user", "a")]
    rows += [(100, i, "assistant", f"t{i}<text>") for i in range(2500)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1))
    got = {r.conv: r for r in chat_format.read_chats(chat_format.format_chats(table)).collect()}
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        want = [(r, t) for _, r, t in sorted(turns)]
        assert [(x.role, x.text) for x in got[c].turns] == want
        assert got[c].loss_text == "".join(t for r, t in want if r == "assistant")
    # adjacent turns of one role share a block
    assert got[100].formatted.count("<turn>") == 1
    assert chat_format.format_chats(table.limit(0)).count() == 0


# -- 7 ------------------------------------------------------------------------------------------

def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 50), ("b", "x", "s4", 5)],
                                   "domain string, lang string, source string, tokens long")
    plan = mixing.budgets(leaves, ["domain", "lang", "source"], {"domain": {"a": 1, "b": 1}}, 400, 1)
    got = {r.source: r.alloc for r in plan.collect()}
    # b can give 5 of its 200: a gets 395; y gives 50 of 197; x gets 345: s1 gives 10 of 172, s2 the rest
    assert got == {"s1": 10, "s2": 335, "s3": 50, "s4": 5}
    zero = mixing.budgets(leaves, ["domain"], {"domain": {"a": 0}}, 400, 1).collect()
    assert {r.domain for r in zero} == {"b"}


def test_weight_zero_adds_no_capacity_to_its_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 1000), ("a", "y", 10), ("b", "y", 1000)], "domain string, lang string, tokens long")
    plan = mixing.budgets(leaves, ["domain", "lang"], {"lang": {"x": 0}}, 400, 1).collect()
    assert {(r.domain, r.lang): r.alloc for r in plan} == {("a", "y"): 10, ("b", "y"): 390}


def test_mix_takes_prefixes_of_epochs(docs, empty):
    got = mixing.corpus_mix(docs).collect()
    total = sum(len(_words(t)) for t in {r[0]: r[1] for r in _rows(docs)}.values())
    assert 0 < sum(r.n_tokens for r in got) <= total * 3 // 5
    assert all(n == 1 for n in Counter((r.doc, r.text_key, r.epoch) for r in got).values())
    assert mixing.corpus_mix(empty).count() == 0


def test_mix_of_many_leaves_is_the_same(docs):
    """Leaves beyond the broadcast bound: rows are dealt by salt, and the choice stays."""
    levels = {"lang": F.col("lang"), "salt": F.col("source")}
    few, many = (mixing.select_mix(docs, levels, {"lang": mixing.LANGUAGE_WEIGHTS}, F.expr("tokens * 3 div 5"), broadcast_leaves=n)
                 for n in (mixing.BROADCAST_LEAVES, 0))
    assert few.columns == many.columns and few.count() > 0
    assert Counter(map(tuple, few.collect())) == Counter(map(tuple, many.collect()))


# -- 8 ------------------------------------------------------------------------------------------

def test_decontaminate(spark, docs, empty):
    texts = _texts()
    passage = texts[11].rsplit(" ", 1)[0]
    ws = passage.split()
    items = spark.createDataFrame([(1, passage), (2, " ".join([*ws[:15], "other", *ws[16:]])), (3, "one"), (4, None), (5, ""), (6, "a b c d"),
                                   (7, "unseen words in this item here"), (7, "unseen words in this item here"), (None, passage.upper())],
                                  "item_id long, text string").withColumn("doc_id", F.lit(1))

    def shingles(t):
        w = (t or "").lower().split()
        return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = {(r.doc_id, i.item_id) for r in docs.collect() for i in items.collect() if shingles(i.text)
            and len(shingles(i.text) & shingles(r.text)) * 100 >= 80 * len(shingles(i.text))}
    for rows in (10**6, 0):  # broadcast and shuffled sketches
        got = decontaminate.contained_items(docs, items, broadcast_rows=rows).collect()
        assert {(r.doc, r.item) for r in got} == want and len(want) > 5
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, _rows(kept))) == sorted(repr((i, t)) for i, t in _rows(docs) if i not in {d for d, _ in want})
    assert decontaminate.contained_items(empty, items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_short_items_are_found_in_long_texts(spark):
    long = "here is one Longer text that holds a few short items and ends so"
    table = spark.createDataFrame([(1, long), (2, "few short"), (3, "short few items are not in that order here"), (4, "so"), (5, None), (6, "a few short items")],
                                  "doc_id long, text string")
    items = spark.createDataFrame([(1, "few short"), (2, "SO"), (3, "a few  short items"), (4, "one longer text that holds a"), (5, "absent"), (6, "")],
                                  "item_id long, text string")
    want = {(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (4, 2), (6, 1), (6, 3)}
    for rows in (10**6, 0):
        got = decontaminate.contained_items(table, items, broadcast_rows=rows).collect()
        assert sorted((r.doc, r.item) for r in got) == sorted(want)
    assert {r.doc_id for r in decontaminate.drop_contaminated(table, items).collect()} == {3, 5}


# -- 9 ------------------------------------------------------------------------------------------

def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, universe in ((0, 10), (1, 1), (500, 600), (500, 1 << 50), (1, 1 << 60)):
        values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
        ef = ngram_lm.EliasFano(*ngram_lm.EliasFano.encode(values, universe))
        assert (ef.get(np.arange(n)) == values).all()
        probes = rng.integers(0, universe, 50, dtype=np.uint64)
        at = ef.successor(probes, np.zeros(50, np.int64), np.full(50, n))
        assert (at == np.searchsorted(values, probes)).all()


def test_contexts_are_told_apart_by_64_bits():
    # contexts that share their low 32 bits keep their own successors
    contexts = np.array([7, 7 + (1 << 32), 7 + (5 << 40)], np.uint64)
    keys = np.array([0 << 32 | 3, 0 << 32 | 9, 1 << 32 | 3, 2 << 32 | 1], np.uint64)
    level = ngram_lm.Level(ngram_lm.build_level(contexts, keys, np.array([2, 1, 5, 1])))
    prob, backoff = level.query(np.array([7, 8, 7 + (1 << 32), 7 + (5 << 40)], np.uint64), np.array([3, 1, 2, 1]),
                                np.array([3, 4, 9, 3, 3, 9, 3], np.uint32))
    p = [(2 - .75) / 3, 0, .25 / 3, 0, (5 - .75) / 5, 0, 0]
    assert prob.tolist() == ngram_lm.encode_prob(np.array(p)).tolist()
    b = [2 * .75 / 3] * 3 + [1] + [.75 / 5] * 2 + [.75]
    assert backoff.tolist() == ngram_lm.encode_prob(np.array(b)).tolist()


def test_lm_scores(docs, empty):
    rows = _rows(docs)
    tokens = [[*_words(t, lower=True), None] for _, t in rows]
    learn = [zlib.crc32(str("null" if i is None else i).encode()) % 7 != 2 for i, _ in rows]
    count = Counter(w for ws, ok in zip(tokens, learn, strict=True) if ok for w in ws)
    pairs = Counter(p for ws, ok in zip(tokens, learn, strict=True) if ok for p in zip([b"<s>", *ws], ws, strict=False))
    n, v = sum(count.values()), len(count)
    total, fan = Counter(), Counter()
    for (c, _), m in pairs.items():
        total[c] += m
        fan[c] += 1
    want = []
    for (i, _), ws in zip(rows, tokens, strict=True):
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        model = 0.0
        for c, w in zip([b"<s>", *ws], ws, strict=False):
            p1 = (count[w] + 1) / (n + v + 1)
            model += math.log10((max(pairs[c, w] - 0.75, 0) + 0.75 * fan[c] * p1) / total[c] if total[c] else p1)
        want.append((i, len(ws), sum(count[w] > 0 for w in ws), n, base, model))
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 7 != 2
    got = ngram_lm.score_texts(docs, train).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert len(got) == len(want)
    for g, w in zip(sorted([(r.doc, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=order), sorted(want, key=order), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4])
        assert w[5] - 0.1 * w[1] - 1e-9 <= g[5] <= w[5] + 1e-9  # codes are rounded down, by under a tenth of a decade in all
    assert ngram_lm.score_texts(empty, train).count() == 0
    alone = ngram_lm.score_texts(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in alone} == {0} and {r.n_known for r in alone} == {0}


def test_packed_level_equals_sorted_search():
    # low bits take their width, nothing is unpacked on opening, and a mapped level answers as its buffers do
    rng = np.random.default_rng(5)
    for n, universe in ((3000, 1 << 40), (3000, 3100), (3000, 1 << 64), (2, 1 << 64)):
        values = np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
        coded = ngram_lm.EliasFano.encode(values, universe)
        _, width, low, high, _ = coded
        assert len(low) <= len(values) * width / 8 + 16 and len(high) <= len(values) * 3 / 8 + 16
        ef = ngram_lm.EliasFano(*coded)
        assert (ef.get(np.arange(len(values))) == values).all()
        probes = np.concatenate([values, rng.integers(0, universe - 1, 500, dtype=np.uint64, endpoint=True)])
        at, same = ef.locate(probes)
        assert (at == np.searchsorted(values, probes)).all() and (same == np.isin(probes, values)).all()
    contexts = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    grams = [(r, int(w)) for r in range(len(contexts)) for w in sorted({*rng.integers(0, 1 << 32, r % 7 + 1).tolist()})]
    counts = rng.integers(1, 9, len(grams))
    built = ngram_lm.build_level(contexts, np.array([r << 32 | w for r, w in grams], np.uint64), counts)
    mapped = ngram_lm.map_level(built)
    assert isinstance(mapped["successors"][2], memoryview) and isinstance(mapped["successors"][2].obj, mmap.mmap)
    fan, words = np.full(len(contexts), 2), np.array([x for r in range(len(contexts)) for x in (next(w for c, w in grams if c == r), 5)], np.uint64)
    total, size = Counter(), Counter()
    for (r, _), c in zip(grams, counts.tolist(), strict=True):
        total[r] += c
        size[r] += 1
    first = {r: c for (r, _), c in reversed(list(zip(grams, counts.tolist(), strict=True)))}
    prob = [x for r in range(len(contexts)) for x in ((first[r] - .75) / total[r], 0)]
    for level in (built, mapped):
        got = ngram_lm.Level(level).query(contexts, fan, words)
        assert got[0].tolist() == ngram_lm.encode_prob(np.array(prob)).tolist()
        assert got[1][::2].tolist() == ngram_lm.encode_prob(np.array([.75 * size[r] / total[r] for r in range(len(contexts))])).tolist()


@pytest.mark.parametrize("bucket_tokens", [1, 60, 10**6])
def test_lm_trigram_scores(spark, docs, bucket_tokens):
    # exact model over trigrams that one bucket has alone, that several share, and that only held-out texts have
    more = [(100 + i, " ".join(t)) for i, t in enumerate(itertools.product(["a", "b", "The"], ["x", "y"], ["a", "z"], ["x"]))]
    more += [(200, "a x a x a x a x"), (201, "alone in the world"), (202, "alone in the world"), (203, "a x new"), (204, "a"), (205, "")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(3).localCheckpoint()
    rows = _rows(table)
    learn = [zlib.crc32(str("null" if i is None else i).encode()) % 7 != 2 for i, _ in rows]
    grams = [Counter(), Counter(), Counter()]
    texts = [[*_words(t, lower=True), None] for _, t in rows]

    def contexts(ws, k):
        return [tuple([b"<s>", *ws][k + 1 - j:k + 1]) for j in range(min(3, k + 2))]

    for ws, ok in zip(texts, learn, strict=True):
        for k, w in enumerate(ws):
            for j, c in enumerate(contexts(ws, k)):
                grams[j][c, w] += ok
    grams = [+g for g in grams]
    n, v = sum(grams[0].values()), len(grams[0])
    total, fan = Counter(), Counter()
    for g in grams[1:]:
        for (c, _), m in g.items():
            total[c] += m
            fan[c] += 1
    want = []
    for (i, _), ws in zip(rows, texts, strict=True):
        score = 0.0
        for k, w in enumerate(ws):
            p = (grams[0][(), w] + 1) / (n + v + 1)
            for j, c in enumerate(contexts(ws, k)):
                if total[c]:
                    p = (max(grams[j][c, w] - 0.75, 0) + 0.75 * fan[c] * p) / total[c]
            score += math.log10(p)
        want.append((i, len(ws), score))
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 7 != 2
    got = [(r.doc, r.n_tokens, r.score) for r in ngram_lm.score_texts(table, train, order=3, bucket_tokens=bucket_tokens).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert g[:2] == w[:2] and w[2] - 0.15 * w[1] - 1e-9 <= g[2] <= w[2] + 1e-9  # two codes a level, rounded down
    whole = [(r.doc, r.n_tokens, r.score) for r in ngram_lm.score_texts(table, train, order=3).collect()]
    for g, w in zip(sorted(got, key=order), sorted(whole, key=order), strict=True):
        assert g[2] == pytest.approx(w[2], abs=1e-9)                 # the buckets don't show
    assert {r.doc for r in ngram_lm.score_texts(table, F.lit(False), order=3).collect()} == {i for i, _ in rows}


def test_lm_query_uses_trigrams(spark, tmp_path):
    # after "b", only the word before it tells "x" from "y"
    held, other = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    table = [(i, "a b x" if i % 2 else "c b y") for i in range(40)] + [(held, "a b x"), (other, "a b y")]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in ngram_lm.op9_lm_score(spark, str(tmp_path)).collect()}
    assert got[held] - got[other] > 1


def test_lm_tokens_are_those_of_bytes_split():
    odd = ["", " ", None, "\t a  b ", "a", " a", *(f"x{chr(c)}Y" for c in (*range(1, 160), 0x1680, 0x2003, 0x2028, 0x3000)), "É\u00a0Z \x1cz"]
    want = [[*(t or "").encode().lower().split(), None] for t in odd]
    for at in (0, 3):                                                # a slice of a batch, too
        lengths, words = ngram_lm._tokenised(pa.array(odd, pa.string()).slice(at))
        assert lengths.tolist() == [len(w) for w in want[at:]]
        assert [w.encode() for w in words.to_pylist()] == [w for ws in want[at:] for w in ws[:-1]]
    batch = pa.record_batch({"text": pa.array([None, "a" * (9 << 20), "", "b", "c" * (8 << 20), None])})
    assert [r.num_rows for r in ngram_lm._slices(batch)] == [1, 3, 2]


def _asked(tables, shard):
    return pd.DataFrame([r for t in tables for r in t.to_pylist() if r["shard"] == shard])


def _buckets(texts, size=10**6):
    batch = pa.record_batch({"doc": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts), "train": [True] * len(texts)})
    return [pa.Table.from_batches([b]) for b in ngram_lm._read_texts(iter([batch]), pa.int64(), size)]


def test_lm_shard_is_asked_once_for_each_ngram(monkeypatch):
    # the work of a shard follows its n-grams, not the buckets that send the same ones
    monkeypatch.setattr(ngram_lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rows = _buckets(["a b c a b", "a b c", "b c d", "a b c a b", "a b c a b"], size=1)
    assert len(rows) == 5
    asked, found, find = [], [], ngram_lm.Level.find
    monkeypatch.setattr(ngram_lm.Level, "find", lambda self, c, fan, w: (found.append((c, fan, w)), find(self, c, fan, w))[1])
    told = ngram_lm._answers(_asked([ngram_lm._ask_bigrams(r, 1) for r in rows], 0), .75, True)
    assert len(found) == 1
    contexts, fan, words = found[0]
    assert len(contexts) == len({*contexts.tolist()}) == 5 and fan.sum() == len(words) == 9  # the start, a to d; a>b, b>c, b>end, ...
    assert sorted(told["bucket"]) == sorted(r.column("bucket")[0].as_py() for r in rows) and (told["n"] == 26).all() and (told["v"] == 5).all()
    one = {r["bucket"]: r for r in told.to_dict("records")}
    same = [one[rows[i].column("bucket")[0].as_py()] for i in (0, 3, 4)]
    assert len({(r["probs"], r["backoffs"], r["totals"], r["shared"]) for r in same}) == 1


def test_lm_words_with_equal_low_bits_are_one_context(spark):
    # successors are told apart by 32 bits, so what follows them must not depend on which of two such words a bucket meets first
    names = [f"w{i}" for i in range(300_000)]
    low = common.mix(np.array([ngram_lm.xxh3_64_intdigest(w.encode()) for w in names], np.uint64)) & np.uint64(0xFFFFFFFF)
    order = np.argsort(low, kind="stable")
    i = int(np.flatnonzero(np.diff(low[order].astype(np.int64)) == 0)[0])
    one, other = names[order[i]], names[order[i + 1]]
    table = spark.createDataFrame([(0, f"a {one} x a {other} y"), (1, f"a {other} y a {one} x"), (2, f"a {one} y"), (3, f"a {other} x")],
                                  "doc_id long, text string").coalesce(1).localCheckpoint()
    got = [sorted((r.doc, r.score) for r in ngram_lm.score_texts(table, F.lit(True), order=3, bucket_tokens=size).collect()) for size in (1, 10**6)]
    assert [s for _, s in got[0]] == pytest.approx([s for _, s in got[1]], abs=1e-9)


# -- 10 -----------------------------------------------------------------------------------------

def _components(sets, percent):
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for j, a in enumerate(sets):
        for i, b in enumerate(sets[:j]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def _shingle_set(text, k):
    w = _words(text, lower=True)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("tile", [4096, 5])
def test_jaccard_components(spark, tile):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.randint(6, 120))
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy + rng.choices(vocab, k=rng.choice([0, 0, 2]))))
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for k, percent in ((4, 85), (2, 60)):
        sets = [_shingle_set(t, k) for t in texts]
        want = _components(sets, percent)
        got = {r.doc: r for r in jaccard_join.similar_components(table, k=k, percent=percent, tile=tile).collect()}
        assert [got[i].component for i in range(len(texts))] == want
        assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_jaccard_edge_cases(docs, empty):
    got = jaccard_join.similar_components(docs, k=4, percent=85).collect()
    rows = sorted(set(_rows(docs)), key=lambda r: (r[0] is not None, r[0] or 0))
    want = _components([_shingle_set(t, 4) for _, t in rows], 85)
    assert sorted((repr((i, rows[w][0])) for (i, _), w in zip(rows, want, strict=True))) == sorted(repr((r.doc, r.component)) for r in got)
    kept = jaccard_join.keep_first(docs, k=4, percent=85)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for (i, _), w in zip(rows, want, strict=True) if rows[w][0] == i}
    assert jaccard_join.similar_components(empty).count() == 0


@pytest.mark.parametrize(("tile", "k", "percent"), [(4096, 4, 40), (3, 1, 80)])
def test_jaccard_keeps_every_link(spark, tile, k, percent):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    texts = []
    for copies in (1, 2, 5, 9, 30):  # small and large groups
        base = rng.choices(vocab, k=60)
        for c in range(copies):
            copy = list(base)
            copy[rng.randrange(60)] = copy[rng.randrange(60)] = f"new{copies}x{c}"
            texts += [" ".join(copy)] * (3 if c == 1 else 1)
    table = spark.createDataFrame([*enumerate(texts), (500, None)], "doc_id long, text string").repartition(4)
    sets = [frozenset(_shingle_set(t, k)) for t in texts]
    links = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets) if i != j and 100 * len(a & b) >= percent * len(a | b)}
    got = {r.doc: r.n_links for r in jaccard_join.similar_components(table, k=k, percent=percent, tile=tile).collect()}
    assert got == {i: sum(x == i for x, _ in links) for i in range(len(texts))} | {500: 0}
    first = {s: i for i, s in reversed(list(enumerate(sets)))}
    many = Counter(sets)
    want = {(i, many[sets[i]], j, many[sets[j]], len(sets[i] & sets[j])) for i, j in links if i < j
            and sets[i] != sets[j] and first[sets[i]] == i and first[sets[j]] == j}
    rows = jaccard_join.similar_pairs(table, k=k, percent=percent, tile=tile).collect()
    assert sorted((r.a_doc, r.a_n_docs, r.b_doc, r.b_n_docs, r.n_shared) for r in rows) == sorted(want) and len(want) > 300


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    a, b, c = (" ".join(rng.choices(vocab, k=60)) for _ in range(3))
    rows = [(None, a, "s"), (None, a, "s"), (None, a + " more", "s"), (None, b, "s"), (4, b, "s"), (5, c, "s"), (5, c, "s"), (5, c, "t"),
            (6, c + " more", "s"), (7, None, "s"), (7, None, "s"), (None, "", "s"), (7, b + " other", "s")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = jaccard_join.keep_first(table)
    assert kept.columns == table.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=repr)
    one = next(t for _, t, _ in got if t and t.startswith(a))  # the smaller text key decides between texts without an id
    assert got == sorted([(None, one, "s"), (None, b, "s"), (5, c, "s"), (7, None, "s"), (None, "", "s")], key=repr)
