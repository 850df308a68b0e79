"""The pipeline's stages on tables with nulls, repeated rows and clashing column names, and the faults found in its operators."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zipledger.llm import jaccard_join, language_id, substring_dedup

SF = "/root/testdata/sf0.001"
CLASH = ("doc_id long, text string, lang string, source string, n_chars long, _doc string, _key int, _i int, domain string, n_tokens int, epoch string, "
         "_lang_pred string, row string, doc int, text_key string, h int, d string, m string")


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), f"own{n}", n, n + 1, "dom", -n, "ep", "lp", "r", n, "tk", n, "d", "m")
                                  for n, (i, t, lang, s) in enumerate(rows)], CLASH).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = {"aa": ["abra", "cada", "bana", "kara", "dara"], "zz": ["zuzu", "xoxo", "wuxo", "zoxu", "uxux"]}
    out = [(i, " ".join(rng.choices(vocab[lang], k=rng.randint(15, 60))) + ".", lang, f"src{i % 3}") for i in range(80) for lang in vocab]
    out = [(n, *r[1:]) for n, r in enumerate(out)]
    near = out[0][1].split()
    return [*out, (500, None, None, None), (501, "", "aa", "src1"), (502, "12 !!", None, "src1"), (503, out[1][1], None, None), (None, out[2][1] + " kara", "aa", None),
            out[5], out[5], (504, " ".join(near), "aa", "src0"), (505, "a shared line of text\n" + out[7][1], "aa", "s"), (506, "a shared line of text\n" + out[9][1] + " uxux", "zz", "s")]


def _plain(r, columns):
    return tuple(r[c] for c in columns if c not in ("text", "n_chars", "lang"))


def test_stages_keep_the_users_columns(spark, rows):
    docs = _docs(spark, rows)
    columns = docs.columns
    given = {_plain(r, columns) for r in docs.collect()}
    for name, work in corpus_pipeline.STAGES:
        got = work(spark, docs, SF)
        found = got.collect()
        assert {_plain(r, columns) for r in found} <= given, name
        assert found
        if name != "mix_sources":
            assert got.columns == columns and got.schema.simpleString() == docs.schema.simpleString()
        else:
            assert got.columns == [*columns, "mix_domain", "mix_n_tokens", "mix_epoch"]
            assert {r.mix_domain for r in found} <= {"d0", "d1", "d2"} and all(r.mix_n_tokens > 0 for r in found)


def test_stages_decide_as_they_say(spark, rows):
    docs = _docs(spark, rows)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert not kept & {500, 501, 502} and {0, 1, 503, None} <= kept
    lines = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert lines[505].text.startswith("a shared line") and not lines[506].text.startswith("a shared line")
    assert lines[506].n_chars == len(lines[506].text) and 503 not in lines and 504 not in lines     # exact copies lose every line
    near = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert 503 not in near and 504 not in near and near.count(5) == 1 and {500, 501, 0, 1} <= set(near)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF).collect()
    assert not {r.doc_id for r in mixed} & {500, 501}


def test_stages_pass_empty_tables(spark, rows):
    empty = _docs(spark, rows).where("false")
    for name, work in corpus_pipeline.STAGES:
        assert work(spark, empty, SF).count() == 0, name


def test_keep_first_leaves_columns_alone(spark):
    docs = _docs(spark, [(i, f"text number {i} of its own kind", "aa", "s") for i in range(20)])
    assert sorted(map(tuple, jaccard_join.keep_first(docs).collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("window", [13, 300, 400])
def test_wide_windows(spark, window):
    rng = random.Random(window)
    words = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    passage = words(1200)
    texts = [words(50) + passage + words(30), words(20) + passage[100:900], passage[:window - 1], words(700), passage[:window] + words(5)]
    want, first = [], {}
    for i, ws in enumerate(texts):
        for s in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[s:s + window]), i)
    for i, ws in enumerate(texts):
        gone = {s + j for s in range(len(ws) - window + 1) if first[tuple(ws[s:s + window])] < i for j in range(window)}
        want.append((i, len(ws), len(gone)))
    table = spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate(texts)], "doc_id long, text string").repartition(2)
    got = substring_dedup.dedup_substrings(table, window=window).collect()
    assert sorted((r.doc, r.n_words, r.n_removed) for r in got) == want and sum(w[2] for w in want) > window


def test_languages_of_repeated_rows_are_learned(spark):
    rng = random.Random(1)
    few = [" ".join(rng.choices(["abra", "cada", "bana", "kara"], k=20)) for _ in range(6)]
    many = [" ".join(rng.choices(["zuzu", "xoxo", "wuxo"], k=20)) for _ in range(900)]
    table = spark.createDataFrame([(i, t, "aa") for i, t in enumerate(few)], "doc_id long, text string, lang string")
    table = table.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n").union(
        spark.createDataFrame([(100 + i, t, "zz") for i, t in enumerate(many)], "doc_id long, text string, lang string"))
    model = language_id.fit(table)
    assert model["langs"] == ["aa", "zz"]
    assert [r.lang_pred for r in language_id.predict(spark.createDataFrame([(few[3],)], "text string"), model).collect()] == ["aa"]


def test_prediction_is_the_nearest_centroid(spark, rows):
    """Document frequencies and predictions of a small table against plain NumPy on whole texts."""
    docs = _docs(spark, rows)
    model = language_id.fit(docs)
    train = [t for _, t, lang, _ in rows if t and lang and any(map(str.isalpha, t))]
    seen = np.array([language_id.features(t)[0] > 0 for t in train])
    assert np.allclose(model["idf"], np.log((1 + len(train)) / (1 + seen.sum(0))) + 1, atol=1e-5)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language_id.predict(docs, model, names=("lang_pred", "score", "rejected")).collect()}
    for i, t, _, _ in rows:
        tf, letters = language_id.features(t)
        if not letters:
            assert got[i, t] == ("und", 0.0)
            continue
        v = tf * model["idf"]
        cos = model["centres"] @ (v / np.linalg.norm(v))
        assert got[i, t][0] == model["langs"][model["owner"][int(cos.argmax())]] and abs(got[i, t][1] - min(1, max(0, cos.max()))) < 1e-5
