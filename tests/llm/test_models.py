import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import boosting as B
from plumbline.llm import langid as L
from plumbline.llm import quality as Q
from plumbline.llm import toxicity as T
from plumbline.llm.common import buffer_of, fold
from plumbline.llm.queries_models import QUERIES

import pyarrow as pa  # noqa: I001


def walk(trees, row):
    out = trees.base
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        at = 0
        while at < len(f):
            at = 2 * at + 1 + (row[f[at]] > t[at])
        out += leaf[at - len(f)]
    return out


def test_flat_trees_against_a_walk():
    r = np.random.default_rng(1)
    x = r.random((400, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    t = B.fit_trees(x, y, trees=25, depth=3)
    assert np.allclose(t.raw(x), [walk(t, row) for row in x])
    assert ((t.raw(x) > 0) == y).mean() > 0.97
    again = B.fit_trees(x, y, trees=25, depth=3)
    assert (again.leaf == t.leaf).all()


def test_one_class_and_no_rows():
    assert len(B.fit_trees(np.zeros((0, 3)), np.zeros(0)).leaf) == 0
    m = B.fit_model(np.ones((5, 2)), np.ones(5), np.arange(5))
    assert (m.score(np.ones((2, 2))) > 0.5).all()
    assert len(m.score(np.zeros((0, 2)))) == 0


def test_isotonic_is_monotone():
    r = np.random.default_rng(2)
    raw = r.normal(size=500)
    y = (r.random(500) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    iso = B.fit_isotonic(raw, y)
    s = iso(np.linspace(-5, 5, 200))
    assert (np.diff(s) >= -1e-12).all() and s.min() >= 0 and s.max() <= 1
    assert abs(iso(raw).mean() - y.mean()) < 0.05


@pytest.mark.parametrize("features", [Q.statistics, T.Features(T.Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.uint64)), T._hash_words(T.SEED), T._hash_words(T.YOU))])
def test_features_of_a_text_don_t_depend_on_its_neighbours(features):
    texts = ["You idiot!", "", None, "a", "\n\n", "Été à %%% LOUD!!", "the the the\nthe the the\n", "1d1ot y0u st*pid", " " * 50, "word " * 5000]
    whole = features(*buffer_of(pa.array(texts)))
    assert np.isfinite(whole).all()
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], features(*buffer_of(pa.array([t])))[0]), t
    assert len(features(*buffer_of(pa.array([], pa.string())))) == 0
    assert (whole[1] == whole[2]).all()


def test_toxic_features():
    f = T.Features(T.Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.uint64)), T._hash_words(T.SEED), T._hash_words(T.YOU))
    rude, plain, hidden = f(*buffer_of(pa.array(["you are an idiot", "you are an oak", "you are an 1d10t"])))
    at = T.NAMES.index
    assert rude[at("seed")] > 0 and rude[at("near_you")] > 0 and plain[at("seed")] == plain[at("near_you")] == 0
    assert hidden[at("obfuscated_hits")] > 0 and plain[at("obfuscated_hits")] == 0


@pytest.fixture(scope="module")
def toy(spark):
    """Two kinds of documents that are easy to tell apart, in two invented languages."""
    rows, labels = [], []
    for i in range(240):
        lang = "aa" if i % 2 else "bb"
        base = ["mata", "kola", "rima", "sato"] if i % 2 else ["schruf", "glenk", "zwirt", "plumpf"]
        text = " ".join(base[(i * 7 + j * j) % 4] + base[(i + j) % 4] for j in range(12 + i % 9))
        toxic, low = i % 5 == 0, i % 7 == 0
        text += " vexu" + "abcd"[i % 4] + " idiot" if toxic else ""
        text = text.replace(" ", "### ").upper() if low else text
        rows.append((i, text, lang, "s", 0))
        labels.append((i, 0 if low else 1, 1 if toxic else 0))
    rows += [(1000, None, "aa", "s", 0), (1001, "", None, "s", 0), (1002, "123 !?", "bb", "s", 0), (None, "matakola rima", "aa", "s", 0), (7, rows[7][1], "aa", "s", 0), (1003, "é", "aa", "s", 0)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")
    return docs, spark.createDataFrame([*labels, (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity_and_quality_learn(spark, toy):
    docs, labels = toy
    for fit, score, column, mod in ((T.fit_toxicity, T.toxicity_scores, "toxic", 3), (Q.fit_quality, Q.quality_scores, "quality", 4)):
        model = fit(spark, docs, labels, fold("doc_id", mod) != 1)
        got = score(spark, docs, model).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        held = {r.doc_id: r[column] for r in labels.filter((fold("doc_id", mod) == 1) & F.col(column).isNotNull()).collect()}
        right = [(r.score >= 0.5) == bool(held[r.doc_id]) for r in got if r.doc_id in held]
        assert np.mean(right) > 0.9
        again = {(r.doc_id, r.score) for r in score(spark, docs.repartition(5), fit(spark, docs.repartition(3), labels, fold("doc_id", mod) != 1)).collect()}
        assert again == {(r.doc_id, r.score) for r in got}
        assert score(spark, docs.limit(0), model).count() == 0
        blank = score(spark, docs.limit(3), fit(spark, docs, labels.limit(0), F.lit(True))).collect()
        assert all(r.score == 0.5 for r in blank)


def test_toxic_rows_go(spark, toy):
    docs, labels = toy
    kept = T.kept(spark, docs, T.fit_toxicity(spark, docs, labels, F.lit(True)))
    assert kept.columns == docs.columns
    assert not {r.doc_id for r in kept.collect()} & {i for i in range(240) if i % 5 == 0}
    assert {1000, 1001, 1002, None} <= {r.doc_id for r in kept.collect()}


def test_languages(spark, toy):
    docs, _ = toy
    model = L.fit_centroids(spark, docs, fold("doc_id", 5) != 0)
    got = L.predicted(spark, docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == docs.count() and model.langs == ["aa", "bb"]
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1003].lang_pred in model.langs
    assert all(by[i].lang_pred == ("aa" if i % 2 else "bb") for i in range(240))
    assert all(0 <= r.score <= 1 for r in got)
    none = L.fit_centroids(spark, docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in L.predicted(spark, docs, none).collect()} == {"und"}
    assert L.predicted(spark, docs.limit(0), model).count() == 0


def test_queries_hold_out_and_cover_all_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, mod, at in (("op3_toxicity", 3, 1), ("op9_quality", 4, 2), ("op4_language_id", 5, 0)):
        r = QUERIES[name](spark, sf_dir)
        assert r.count() == docs.count()
        want = {x.doc_id for x in docs.filter(F.crc32(F.col("doc_id").cast("string")) % mod == at).collect()}
        assert {x.doc_id for x in r.filter("held_out").collect()} == want
