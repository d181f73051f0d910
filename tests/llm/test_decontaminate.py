import random
import re

import numpy as np
import pyarrow as pa

from plumbline.llm import decontaminate as D
from plumbline.llm.common import buffer_of


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())


def brute(docs, items):
    half = max((len(words(t)) for _, t in items if t), default=0) + D.SLACK
    out = {}
    for d, t in docs:
        w = words(t)
        for i, it in items:
            q = words(it)
            if not q:
                continue
            k = min(5, len(q))
            sh = {tuple(q[j : j + k]) for j in range(len(q) - k + 1)}
            answer = set(q[len(q) - max(1, len(q) // 3) :])
            for a in range(max(1, -(-len(w) // half) - 1)):
                part = w[a * half : (a + 2) * half]
                got = {tuple(part[j : j + k]) for j in range(len(part) - k + 1)} & sh
                if 4 * len(got) >= 3 * len(sh) and 4 * len(answer & set(part)) >= 3 * len(answer) and got:
                    out[d, i] = max(out.get((d, i), 0), len(got))
    return out


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    word = lambda: r.choice(vocabulary)
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 5, 9, 20, 30])))) for i in range(70)]
    docs = []
    for d in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 120)))]
        for _ in range(r.choice([0, 1, 2])):
            q = words(r.choice(items)[1])
            for _ in range(r.choice([0, 0, 1, 2])):
                q[r.randrange(len(q))] = word()
            q = q[: max(1, int(len(q) * r.choice([1, 1, 0.8, 0.5])))]
            parts += [" ".join(q), " ".join(word() for _ in range(r.randint(0, 90)))]
        docs.append((d, " ".join(parts)))
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string"), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        got = {(r.doc_id, r.item_id): r.shared for r in D.verified(spark, *frames(spark, docs, items)).collect()}
        assert got == brute(docs, items)


def test_several_index_parts(spark, monkeypatch):
    monkeypatch.setattr(D, "INDEX_WORDS", 300)
    docs, items = corpus(3)
    got = {(r.doc_id, r.item_id): r.shared for r in D.verified(spark, *frames(spark, docs, items)).collect()}
    assert got == brute(docs, items)


def test_thresholds_are_safe():
    """No passage with enough shingles scores under an item's threshold."""
    _, items = corpus(4)
    data, offsets = buffer_of(pa.array([t for _, t in items]))
    index = D.build_index(np.arange(len(items)), data, offsets, 40)
    r = random.Random(4)
    for i, (_, t) in enumerate(items):
        q = words(t)
        for _ in range(20):
            a = r.randrange(len(q))
            part = q[a:] if r.random() < 0.5 else q[: a + 1]
            k = min(5, len(q))
            sh = {tuple(q[j : j + k]) for j in range(len(q) - k + 1)}
            if 4 * len({tuple(part[j : j + k]) for j in range(len(part) - k + 1)} & sh) < 3 * len(sh):
                continue
            d, o = buffer_of(pa.array([" ".join(part)]))
            s, e, _ = D.words(d, o)
            at, term = index.term_numbers(D.word_hashes(d, s, e))
            assert i in D.retrieve(index, term, np.zeros(len(term), np.int64))[1]


def test_edges(spark):
    q = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, None), (2, ""), (3, q), (3, q), (None, q), (4, "x " * 30_000 + q), (5, q[:30]), (6, "SOLO"), (7, q.upper())]
    items = [(1, q), (1, q), (2, None), (3, ""), (4, "solo"), (None, q)]
    got = sorted(((r.doc_id, r.item_id) for r in D.verified(spark, *frames(spark, docs, items)).collect()), key=str)
    assert got == sorted([(3, 1), (None, 1), (4, 1), (6, 4), (7, 1)], key=str)
    a, b = frames(spark, docs, items)
    assert D.verified(spark, a.limit(0), b).count() == 0 and D.verified(spark, a, b.limit(0)).count() == 0
    kept = D.decontaminated(spark, a, b)
    assert kept.columns == a.columns and {r.doc_id for r in kept.collect()} == {1, 2, 5}


def test_rows_go_by_their_text(spark):
    """A row without an id goes if it holds an item; a clean one that shares the id of another stays."""
    q = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, q, 1), (1, "clean words here", 2), (None, f"so {q}", 3), (None, "clean", 4), (5, None, 5)], "doc_id long, text string, mark_0 int")
    kept = D.decontaminated(spark, docs, spark.createDataFrame([(1, q)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.mark_0 for r in kept.collect()) == [2, 4, 5]


def test_retrieval_against_all_scores(monkeypatch):
    """What the pivots and bounds leave out scores under its threshold, in blocks of few items and in several tiers."""
    monkeypatch.setattr(D, "BLOCK", 4)
    _, items = corpus(7)
    data, offsets = buffer_of(pa.array([t for _, t in items]))
    index = D.build_index(np.arange(len(items)), data, offsets, 40)
    assert len(index.tiers) > 2
    weight = np.zeros((len(index.terms), len(items)))
    for c, cell in enumerate(index.cells):
        for p in range(index.at[c], index.at[c + 1]):
            weight[cell // index.blocks, index.by[index.items[p]]] = index.weights[p]
    thresholds = np.empty(len(items))
    thresholds[index.by] = index.limits[: len(items)]
    r = np.random.default_rng(1)
    term, window = r.integers(0, len(index.terms), 2000), r.integers(0, 60, 2000)
    got = set(zip(*(x.tolist() for x in D.retrieve(index, term, window)), strict=True))
    for w in range(60):
        score = weight[np.unique(term[window == w])].sum(0)
        clear = np.abs(score / thresholds - 1) > 1e-9
        assert {i for v, i in got if v == w and clear[i]} == set(np.flatnonzero((score >= thresholds) & clear).tolist())


def test_the_index_grows_with_its_words():
    """Four times the items, with four times the words that differ: four times the bytes, or nearly so."""

    def size(n):
        r = np.random.default_rng(2)
        texts = pa.array([" ".join(f"w{x}" for x in r.integers(0, 20 * n, 50)) for _ in range(n)])
        index = D.build_index(np.arange(n), *buffer_of(texts), 60)
        arrays = [v for v in vars(index).values() if isinstance(v, np.ndarray) and v is not index.maybe]
        return sum(a.nbytes for a in [*arrays, *index.shingles, *index.answers])

    small, large = size(500), size(2000)
    assert large < 4.4 * small and large < 60 * 2000 * 50
