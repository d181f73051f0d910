import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, k, every):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good.setdefault((i, tuple(v)), np.array(v, np.float32).astype(float))
    size = max({len(v) for v in good.values()}, key=lambda n: (sum(len(v) == n for v in good.values()), -n))
    good = {key: v for key, v in good.items() if len(v) == size}
    out = {}
    for (q, _), v in good.items():
        if q % every == 0:
            out.setdefault(q, []).append(sorted(((-float(v @ w), i) for (i, _), w in good.items() if i != q))[:k])
    return out


def test_small_tables_are_exact(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0], "x") for i in range(90)]
    rows += [(100 + i, [3.0, 3.0, 1.0], "x") for i in range(60)]
    rows += [(500, None, "x"), (501, [0.0, 0.0, 0.0], "x"), (502, [1.0, None, 1.0], "x"), (503, [1.0, float("nan"), 2.0], "x"), (504, [1.0, 2.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (20, [6.0, 0.0, 1.0], "x"), (5, [5.0, 0.0, 1.0], "x"), (5, [5.0, 0.0, 1.0], "x")]
    got = {}
    for r in A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank, r.vec_id] = r.score
    want = brute(rows, 20, 20)
    for q, lists in want.items():
        expected = {(n + 1, i): -s for one in lists for n, (s, i) in enumerate(one)}
        assert got[q].keys() == expected.keys()
        assert all(abs(got[q][k] - v) < 1e-12 for k, v in expected.items())
    assert got.keys() == want.keys()


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0], "x"), (20, [0.0, 1.0], "x"), (3, [1.0, 1.0], "x")]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0).collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.0)]
    assert A.nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0).count() == 0
    assert A.nearest(spark.createDataFrame(rows[2:], SCHEMA), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, monkeypatch, clustered):
    monkeypatch.setattr(A, "GROUP_ROWS", 300)
    monkeypatch.setattr(A, "SAMPLE", 1500)
    r = np.random.default_rng(3)
    x = r.normal(size=(4000, 24)).astype(np.float32)
    if clustered:
        x[:2500] = x[0] + 0.2 * x[:2500]
    rows = [(i, v, "x") for i, v in enumerate(x.tolist())]
    got = {}
    for n in A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0).collect():
        got.setdefault(n.query_id, set()).add(n.vec_id)
    hit = 0
    for q in range(0, 4000, 100):
        s = x[q].astype(float) @ x.T.astype(float)
        s[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit / (20 * 40) >= 0.9


def test_the_queue_pops_by_penalty():
    r = np.random.default_rng(5)
    x = r.normal(size=(600, 8))
    f = A.fit_forest(x, float(np.linalg.norm(x, axis=1).max()), leaf=20)
    own = A.trials(x, 10)
    assert (own[1] != own[0][:, None]).all()
    A.fit_neighbours(f, x, *own)
    leaf = f.leaf_of(x)
    assert leaf.shape == (A.TREES, 600) and np.bincount(leaf[0]).max() <= 40
    held = np.concatenate([np.bincount(t, minlength=f.leaves) for t in leaf])
    every = A.TREES * f.leaves
    for q, p, s in zip(x[:10], f.penalties(x[:10]), f.sides(x[:10]), strict=True):
        assert f.popped(s, 9) == np.argsort(p, kind="stable")[:9].tolist()
        out = f.popped(s, every)
        assert sorted(out) == list(range(every)) and (np.diff(p[out]) >= -1e-9).all()
        short = f.popped(s, 1, held, 60)  # goes on until a tree's leaves hold 60 rows
        rows = [sum(held[n] for n in short if n // f.leaves == t) for t in range(A.TREES)]
        assert max(rows) >= 60 > max(sum(held[n] for n in short[:-1] if n // f.leaves == t) for t in range(A.TREES))


def test_queries_are_never_left_short(spark, monkeypatch):
    """One popped leaf holds fewer rows than a query lists: it pops on. Queries come in several blocks."""
    monkeypatch.setattr(A, "budget_of", lambda *_: 1)
    monkeypatch.setattr(A, "GROUP_QUERIES", 7)
    monkeypatch.setattr(A, "GROUP_ROWS", 50)
    monkeypatch.setattr(A, "HELD_SCORES", 500)
    monkeypatch.setattr(A, "ONE_LEAF", 50)
    r = np.random.default_rng(6)
    x = r.normal(size=(900, 6)).astype(np.float32)
    x[400:700] = x[399]  # one vector of many rows
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(x.tolist())], SCHEMA)
    got = {}
    for n in A.nearest(df, F.col("id") % 10 == 0, k=20).collect():
        got.setdefault(n.query_id, []).append((n.rank, n.vec_id, n.score))
        assert abs(n.score - float(x[n.query_id].astype(float) @ x[n.vec_id].astype(float))) < 1e-9
    assert sorted(got) == list(range(0, 900, 10)) and all(sorted(k for k, _, _ in v) == list(range(1, 21)) for v in got.values())


def test_what_is_reranked(spark):
    """Vectors with structure: a query scores a small share of all rows and finds nine tenths of its neighbours."""
    r = np.random.default_rng(8)
    x = (r.normal(size=(40, 32))[r.integers(0, 40, 6000)] + 0.35 * r.normal(size=(6000, 32))).astype(np.float32)
    f = A.fit_forest(x.astype(float), float(np.linalg.norm(x, axis=1).max()))
    at, best = A.trials(x.astype(float), 20)
    A.fit_neighbours(f, x.astype(float), at, best)
    budget = A.budget_of(f, x.astype(float), at, best)
    leaf = f.leaf_of(x.astype(float)) + np.arange(A.TREES)[:, None] * f.leaves
    share, hit = [], []
    for i, near, s in zip(at, best, f.sides(x[at].astype(float)), strict=True):
        seen = np.isin(leaf, f.popped(s, budget)).any(0)
        share.append(seen.mean())
        hit.append(seen[near].mean())
    assert np.mean(hit) >= 0.9 and np.mean(share) <= 0.2, (np.mean(hit), np.mean(share))
