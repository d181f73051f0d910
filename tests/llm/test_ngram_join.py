import random
import re

import numpy as np
import pytest

from plumbline.llm import ngram_join as J
from plumbline.llm.components import components


def brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, row string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_components(df, **options).collect()), key=str)
    assert got == brute(rows)


def corpus(seed, words=40, docs=25):
    """Families of near copies at all distances, over few words so that shingles are shared by chance as well."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    rows = []
    for base in range(docs):
        text = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 6, 20, 60, 150]))]
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(text)
            for _ in range(r.choice([0, 1, 2, len(copy) // 25, len(copy) // 12])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            if r.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * r.choice([0.74, 0.76, 0.8, 0.9])))]
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "words"), [(1, 40), (2, 6), (3, 1000)])
def test_against_brute_force(spark, seed, words):
    check(spark, corpus(seed, words))


def test_a_common_passage_and_a_large_group(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: f"u{r.randrange(10**6)}"
    passage, base = [word() for _ in range(60)], [word() for _ in range(80)]
    rows = [(i, " ".join(passage + [word() for _ in range(20)])) for i in range(40)]
    rows += [(100 + i, " ".join(base[:j] + [word()] + base[j + 1 :])) for i, j in enumerate(r.randrange(80) for _ in range(60))]
    rows += [(300 + i, " ".join(base)) for i in range(30)]
    check(spark, rows)
    monkeypatch.setattr(J, "TILE_ROWS", 7)
    monkeypatch.setattr(J, "PAIRS_AT_ONCE", 100)
    check(spark, rows)


def mutated(r, base, share):
    """base with that share of its words replaced, dropped or doubled."""
    out = []
    for w in base:
        u = r.random()
        out += [w] if u > share else [[f"n{r.randrange(10**7)}"], [], [w, w]][int(u / share * 2.999)]
    return out


def test_many_near_copies_in_one_group(spark):
    """5000 near copies of one text at all distances, most of them just too far from it and from each other, in one group."""
    r = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(mutated(r, base, r.choice([0.01, 0.02, 0.04, 0.06])))) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in J.near_components(df).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    numbers = {}
    member = np.zeros((len(sets), 1 << 15), np.float32)
    for i, s in enumerate(sets):
        member[i, [numbers.setdefault(g, len(numbers)) for g in s]] = 1
    both = member[:, : len(numbers)] @ member[:, : len(numbers)].T
    size = both.diagonal()
    linked = 100 * both >= 75 * (size[:, None] + size[None, :] - both)
    want = np.arange(len(sets))
    while True:
        least = np.where(linked, want[None, :], len(sets)).min(1)
        if (least == want).all():
            break
        want = least
    assert [got[i] for i in range(len(sets))] == want.tolist()
    assert 100 < len(set(want.tolist())) < 4900


def test_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, " \n"), (4, "a b"), (4, "a b"), (9, "A  b"), (None, "a b"), (5, "é É"), (6, "x " * 30_000), (7, "x " * 20_000), (None, "q w e r t y"), (None, None)]
    check(spark, rows)
    check(spark, [])


def test_the_threshold_is_exact(spark):
    # 9 and 12 shingles, 9 shared: 9/12 = 0.75; 8 of 11 is less
    w = [f"t{i}" for i in range(16)]
    check(spark, [(1, " ".join(w)), (2, " ".join(w[:13])), (3, " ".join(w[:12]) + " z")])


def test_one_of_each(spark):
    """Rows go one by one: repeated and null ids stand for their own texts."""
    rows = [(3, "a b c d e f", 1), (2, "a b c d e f", 2), (5, "k", 3), (None, "a b c d e f", 4), (7, None, 5), (7, "", 6), (2, "z y x w v", 7), (2, "z y x w v", 8), (None, "p q r s t", 9), (None, "p q r s t", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark_0 int")
    kept = J.one_of_each(df)
    assert kept.schema == df.schema
    assert sorted(r.mark_0 for r in kept.collect()) == [2, 3, 5, 6, 7, 9]
    assert J.one_of_each(df.filter("mark_0 = 3")).count() == 1
    assert J.one_of_each(df.filter("mark_0 = 0")).count() == 0


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {x.node: x.root for x in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_bounds_lose_no_link():
    """Rows that reach the threshold share as many prefix columns as the bounds say, under any order."""
    r = np.random.default_rng(1)
    for _ in range(400):
        n = int(r.integers(1, 120))
        x = set(r.choice(1000, n, replace=False).tolist())
        y = set(r.permutation(sorted(x))[: int(r.integers(max(1, n * 7 // 10), n + 1))].tolist()) | set((1000 + r.choice(50, int(r.integers(0, n // 4 + 1)), replace=False)).tolist())
        both = len(x & y)
        if 4 * both < 3 * len(x | y):
            continue
        order = r.permutation(1100)
        px, py = (sorted(s, key=lambda v: order[v])[: J.prefix_size(len(s))] for s in (x, y))
        bound = int(J.pair_bound(np.int64(len(x)), np.int64(len(y))))
        passing = [c for c in set(px) & set(py) if J._reaches(np.int64(len(x)), np.int64(px.index(c)), np.int64(len(y)), np.int64(py.index(c)))]
        assert len(passing) >= bound


def test_part_meetings(monkeypatch):
    """Rows and parts that meet, against a loop over all pairs of entries; few pairs at a time give what all at once give."""
    r = np.random.default_rng(3)
    rows = r.permutation(300).astype(np.int64) * 7919
    size = r.integers(30, 60, 300)
    own = np.repeat(np.arange(300), 12)
    column, place = r.integers(0, 40, len(own)).astype(np.uint32), r.integers(0, 9, len(own))
    key = np.unique(np.stack([own, column]), axis=1)
    own, column, place = key[0], key[1].astype(np.uint32), place[: key.shape[1]]
    root, part = rows[own] % 50, rows[own] % 11
    least = {}
    for i in range(len(own)):
        for j in np.flatnonzero(column == column[i]):
            if root[i] != root[j] and J._linkable(size[own[i]], size[own[j]]) and J._reaches(size[own[i]], place[i], size[own[j]], place[j]):
                least.setdefault((rows[own[i]], part[j]), set()).add(column[i])
    want = None
    for most in (1 << 19, 50, 1000):
        monkeypatch.setattr(J, "PAIRS_AT_ONCE", most)
        found = J.part_meetings(rows[own], size[own], column, place, root, part)
        got = {(a, b): n for a, b, _, n in zip(*[f.tolist() for f in found], strict=True)}
        want = want or got
        assert got == want and all(got[k] >= len(v) for k, v in least.items())


@pytest.mark.parametrize("two", [False, True])
def test_tiles(two):
    """A tile's forest connects what its links connect, with columns of few rows and of many."""
    r = np.random.default_rng(5)
    base = r.choice(1 << 40, 40, replace=False).astype(np.uint64)
    sets = [np.unique(np.r_[r.choice(base, r.integers(20, 40), replace=False), r.choice(1 << 40, r.integers(0, 9)).astype(np.uint64)]) for _ in range(120)]
    sets += [np.unique(r.choice(1 << 40, 12).astype(np.uint64)) for _ in range(20)]
    sets += [np.sort(s[:-1]) for s in sets[-20:]]
    n = len(sets)
    shared = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
    assert (J.overlaps(sets) == np.where(np.eye(n, dtype=bool), J.overlaps(sets), shared)).all()
    rows, roots, own = np.arange(n) * 3, np.arange(n) // 2, (np.arange(n) % 2 if two else np.zeros(n, np.int64))
    size = shared.diagonal()
    linked = (100 * shared >= 75 * (size[:, None] + size[None, :] - shared)) & (roots[:, None] != roots[None, :])
    if two:
        linked &= own[:, None] != own[None, :]

    def classes(pairs):
        at = {i: i for i in range(n)}
        for a, b in pairs:
            a, b = at[a], at[b]
            at = {k: min(a, b) if v in (a, b) else v for k, v in at.items()}
        return at

    a, b = J.tile_links(rows, roots, own, sets)
    assert len(a) < n and classes(zip((a // 3).tolist(), (b // 3).tolist(), strict=True)) == classes(np.argwhere(linked).tolist())
