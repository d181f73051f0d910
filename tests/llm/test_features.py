"""Features and predictions of the classifiers against plain Python, text by text."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import langid as L
from plumbline.llm import quality as Q
from plumbline.llm import toxicity as T
from plumbline.llm.common import buffer_of

PARTS = ["the ", "The", "THE ", "a", " ", "\n", "\n\n", "é", "ß ", "idiot", "1d10t ", "st*pid", "you ", "U", "!!!", "?", "aaa", "a.", "#%", "x_y", "zorbles ", "zorb", "ZORBLED ", "blarg", "BL4RG ", "01", "日本", "\t", "k\r\n", "$@"]
texts = st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=6)


def lower(b: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def quality(t: str) -> list[float]:
    b = t.encode()
    w = re.findall(rb"[^\x20\x09-\x0D]+", b)
    low = [lower(x) for x in w]
    n, size = max(len(w), 1), max(len(b), 1)
    length = [len(x) for x in w]
    mean = sum(length) / n
    kinds = [rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[ \t]", rb"[\n\r]", rb"[.,;:]", rb"[!?]", rb"[#$%&*+<=>@^_`{|}~\\/]", None, rb"[\x80-\xff]"]
    share = [len(re.findall(k, b)) / size if k else 0.0 for k in kinds]
    share[8] = len(b) / size - sum(share)
    lines = re.findall(rb"[^\n]+", b)
    bags = {tuple(sorted(lower(x) for x in re.findall(rb"[^\x20\x09-\x0D]+", s))) for s in lines}
    count = Counter(low)
    triples = {tuple(low[i : i + 3]) for i in range(len(w) - 2)}
    cells = Counter(c & 31 for c in lower(b))
    is_in = lambda c, k: re.fullmatch(kinds[k], bytes([c])) is not None
    return [
        math.log1p(len(b)), math.log1p(len(w)), mean, math.sqrt(max(sum(x * x for x in length) / n - mean**2, 0)), math.log1p(max(length, default=0)), *share,
        len(count) / n, max(count.values(), default=0) / n, 1 - len(triples) / (len(w) - 2) if len(w) > 3 else 0.0,
        len(lines) / n, 1 - len(bags) / len(lines) if len(lines) > 1 else 0.0, len(w) / max(len(lines), 1),
        sum(is_in(x[-1], 7) or is_in(x[-1], 6) for x in w) / n, sum(is_in(x[0], 1) and is_in(x[-1], 1) and len(x) > 1 for x in w) / n, sum(len(x) <= 2 for x in w) / n,
        -sum(k / size * math.log(k / size) for k in cells.values()),
    ]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_statistics(rows):
    got = Q.statistics(*buffer_of(pa.array(rows, pa.string())))
    assert got.shape == (len(rows), len(Q.NAMES))
    for t, row in zip(rows, got, strict=True):
        assert np.allclose(row, quality(t), atol=1e-6), (t, [(n, a, b) for n, a, b in zip(Q.NAMES, row, quality(t), strict=True) if abs(a - b) > 1e-6])


LEARNED, STRONG, PREFIX = ["blarg", "aaa"], ["blarg"], [b"zorb"]


def toxic(t: str) -> list[float]:
    b = t.encode()
    w = re.findall(rb"[0-9A-Za-z\x80-\xff@$*]+", b)
    low = [lower(x) for x in w]
    known = lambda x, words: x in {v.encode() for v in words}
    some = [known(x, LEARNED) or (len(x) > 4 and x[:4] in PREFIX) for x in low]
    strong = [known(x, STRONG) for x in low]
    seed, you = [known(x, T.SEED) for x in low], [known(x, T.YOU) for x in low]
    signs = [sum(c in b"013457@$*" for c in x) for x in w]
    letters = [len(re.findall(rb"[A-Za-z\x80-\xff]", x)) for x in w]
    plain = [x.translate(bytes.maketrans(b"013457@$", b"oieastas")) for x in low]
    hidden = [s > 0 and k > 1 and s <= 2 * k and (known(p, STRONG) or known(p, T.SEED)) for s, k, p in zip(signs, letters, plain, strict=True)]
    hit = [x or y or z for x, y, z in zip(some, seed, hidden, strict=True)]
    near = [any(you[max(0, i - T.NEAR) : i + T.NEAR + 1]) for i in range(len(w))]
    n, size = max(len(w), 1), max(len(b), 1)
    same = sum(b[i] == b[i - 1] == b[i - 2] and re.match(rb"[A-Za-z\x80-\xff]", b[i : i + 1]) is not None for i in range(2, len(b)))
    total, log = sum(some), math.log1p
    return [
        sum(seed) / n, log(sum(seed)), total / n, log(total), total / math.sqrt(n), log(len({x for x, s in zip(low, some, strict=True) if s})), log(sum(strong)), log(sum(hidden)),
        log(sum(x and y for x, y in zip(near, hit, strict=True))), sum(you) / n, sum(65 <= c <= 90 for c in b) / size, sum(c in b"!?" for c in b) / size,
        sum(33 <= c <= 47 or 58 <= c <= 64 for c in b) / size, sum(s > 0 and k > 1 for s, k in zip(signs, letters, strict=True)) / n, same / size, log(len(w)), sum(map(len, w)) / n,
        sum(len(x) > 2 and all(65 <= c <= 90 for c in x) for x in w) / n,
    ]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_toxic_features(rows):
    prefix = np.array([int.from_bytes(p, "little") | len(p) << 56 for p in PREFIX], np.uint64)
    f = T.Features(T.Lexicon(np.sort(np.r_[T._hash_words(LEARNED), prefix]), T._hash_words(STRONG)), T._hash_words(T.SEED), T._hash_words(T.YOU))
    for t, row in zip(rows, f(*buffer_of(pa.array(rows, pa.string()))), strict=True):
        assert np.allclose(row, toxic(t), atol=1e-6), (t, [(n, a, b) for n, a, b in zip(T.NAMES, row, toxic(t), strict=True) if abs(a - b) > 1e-6])


def grams(t: str) -> Counter:
    b = t.encode()
    if not b:
        return Counter()
    c = [x if x >= 128 or chr(x).isalpha() else 32 for x in lower(b" " + b + b" ")]
    two = [(x * 257 + y) & 0xFFFFFFFF for x, y in zip(c, c[1:], strict=False)]
    three = [(x * 257 + y) & 0xFFFFFFFF for x, y in zip(two, c[2:], strict=False)]
    return Counter([((x * 2654435761 & 0xFFFFFFFF) >> 8) % L.DIMENSIONS for x in two] + [((x * 2246822519 & 0xFFFFFFFF) >> 7) % L.DIMENSIONS for x in three])


@settings(max_examples=80, deadline=None)
@given(texts)
def test_language_vectors_and_the_nearest_centroid(rows):
    c = L.counts(*buffer_of(pa.array(rows, pa.string())))
    for t, row in zip(rows, c, strict=True):
        assert {i: row[i] for i in np.flatnonzero(row)} == dict(grams(t))
    r = np.random.default_rng(1)
    idf = 1 + r.random(L.DIMENSIONS).astype(np.float32)
    centre = r.random((5, L.DIMENSIONS)).astype(np.float32)
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    model = L.Centroids(idf, ["aa", "bb"], np.array([0, 0, 1, 1, 1]), centre, np.array([0.01] * 5))
    lang, score, rejected = model.predict(c)
    for i, t in enumerate(rows):
        x = np.zeros(L.DIMENSIONS)
        for g, k in grams(t).items():
            x[g] = math.log1p(k) * idf[g]
        cosine = centre @ x / max(np.linalg.norm(x), 1e-12)
        if x.any() and np.diff(np.sort(cosine)[-2:])[0] > 1e-6:
            assert lang[i] == model.at[int(cosine.argmax())] and rejected[i] == (cosine.max() < 0.01)
            by = np.array([cosine[:2].max(), cosine[2:].max()])
            assert abs(score[i] - 1 / np.exp(24 * (by - by.max())).sum()) < 1e-4
