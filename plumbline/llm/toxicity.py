"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features are densities of a fixed seed lexicon and of a lexicon learned from labelled rows (words, and stems of 4 to 6
bytes), how near second-person words stand to lexicon words, and rates of capitals, punctuation and obfuscated spellings.
A stem or word enters the learned lexicon when toxic documents hold it far more often than chance would have it. For
training, each half of the labelled rows is described with the lexicon of the other half, so no row votes for its own words.

Defined results: a null or empty text has all features 0 and gets the model's score for these; repeated rows are scored
one by one; empty tables give empty tables; without labels every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Model, fit_model
from .common import LOWER, buffer_of, lean, ready, slices, word_hashes, words
from .labelled import SAMPLE_ROWS, sample
from .quality import features_of, scored

#: Words that insult in four languages, and words that address the reader.
SEED = (
    "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown clowns fool ugly hate "
    "kill die shut garbage filth filthy vermin pig pigs crap damn hell bastard jerk freak creep liar coward "
    "dumm dummkopf idiotisch abschaum müll wertlos hässlich hasse arschloch trottel schwachkopf "
    "idiota estúpido estúpida imbécil basura asqueroso asquerosa odio payaso inútil patético tonto "
    "imbécile stupide ordure dégoûtant minable pathétique nul crétin débile haine"
).split()
YOU = "you your yours youre u ur yourself du dich dir dein deine ihr euch tú tu te ti vos usted ustedes vous toi ton ta votre".split()

#: Entries of a learned lexicon at most.
MOST_ENTRIES = 20_000
#: Words that a second-person word may stand away.
NEAR = 5

#: Not part of a word here: all bytes but letters, digits, bytes beyond ASCII and the signs that stand in for letters.
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"@$*"]] = False
_PLAIN = LOWER.copy()
for _a, _b in zip(b"013457@$", b"oieastas", strict=True):
    _PLAIN[_a] = _b
_SIGN = np.zeros(256, bool)
_SIGN[[*b"013457@$*"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

NAMES = [
    "seed", "seed_log", "learned", "learned_log", "learned_share", "learned_distinct", "strong", "obfuscated_hits", "near_you", "you",
    "upper", "loud", "marks", "signs_in_words", "stretched", "log_words", "word_mean", "shouted_words",
]


def _hash_words(texts: list[str]) -> np.ndarray:
    data, offsets = buffer_of(pa.array(texts))
    return np.sort(word_hashes(data, offsets[:-1], offsets[1:]))


def _in(sorted_: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(h), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, h), len(sorted_) - 1)] == h


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> list[np.ndarray]:
    """Hashes of each whole word and of its first 4, 5 and 6 bytes (0 where it is no longer than that), by `plain` spelling."""
    out = [word_hashes(data, starts, ends)]
    size = ends - starts
    packed = np.zeros(len(starts), np.uint64)
    for j in range(6):
        at = np.minimum(starts + j, max(len(data) - 1, 0))
        byte = np.where(size > j, plain[data[at]] if len(data) else 0, 0).astype(np.uint64)
        packed |= byte << np.uint64(8 * j)
        if j >= 3:
            tag = np.uint64(j + 1) << np.uint64(56)
            out.append(np.where(size > j + 1, packed | tag, np.uint64(0)))
    return out


@dataclass
class Lexicon:
    """Learned entries by hash, with their log odds; the strong ones are those that clean rows hardly ever hold."""

    keys: np.ndarray
    strong: np.ndarray

    def hits(self, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        some, strong = np.zeros(len(keys[0]), bool), np.zeros(len(keys[0]), bool)
        for h in keys:
            some |= _in(self.keys, h)
            strong |= _in(self.strong, h)
        return some, strong


def learned(keys: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> Lexicon:
    """Entries in toxic rows at least 4 times as often as in clean ones, 5 standard deviations above chance."""
    share = n_toxic / max(n_toxic + n_clean, 1)
    chance = (toxic + clean) * share
    z = (toxic - chance) / np.sqrt(np.maximum(chance * (1 - share), 1e-9))
    odds = (toxic / max(n_toxic, 1)) / ((clean + 0.5) / max(n_clean, 1))
    ok = (toxic >= 4) & (odds >= 4) & (z >= 5)
    at = np.flatnonzero(ok)
    at = at[np.lexsort((keys[at], -z[at]))][:MOST_ENTRIES]
    return Lexicon(np.sort(keys[at]), np.sort(keys[at[(odds[at] >= 12) & (z[at] >= 7)]]))


def key_counts(rows: DataFrame) -> DataFrame:
    """(key, t0, c0, t1, c1): toxic and clean rows of each half (part modulo 2) that hold the key; counted before the shuffle."""

    def run(batches):
        for b in batches:
            data, offsets = buffer_of(b.column(0))
            y, half = b.column(1).to_numpy(), b.column(2).to_numpy() % 2
            for i, j in slices(offsets):
                d = data[offsets[i] : offsets[j]]
                starts, ends, owner = words(d, offsets[i : j + 1] - offsets[i], _BREAK)
                found = []
                for h in _keys(d, starts, ends, LOWER):
                    at = np.lexsort((owner, h))
                    hs, os = h[at], owner[at]
                    keep = np.r_[True, (hs[1:] != hs[:-1]) | (os[1:] != os[:-1])][: len(hs)] & (hs != 0)
                    found.append((hs[keep], os[keep] + i))
                h, o = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                u, inv = np.unique(h, return_inverse=True)
                kind = 2 * half[o] + (1 - y[o])
                c = np.bincount(inv * 4 + kind, minlength=len(u) * 4).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), *[pa.array(c[:, k].astype(np.int32)) for k in range(4)]], ["key", "t0", "c0", "t1", "c1"])

    ready(rows.sparkSession)
    each = rows.select("text", "y", "part").mapInArrow(lean(run), "key long, t0 int, c0 int, t1 int, c1 int")
    out = each.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1")])
    return out.filter((F.col("t0") + F.col("t1") >= 4) & (F.col("t0") + F.col("t1") > F.col("c0") + F.col("c1")) | (F.greatest("t0", "t1") >= 4))


@dataclass
class Features:
    lexicon: Lexicon
    seed: np.ndarray
    you: np.ndarray

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        out = np.zeros((n, len(NAMES)))
        size = np.maximum(np.diff(offsets), 1)
        starts, ends, owner = words(data, offsets, _BREAK)
        many = np.bincount(owner, minlength=n)
        each = np.maximum(many, 1)
        count = lambda mask: np.bincount(owner, mask, n)
        keys = _keys(data, starts, ends, LOWER)
        some, strong = self.lexicon.hits(keys)
        seed = _in(self.seed, keys[0])
        you = _in(self.you, keys[0])
        signs = np.add.reduceat(np.r_[_SIGN[data].astype(np.int32), 0], starts) if len(starts) else np.zeros(0, np.int32)
        letters = np.add.reduceat(np.r_[_LETTER[data].astype(np.int32), 0], starts) if len(starts) else np.zeros(0, np.int32)
        odd = np.flatnonzero((signs > 0) & (letters > 1) & (signs <= 2 * letters))
        hidden = np.zeros(len(starts), bool)
        if len(odd):
            plain = _PLAIN[data]
            k = _keys(plain, starts[odd], ends[odd], LOWER)
            hidden[odd] = self.lexicon.hits(k)[1] | _in(self.seed, k[0])
        hit = some | seed | hidden
        near = np.zeros(len(starts), bool)
        at = np.flatnonzero(you)
        if len(at) and hit.any():
            for step in range(-NEAR, NEAR + 1):
                to = at + step
                ok = (to >= 0) & (to < len(starts))
                ok[ok] &= owner[to[ok]] == owner[at[ok]]
                near[to[ok]] = True
        total = count(some)
        at = np.flatnonzero(some)
        first = np.unique(np.stack([owner[at].astype(np.uint64), keys[0][at]]), axis=1)[0].astype(np.int64) if len(at) else at
        length = (ends - starts).astype(float)
        up = (data >= 65) & (data <= 90)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        by_byte = lambda mask: np.bincount(doc, mask, n) / size
        same = np.zeros(len(data), bool)
        if len(data) > 2:
            same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]] & (doc[2:] == doc[:-2])
        shouted = np.add.reduceat(np.r_[up.astype(np.int32), 0], starts) if len(starts) else np.zeros(0, np.int32)
        out[:, 0], out[:, 1] = count(seed) / each, np.log1p(count(seed))
        out[:, 2], out[:, 3] = total / each, np.log1p(total)
        out[:, 4] = total / np.sqrt(each)
        out[:, 5] = np.log1p(np.bincount(first, minlength=n))
        out[:, 6], out[:, 7] = np.log1p(count(strong)), np.log1p(count(hidden))
        out[:, 8], out[:, 9] = np.log1p(count(near & hit)), count(you) / each
        out[:, 10], out[:, 11] = by_byte(up), by_byte((data == 33) | (data == 63))
        out[:, 12] = by_byte(((data >= 33) & (data <= 47)) | ((data >= 58) & (data <= 64)))
        out[:, 13], out[:, 14] = count((signs > 0) & (letters > 1)) / each, by_byte(same)
        out[:, 15], out[:, 16] = np.log1p(many), np.bincount(owner, length, n) / each
        out[:, 17] = count((shouted == length) & (length > 2)) / each
        return out


@dataclass
class ToxicityModel:
    model: Model
    features: Features

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.model.score(x)


def fit_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    found = sample(spark, docs, labels, "toxic", learn, rows=rows)
    n = {(r.half, r.y): r.n for r in found.groupBy((F.col("part") % 2).alias("half"), "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = key_counts(found).toArrow()  # keys of a bounded sample that toxic rows hold more often
    key = counts.column(0).to_numpy().view(np.uint64)
    t0, c0, t1, c1 = (counts.column(i).to_numpy().astype(float) for i in range(1, 5))
    seed, you = _hash_words(SEED), _hash_words(YOU)
    # half 0 is described by what half 1 has taught, and the other way round
    by = {0: Features(learned(key, t1, c1, n.get((1, 1), 0), n.get((1, 0), 0)), seed, you), 1: Features(learned(key, t0, c0, n.get((0, 1), 0), n.get((0, 0), 0)), seed, you)}
    xs, ys, parts = [], [], []
    for half, features in by.items():
        x, (y, part) = features_of(found.filter(F.col("part") % 2 == half), "text", ["y", "part"], features)
        xs.append(x)
        ys.append(y)
        parts.append(part)
    x, y, part = np.concatenate(xs), np.concatenate(ys), np.concatenate(parts)
    order = np.lexsort((*x.T[::-1], part, y))  # rows come in any order; the sum of floats in one
    model = fit_model(x[order], y[order].astype(float), part[order] // 2)
    whole = learned(key, t0 + t1, c0 + c1, n.get((0, 1), 0) + n.get((1, 1), 0), n.get((0, 0), 0) + n.get((1, 0), 0))
    return ToxicityModel(model, Features(whole, seed, you))


def toxicity_scores(spark: SparkSession, docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    return scored(docs, key, text, spark.sparkContext.broadcast(model), model.features)


def kept(spark: SparkSession, docs: DataFrame, model: ToxicityModel, least: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of docs that score under `least`, with all their columns."""
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        m = shared.value
        for b in batches:
            if b.num_rows:
                data, offsets = buffer_of(b.column(at))
                parts = [m.score(m.features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in slices(offsets)]
                yield b.filter(pa.array(np.concatenate(parts) < least))

    return docs.mapInArrow(lean(run), docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold, table

    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(spark, docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    out = toxicity_scores(spark, docs, model)
    held = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
