"""Language identification by the nearest of several centroids per language.

A text is a TF-IDF vector over hashed byte 2- and 3-grams of its letters (all else is one blank), of unit length.
Document frequencies count every learning document. Each language's centroids come from a bounded sample of its
documents by spherical k-means, one group per language, so no task and no driver holds more than one language's sample.
The sample is what has a hash of id and text under the language's bound, which comes from how many different documents
the language has (rows that repeat count once), so no task sees all rows of a language.
A text gets the language of the centroid with the largest cosine; where that cosine is under the centroid's own least
usual one, the prediction is marked as rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing was
learned; ties go to the language that sorts first; rows that repeat are predicted one by one; empty tables give empty
tables; other columns are ignored, whatever their names. More than LANGUAGES languages raise an error, as each takes
CENTROIDS * DIMENSIONS * 4 bytes of the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, buffer_of, lean, ready, slices

#: Dimensions of the hashed vectors, documents of a language that its centroids come from, about, and centroids a language.
DIMENSIONS, PER_LANGUAGE, CENTROIDS = 8192, 600, 4
#: Languages at most (64 MB of centroids).
LANGUAGES = 512
#: Share of a centroid's own sample that falls under its rejection bound.
REJECT_SHARE = 0.005
_SHARP = 24.0

_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed dimension of the 2-gram and of the 3-gram that begin at each byte."""
    c = _LETTERS[data].astype(np.uint32)
    two = c[:-1] * np.uint32(257) + c[1:]
    three = two[:-1] * np.uint32(257) + c[2:]
    two = (two * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(DIMENSIONS)
    three = (three * np.uint32(2246822519) >> np.uint32(7)) % np.uint32(DIMENSIONS)
    return two.astype(np.int64), three.astype(np.int64)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of gram counts for each text; a text counts with a blank before it."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMENSIONS), np.float32)
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        if b > a:
            two, three = grams(np.concatenate([[32], data[a:b], [32]]).astype(np.uint8))
            out[i] = np.bincount(two, minlength=DIMENSIONS) + np.bincount(three, minlength=DIMENSIONS)
    return out


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(c) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def frequencies(df: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(documents that hold each gram, documents), over all rows; summed per task first."""
    ready(df.sparkSession)

    def run(batches):
        held, n = np.zeros(DIMENSIONS, np.int64), 0
        for b in batches:
            data, offsets = buffer_of(b.column(0))
            for i, j in slices(offsets):
                for k in range(i, j):
                    part = data[offsets[k] : offsets[k + 1]]
                    if len(part):
                        seen = np.zeros(DIMENSIONS, bool)
                        two, three = grams(np.concatenate([[32], part, [32]]).astype(np.uint8))
                        seen[two] = True
                        seen[three] = True
                        held += seen
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.r_[n, held])], ["gram", "n"])

    got = df.select(text).mapInArrow(lean(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(DIMENSIONS, np.int64), 0
    for r in got:  # DIMENSIONS + 1 rows at most
        if r.gram < 0:
            n = r.n
        else:
            out[r.gram] = r.n
    return out, n


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit vectors by cosine; begun at the mean, then at the row farthest from all so far."""
    mean = x.mean(0)
    c = [mean / max(np.linalg.norm(mean), 1e-12)]
    near = x @ c[0]
    while len(c) < min(k, len(x)):
        c.append(x[int(near.argmin())])
        near = np.maximum(near, x @ c[-1])
    c = np.array(c)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


@dataclass
class Centroids:
    idf: np.ndarray
    langs: list[str]
    at: np.ndarray  # language of each centroid
    vectors: np.ndarray
    least: np.ndarray  # cosine under which a centroid rejects

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, rejected) of each row of counts."""
        cosine = vectors(c, self.idf) @ self.vectors.T
        best = cosine.argmax(1)
        by = np.full((len(c), len(self.langs)), -1.0)
        for j, lang in enumerate(self.at):
            by[:, lang] = np.maximum(by[:, lang], cosine[:, j])
        e = np.exp(_SHARP * (by - by.max(1, keepdims=True)))
        return self.at[best], e.max(1) / e.sum(1), cosine[np.arange(len(c)), best] < self.least[best]


def fit_centroids(spark: SparkSession, docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Centroids:
    """Fit on the rows that `learn` admits and that have a text and a language."""
    ready(spark)
    rows = docs.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    held, n = frequencies(rows, "text")
    idf = np.log((1 + n) / (1 + held)).astype(np.float32) + 1
    shared = spark.sparkContext.broadcast(idf)
    place = F.xxhash64(F.lit("sample"), "id", "text")
    many = rows.groupBy("lang").agg(F.approx_count_distinct(place, 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(many) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    share = F.element_at(F.create_map(*[x for r in many for x in (F.lit(r.lang), F.lit(min(1.0, PER_LANGUAGE / r.n)))]), F.col("lang")) if many else F.lit(0.0)
    # the upper 53 bits of the hash as a number from 0 to 1
    some = rows.withColumn("place", place).filter(F.shiftrightunsigned("place", 11) < share * float(1 << 53)).dropDuplicates(["id", "place"])

    def cluster(t: pa.Table) -> pa.Table:
        own = t.column("lang")[0].as_py()
        x = np.concatenate([vectors(counts(*buffer_of(pa.array([v]))), shared.value) for v in sorted(t.column("text").to_pylist())])
        c = k_means(x, CENTROIDS).astype(np.float32)
        cosine = x @ c.T
        mine = cosine.argmax(1)
        usual = [float(np.quantile(cosine[mine == j, j], REJECT_SHARE)) if (mine == j).any() else 2.0 for j in range(len(c))]
        return pa.table({"lang": [own] * len(c), "least": usual, "vector": [v.tobytes() for v in c]})

    got = some.select("lang", "text").groupBy("lang").applyInArrow(cluster, "lang string, least double, vector binary").collect()  # CENTROIDS rows a language
    got.sort(key=lambda r: (r.lang, r.vector))
    langs = sorted({r.lang for r in got})
    wide = np.array([np.frombuffer(r.vector, np.float32) for r in got], np.float32).reshape(len(got), DIMENSIONS)
    return Centroids(idf, langs, np.array([langs.index(r.lang) for r in got], np.int64), wide, np.array([r.least for r in got]))


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def predicted(spark: SparkSession, docs: DataFrame, model: Centroids, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) of every row."""
    ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array([*m.langs, "und"], object)
        for b in batches:
            data, offsets = buffer_of(b.column(1))
            for i, j in slices(offsets):
                for i2 in range(i, j, 256):
                    j2 = min(j, i2 + 256)
                    d, o = data[offsets[i2] : offsets[j2]], offsets[i2 : j2 + 1] - offsets[i2]
                    plain = np.r_[0, np.cumsum(_ASCII_LETTER[d])]
                    known = plain[o[1:]] > plain[o[:-1]]
                    for k in np.flatnonzero(~known):
                        known[k] = has_letter(d[o[k] : o[k + 1]].tobytes().decode("utf-8", "replace"))
                    if m.langs:
                        lang, score, rejected = m.predict(counts(d, o))
                        lang, score, rejected = np.where(known, lang, len(m.langs)), np.where(known, score, 0.0), rejected | ~known
                    else:
                        lang, score, rejected = np.zeros(j2 - i2, np.int64), np.zeros(j2 - i2), np.ones(j2 - i2, bool)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i2, j2 - i2), pa.array(names[lang].tolist(), pa.string()), pa.array(score.astype(float)), pa.array(rejected)],
                        [key, "lang_pred", "score", "rejected"],
                    )

    return docs.select(key, text).mapInArrow(lean(run), f"`{key}` {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold, table

    docs = table(spark, sf_dir, "documents")
    model = fit_centroids(spark, docs, fold("doc_id", 5) != 0)
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return predicted(spark, docs, model).select("doc_id", held, "lang_pred", "score", "rejected")
