"""Quality classifier: gradient-boosted trees over statistics of whole documents.

Defined results: a null or empty text has all statistics 0 and gets the model's score for these; repeated rows are
scored one by one; empty tables give empty tables; without labels every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from .boosting import Model, fit_model
from .common import LOWER, buffer_of, lean, ready, shingle_hashes, slices, table, word_hashes, words
from .labelled import SAMPLE_ROWS, sample

#: Classes of bytes that are counted.
_CLASSES = ["lower", "upper", "digit", "space", "newline", "stop", "loud", "odd", "other", "wide"]
_CLASS = np.full(256, 8, np.uint8)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
for _c in ".,;:":
    _CLASS[ord(_c)] = 5
for _c in "!?":
    _CLASS[ord(_c)] = 6
for _c in "#$%&*+<=>@^_`{|}~\\/":
    _CLASS[ord(_c)] = 7
_CLASS[128:] = 9

NAMES = [
    "log_bytes", "log_words", "word_mean", "word_spread", "longest", *[f"share_{c}" for c in _CLASSES],
    "distinct_words", "top_word", "repeated_shingles", "lines", "repeated_lines", "words_a_line", "ends_odd",
    "capital_words", "short_words", "entropy",
]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(NAMES)))
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    per = np.maximum(size, 1)[:, None]
    shares = np.bincount(doc * 10 + _CLASS[data], minlength=n * 10).reshape(n, 10) / per
    starts, ends, owner = words(data, offsets)
    length = (ends - starts).astype(float)
    many = np.bincount(owner, minlength=n)
    each = np.maximum(many, 1)
    mean = np.bincount(owner, length, n) / each
    spread = np.sqrt(np.maximum(np.bincount(owner, length**2, n) / each - mean**2, 0))
    hashes = word_hashes(data, starts, ends)
    first, last = data[starts], data[ends - 1]
    odd_end = np.bincount(owner, (_CLASS[last] == 7) | (_CLASS[last] == 6), n) / each
    capital = np.bincount(owner, (_CLASS[first] == 1) & (_CLASS[last] == 1) & (length > 1), n) / each
    short = np.bincount(owner, length <= 2, n) / each
    letters = np.bincount(doc * 32 + (LOWER[data] & 31), minlength=n * 32).reshape(n, 32) / per
    entropy = -(letters * np.log(np.maximum(letters, 1e-12))).sum(1)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    brk = data == 10
    inside = ~brk
    begin = inside.copy()
    if len(data):
        begin[1:] &= brk[:-1] | edge[1 : len(data)]
    line_starts = np.flatnonzero(begin)
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    lines = np.bincount(line_owner, minlength=n)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    line_cuts = np.searchsorted(line_owner, np.arange(n + 1))
    line_word = np.searchsorted(starts, line_starts)
    every = shingle_hashes(hashes, 3)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes, dtype=np.uint64)])
    for i in range(n):
        a, b = cuts[i], cuts[i + 1]
        if b > a:
            _, counts = np.unique(hashes[a:b], return_counts=True)
            out[i, 15], out[i, 16] = len(counts) / (b - a), counts.max() / (b - a)
            if b - a > 3:
                out[i, 17] = 1 - len(np.unique(every[a : b - 2])) / (b - a - 2)
        la, lb = line_cuts[i], line_cuts[i + 1]
        if lb > la + 1:
            w = np.r_[line_word[la:lb], b]
            out[i, 19] = 1 - len(np.unique(sums[w[1:]] - sums[w[:-1]])) / (lb - la)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = np.log1p(size), np.log1p(many), mean, spread
    out[:, 4] = 0
    np.maximum.at(out[:, 4], owner, length)
    out[:, 4] = np.log1p(out[:, 4])
    out[:, 5:15] = shares
    out[:, 18], out[:, 20] = lines / np.maximum(many, 1), many / np.maximum(lines, 1)
    out[:, 21], out[:, 22], out[:, 23], out[:, 24] = odd_end, capital, short, entropy
    return out


def features_of(df: DataFrame, text: str, extra: list[str], features) -> tuple[np.ndarray, list[np.ndarray]]:
    """Features and extra int columns of a bounded table, on the driver."""
    ready(df.sparkSession)

    def run(batches):
        for b in batches:
            data, offsets = buffer_of(b.column(0))
            for i, j in slices(offsets):
                x = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                cols = [pa.array(x.tobytes()[k : k + x.shape[1] * 8] for k in range(0, x.size * 8, x.shape[1] * 8))]
                yield pa.RecordBatch.from_arrays([cols[0].cast(pa.binary()), *[b.column(1 + c).slice(i, j - i) for c in range(len(extra))]], ["x", *extra])

    got = df.select(text, *extra).mapInArrow(lean(run), ", ".join(["x binary", *[f"`{c}` int" for c in extra]])).toArrow()
    wide = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    x = np.frombuffer(b"".join(got.column(0).to_pylist()), np.float64).reshape(-1, wide)
    return x, [got.column(1 + c).to_numpy() for c in range(len(extra))]


def scored(df: DataFrame, key: str, text: str, model, features) -> DataFrame:
    """(key, score) of every row, under a broadcast model."""
    ready(df.sparkSession)

    def run(batches):
        m = model.value
        for b in batches:
            data, offsets = buffer_of(b.column(1))
            parts = [
                m.score(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in slices(offsets)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts))], [key, "score"])

    return df.select(key, text).mapInArrow(lean(run), f"`{key}` {df.schema[key].dataType.simpleString()}, score double")


def fit_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Model:
    x, (y, part) = features_of(sample(spark, docs, labels, "quality", learn, rows=rows), "text", ["y", "part"], statistics)
    order = np.lexsort((*x.T[::-1], part, y))  # rows come in any order; the sum of floats in one
    return fit_model(x[order], y[order].astype(float), part[order])


def quality_scores(spark: SparkSession, docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    return scored(docs, key, text, spark.sparkContext.broadcast(model), statistics)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import fold

    docs = table(spark, sf_dir, "documents")
    model = fit_quality(spark, docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    out = quality_scores(spark, docs, model)
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
