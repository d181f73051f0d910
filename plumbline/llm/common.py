"""What the corpus operators share: shipping code, shared folders, bounded Arrow batches, vectorised text.

Text is handled as one byte buffer with offsets, as Arrow holds it, in slices of bounded size, so that numpy does the
work per byte and Python only the work per document. A null text is an empty text everywhere in this package.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch at most, so that a batch of long texts fits beside the JVM.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Bytes of text that the vectorised routines take at once (a longer single text is taken whole).
SLICE_BYTES = 1 << 19

_shipped: set[str] = set()
#: Paths of stored tables that nobody has deleted yet.
_stored: list[str] = []


def ready(spark: SparkSession) -> None:
    """Make the package importable on executors and bound Arrow batches. Call before building a Python stage."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        fd, name = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(name)
        atexit.register(Path(name).unlink, missing_ok=True)
        _shipped.add(sc.applicationId)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where all of Spark is one process, one of our
    own serves where that is unset; on a cluster that is an error, as no folder of one machine is shared."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/plumbline-{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: its lineage ends there and survives lost executors."""
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if not _stored:
        atexit.register(lambda: _deleted(spark, list(_stored)))
    _stored.append(path)
    return out


def _deleted(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _stored.remove(path)
        if spark.sparkContext._gateway is not None and spark.sparkContext._jvm is not None:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """What is stored inside goes at the end, but for the tables that are put into the list."""
    before, kept = set(_stored), []
    yield kept
    stay = before | {df.stored_at for df in kept}
    _deleted(spark, [p for p in _stored if p not in stay])


def tidied(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished stages now; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if df is not None and getattr(df, "stored_at", None) in _stored:
            _deleted(df.sparkSession, [df.stored_at])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker, which Spark keeps for other tasks, gives its free memory back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return whole


#: Rows of ids and numbers that are broadcast at most.
MOST_IDS = 1_000_000


def sized(few: DataFrame) -> DataFrame:
    """A table of narrow rows, marked to be broadcast if it was counted to be short enough."""
    return F.broadcast(few) if few.limit(MOST_IDS + 1).count() <= MOST_IDS else few


def without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of docs whose keys are not among gone's; rows with a null key stay. Short lists are broadcast, others shuffled."""
    return docs.join(sized(gone.select(*keys).dropna().distinct()), keys, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """n column names that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return [c for i in range(n + len(taken)) if (c := f"mark_{i}") not in taken][:n]


def fold(column: str, mod: int) -> F.Column:
    """crc32 of the id as text, modulo mod: the fixed folds of the held-out rows."""
    return F.crc32(F.col(column).cast("string")) % mod


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null has length 0."""
    texts = pa.array([]) if texts is None else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each (or a single row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The separators of words: space and the controls 09 to 0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values (xor-shift-multiply)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, B, B^2, ... modulo 2^64, n of them."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 64), _BASE, np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers[:n]


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of non-separators, in order; no run crosses documents."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run, A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    within = np.arange(total) - np.repeat(first, sizes)
    at = within + np.repeat(starts, sizes)
    part = (LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[within]
    return mixed(np.add.reduceat(part, first))


_STEPS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k successive word hashes (len - k + 1 of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j : j + n] * _STEPS[j]
    return mixed(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Each document's sorted distinct k-word shingles; with fewer words the whole sequence is one, without words none."""
    starts, ends, doc = words(data, offsets)
    h = word_hashes(data, starts, ends)
    every = shingle_hashes(h, k)
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    out = []
    for i in range(len(offsets) - 1):
        a, b = cuts[i], cuts[i + 1]
        if b - a >= k:
            s = np.sort(every[a : b - k + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(mixed((h[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
