"""Exact n-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

The incidence matrix has a row for each distinct set of word shingles (copies share a row) and a column for each
shingle. Columns are dealt to blocks; each block multiplies its part of the matrix with its transpose, and size-derived
bounds discard pairs before and while overlap counts accumulate:

* sizes: 4 * smaller >= 3 * larger at a threshold of 3/4, and an overlap of ``ceil(3 (m + n) / 7)`` is needed;
* prefixes: under one global order of columns, linked rows of sizes m and n share at least ``min(m, n) // 16`` of their
  first ``n - ceil(3n/4) + n // 16`` columns, so only those entries enter the product, rows that meet others in fewer
  columns leave it, and pairs whose accumulated count is less are dropped;
* positions: what is left of the shorter row behind a shared column, and that count, bound the overlap;
* contraction: components are all that is asked for, so rows that links found so far connect are not compared. A first
  product pairs each row with one hub row, the most central one in its columns, and exact overlaps settle these pairs;
* tiles: rows that hubs connect, of about one size, form parts of bounded size. A second product adds up, over all
  blocks, in how many columns a row meets each part, and discards a row and part that share fewer than the row would with
  a row linked with it. What is left of two parts is multiplied out as one tile on whole sets, which decides exactly;
  from a tile comes no list of pairs but a forest that connects what its links connect, so that a group of near copies of
  any size makes tiles, not rows, by the square.

Columns that hold more than a 2^18th of all entries come last in the order, by size; they are found over all documents,
as those frequent in some block of entries (at most 2^19 of them, a broadcast of 5 MB). Sets are compared by 64-bit hashes
of their shingles.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; fewer words
than ``k`` make one shingle; rows that repeat an id or a text each get their row; a null id never names a component
unless all of a component's ids are null; empty tables give empty tables; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import buffer_of, forget, fresh_names, lean, mixed, ready, shingle_sets, sized, slices, stored, tidied, without
from .components import components

#: Frequent columns at most, and entries of one counting block.
FREQUENT, COUNT_BLOCK = 1 << 19, 1 << 21
#: Entries of a column block aimed at, and column blocks at least.
BLOCK_ENTRIES, LEAST_BLOCKS = 1 << 21, 64
#: Pairs of an entry and a part that a block's product holds at a time, about.
PAIRS_AT_ONCE = 1 << 20
#: Rows and entries of a tile aimed at.
TILE_ROWS, TILE_ENTRIES = 1 << 11, 1 << 19
#: Columns of more rows of a tile than that are multiplied out as dense matrices, of so many columns at a time.
LIGHT, DENSE_COLUMNS = 8, 1 << 11
#: Sizes of two bands' starts differ by a factor a little above 4/3; bands at most.
BAND, BANDS = float(np.log(1.34)), 128
#: Entries that a map task gathers before it deals them out.
FLUSH_ENTRIES = 1 << 21
#: Times that rows which meet others too rarely leave the product, as fewer rows mean fewer meetings.
PRUNINGS = 2
#: Partitions that the rows of one component are dealt to.
SALTS = 8


def row_number_of(shingles: np.ndarray) -> int:
    """The 64-bit number of a set: documents with equal sets are one row of the matrix."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.int64))


def _profiles(df: DataFrame, k: int) -> DataFrame:
    """Two kinds of rows: (ident, n, row) of a document, and (hash, count) of a column frequent in some block. df: (ident, text)."""
    ready(df.sparkSession)
    names, kind = ["ident", "n", "row", "hash", "count"], df.schema["ident"].dataType
    empty = to_arrow_type(kind)

    def frequent(parts: list[np.ndarray]) -> pa.RecordBatch | None:
        every = np.concatenate(parts)
        parts.clear()
        every.sort()
        least = max(4, len(every) // FREQUENT)
        # a value that occurs so often is equal to the one that stands least - 1 places on
        h = np.unique(every[: 1 - least][every[: 1 - least] == every[least - 1 :]])
        if not len(h):
            return None
        c = np.searchsorted(every, h, "right") - np.searchsorted(every, h)
        none = pa.nulls(len(h), pa.int64())
        return pa.RecordBatch.from_arrays([pa.nulls(len(h), empty), none, none, _signed(h), pa.array(c, pa.int64())], names)

    def run(batches):
        parts, held = [], 0
        for b in batches:
            data, offsets = buffer_of(b.column(1))
            for i, j in slices(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                n = pa.array([len(s) for s in sets], pa.int64())
                rows = pa.array([row_number_of(s) if len(s) else None for s in sets], pa.int64())
                none = pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).cast(empty), n, rows, none, none], names)
                parts += sets
                held += sum(map(len, sets))
                if held >= COUNT_BLOCK:
                    if (out := frequent(parts)) is not None:
                        yield out
                    parts, held = [], 0
        if held and (out := frequent(parts)) is not None:
            yield out

    long = T.LongType()
    return df.select("ident", "text").mapInArrow(lean(run), T.StructType([T.StructField(c, kind if c == "ident" else long) for c in names]))


class _Order:
    """The global order of columns: the infrequent by their hash, then the frequent by their counts' magnitude."""

    TABLE = 22

    def __init__(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        at = np.argsort(hashes)
        self.hashes, self.level = hashes[at], np.log2(np.maximum(counts[at], 1)).astype(np.uint8)
        self.maybe = np.zeros(1 << self.TABLE, bool)
        self.maybe[(self.hashes >> np.uint64(64 - self.TABLE)).astype(np.int64)] = True

    def ranked(self, s: np.ndarray) -> np.ndarray:
        """A sorted set in the global order."""
        some = np.flatnonzero(self.maybe[(s >> np.uint64(64 - self.TABLE)).astype(np.int64)])
        if not len(some):
            return s
        at = np.minimum(np.searchsorted(self.hashes, s[some]), len(self.hashes) - 1)
        level = np.zeros(len(s), np.uint8)
        level[some] = np.where(self.hashes[at] == s[some], self.level[at], 0)
        return s[np.argsort(level, kind="stable")]


def spare(n):
    """Columns that linked rows share in their prefixes at least, by the smaller row's size."""
    return np.maximum(1, n // 16)


def prefix_size(n: int) -> int:
    return min(n, n - (3 * n + 3) // 4 + int(spare(n)))


def pair_bound(n1, n2):
    """Columns that linked rows of these sizes share in their prefixes at least."""
    return np.minimum(np.minimum(spare(n1), spare(n2)), (3 * (n1 + n2) + 6) // 7)


_PACK = [("row", np.int64), ("size", np.uint32), ("times", np.uint32), ("column", np.uint32), ("place", np.uint16)]


def _packed(row: np.ndarray, size: np.ndarray, times: np.ndarray, column: np.ndarray, place: np.ndarray) -> bytes:
    parts = [a.astype(t).tobytes() for a, (_, t) in zip((row, size, times, column, place), _PACK, strict=True)]
    return np.array([len(row), len(column)], np.int64).tobytes() + b"".join(parts)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    n, m = np.frombuffer(blob, np.int64, 2)
    at, out = 16, []
    for (_, t), k in zip(_PACK, (n, n, n, m, m), strict=True):
        out.append(np.frombuffer(blob, t, int(k), at))
        at += int(k) * np.dtype(t).itemsize
    return out


def _entries(df: DataFrame, k: int, order, blocks: int) -> DataFrame:
    """(block, packed): the prefix entries of every distinct set, dealt to column blocks; a set once a task."""

    def run(batches):
        order_ = order.value
        seen: set[int] = set()
        rows: list[int] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def dealt():
            times = np.array([len(p) for p in parts], np.int64)
            h = np.concatenate(parts)
            doc = np.repeat(np.arange(len(parts)), times)
            place = np.minimum(np.arange(len(h)) - np.repeat(np.cumsum(times) - times, times), 65535)
            block = (h % np.uint64(blocks)).astype(np.int64)
            at = np.argsort(block, kind="stable")
            h, doc, place, block = h[at], doc[at], place[at], block[at]
            column = (h >> np.uint64(32)).astype(np.uint32)
            r, s = np.array(rows, np.int64), np.array(sizes, np.int64)
            cuts = np.searchsorted(block, np.arange(blocks + 1))
            ids, out = [], []
            for i in range(blocks):
                a, b = cuts[i], cuts[i + 1]
                if a < b:
                    d = doc[a:b]
                    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                    own = d[first]
                    ids.append(i)
                    out.append(_packed(r[own], s[own], np.diff(np.r_[first, len(d)]), column[a:b], place[a:b]))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(out, pa.binary())], ["block", "packed"])

        for b in batches:
            data, offsets = buffer_of(b.column(0))
            for i, j in slices(offsets):
                for s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k):
                    if not len(s) or (row := row_number_of(s)) in seen:
                        continue
                    seen.add(row)
                    rows.append(row)
                    sizes.append(len(s))
                    parts.append(order_.ranked(s)[: prefix_size(len(s))])
                    held += len(parts[-1])
                    if held >= FLUSH_ENTRIES:
                        yield dealt()
                        rows, sizes, parts, held = [], [], [], 0
        if parts:
            yield dealt()

    return df.select("text").mapInArrow(lean(run), "block int, packed binary")


def _largest_partner(size: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The largest row that a row can be linked with through its column at this place."""
    return np.minimum(4 * size // 3, (7 * (size - place - 1 + spare(size)) - 3 * size) // 3)


def _has_partner(size: np.ndarray, column: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether an entry's column holds another row of a size that its own size and place allow. Sorted by column, size."""
    cell = (column.astype(np.uint64) << np.uint64(32)) + size.astype(np.uint64)
    least = (3 * size + 3) // 4
    most = _largest_partner(size, place)
    base = column.astype(np.uint64) << np.uint64(32)
    lo = np.searchsorted(cell, base + least.astype(np.uint64))
    hi = np.searchsorted(cell, base + np.maximum(most, 0).astype(np.uint64), "right")
    return hi - lo - ((least <= size) & (size <= most)) > 0


def _met(entries: DataFrame) -> DataFrame:
    """(block, packed): each block's entries whose column holds two rows at least, by column and size."""

    def run(t: pa.Table) -> pa.Table:
        found = [_unpacked(x.as_py()) for x in t.column("packed")]
        row = np.concatenate([np.repeat(f[0], f[2]) for f in found])
        size = np.concatenate([np.repeat(f[1], f[2]) for f in found])
        column = np.concatenate([f[3] for f in found])
        place = np.concatenate([f[4] for f in found])
        del found
        at = np.lexsort((row, size, column))
        row, size, column, place = row[at], size[at], column[at], place[at]
        keep = np.r_[True, (row[1:] != row[:-1]) | (column[1:] != column[:-1])] if len(row) else np.zeros(0, bool)
        row, size, column, place = row[keep], size[keep].astype(np.int64), column[keep], place[keep].astype(np.int64)
        keep = _has_partner(size, column, place)
        row, size, column, place = row[keep], size[keep], column[keep], place[keep]
        blob = _packed(row, size, np.ones(len(row), np.int64), column, place)
        return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "packed": pa.array([blob], pa.binary())})

    return entries.groupBy("block").applyInArrow(run, "block int, packed binary")


def _members(met: DataFrame) -> DataFrame:
    """(block, row, n, hits): which rows a block's product can pair, and in how many columns."""

    def run(batches):
        for b in batches:
            for block, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                row, size, *_ = _unpacked(blob)
                rows, first, hits = np.unique(row, return_index=True, return_counts=True)
                for i in range(0, len(rows), 1 << 16):
                    part = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows[part]), block, np.int32)), pa.array(rows[part]), pa.array(size[first[part]].astype(np.int64)), pa.array(hits[part])],
                        ["block", "row", "n", "hits"],
                    )

    return met.mapInArrow(lean(run), "block int, row long, n long, hits long")


def _candidates(members: DataFrame) -> DataFrame:
    """(row, n) of the rows that meet others in as many columns as a link of theirs takes at least."""
    n = F.floor((F.col("n") * 3 + 3) / 4)
    bound = F.least(F.greatest(F.lit(1), F.floor(n / 16)), n)
    return members.groupBy("row").agg(F.max("n").alias("n"), F.sum("hits").alias("hits")).filter(F.col("hits") >= bound).select("row", "n")


def _linkable(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(n1, n2) >= 3 * np.maximum(n1, n2)


def _reaches(n1: np.ndarray, p1: np.ndarray, n2: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Whether a column shared at places p1, p2 can be among the first that a link takes."""
    return 7 * (np.minimum(n1 - p1, n2 - p2) - 1 + pair_bound(n1, n2)) >= 3 * (n1 + n2)


def _scrambled(rows: np.ndarray) -> np.ndarray:
    return mixed(rows.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))


def size_band(size: np.ndarray) -> np.ndarray:
    """Rows of sizes that may be linked are in one band or in neighbouring ones."""
    return np.floor(np.log(np.maximum(size, 1)) / BAND).astype(np.int64)


def size_band_of(n: F.Column) -> F.Column:
    return F.floor(F.log(F.greatest(n, F.lit(1))) / BAND)


def _counted(a: np.ndarray, b: np.ndarray, bound: np.ndarray, able: np.ndarray | None = None) -> list[np.ndarray]:
    """(a, b, the least of their bounds, how often they occur and are able)."""
    if not len(a):
        return [np.zeros(0, np.int64)] * (4 if able is None else 5)
    at = np.lexsort((b, a))
    a, b, bound = a[at], b[at], bound[at]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    found = [a[first], b[first], np.minimum.reduceat(bound, first), np.diff(np.r_[first, len(a)])]
    return found if able is None else [*found, np.add.reduceat(able[at].astype(np.int64), first)]


def hub_pairs(row, size, column, place) -> list[np.ndarray]:
    """(row, hub, bound, shared, able): of each column its hub with each other row, and in how many they may be linked.

    The hub is the row with the fewest rarer columns, that is the one most like the others. Entries are by column.
    """
    new = np.r_[True, column[1:] != column[:-1]]
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    hub = np.lexsort((_scrambled(row), place, group))[first][group]
    ok = row != row[hub]
    able = _linkable(size, size[hub]) & _reaches(size, place, size[hub], place[hub])
    return _counted(row[ok], row[hub[ok]], pair_bound(size[ok], size[hub[ok]]), able[ok])


def part_meetings(row, size, column, place, root, part) -> list[np.ndarray]:
    """(row, part, bound, shared): how many of a row's columns a part holds rows in that the row may be linked with.

    A part counts in a column if its rows there have sizes that the row's size and place allow and are not all in the
    row's own component. A row shares at least as many columns with a part as with each row of it.
    """
    band = size_band(size)
    at = np.lexsort((part, band, column))
    row, size, column, place, root, part, band = (x[at] for x in (row, size, column, place, root, part, band))
    most = _largest_partner(size, place)
    cell = column.astype(np.int64) * BANDS + band  # 32 bits of a column, so no overflow
    first = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])])
    if not len(first):
        return [np.zeros(0, np.int64)] * 4
    g_cell, g_part = cell[first], part[first]
    g_least, g_large, g_most = np.minimum.reduceat(size, first), np.maximum.reduceat(size, first), np.maximum.reduceat(most, first)
    g_root, g_other = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
    # rows of sizes that may be linked are in the same size band or in a neighbouring one
    lo, hi = np.searchsorted(g_cell, cell - 1), np.searchsorted(g_cell, cell + 1, "right")
    lo = np.maximum(lo, np.searchsorted(g_cell, column.astype(np.int64) * BANDS))
    hi = np.minimum(hi, np.searchsorted(g_cell, column.astype(np.int64) * BANDS + BANDS - 1, "right"))
    many = hi - lo
    turns = int(many.sum()) // PAIRS_AT_ONCE + 1
    turn = mixed(row.view(np.uint64).copy()) % np.uint64(turns)
    found = [[np.zeros(0, np.int64)] * 4]
    for k in range(turns):  # all columns of a row are in one turn
        e = np.flatnonzero(turn == np.uint64(k))
        i = np.repeat(e, many[e])
        g = np.arange(len(i)) - np.repeat(np.cumsum(many[e]) - many[e], many[e]) + lo[i]
        ok = (g_least[g] <= most[i]) & (4 * g_large[g] >= 3 * size[i]) & (size[i] <= g_most[g])
        ok &= (g_root[g] != root[i]) | (g_other[g] != root[i])
        i, g = i[ok], g[ok]
        least = (3 * size[i] + 3) // 4
        found.append(_counted(row[i], g_part[g], pair_bound(size[i], least)))
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def _hubs(met: DataFrame) -> DataFrame:
    """(a, b, able): each row with the hub it shares most columns with, and whether it shares as many as a link takes."""

    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                row, size, _, column, place = _unpacked(blob)
                if not len(row):
                    continue
                found = hub_pairs(row, size.astype(np.int64), column, place.astype(np.int64))
                for i in range(0, len(found[0]), 1 << 16):
                    yield pa.RecordBatch.from_arrays([_signed(f[i : i + (1 << 16)]) for f in found], ["a", "b", "bound", "shared", "able"])

    pairs = met.select("packed").mapInArrow(lean(run), "a long, b long, bound long, shared long, able long")
    pairs = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.sum("able").alias("able"), F.min("bound").alias("bound"))
    best = pairs.groupBy("a").agg(F.max(F.struct("shared", "b", (F.col("able") >= F.col("bound")).alias("able"))).alias("best"))
    return best.select("a", "best.b", "best.able")


def _meetings(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, root, own, other): the rows that share as many columns with a part as with a row linked with them.

    labels: (block, row, root, part). Counts are added up over all blocks.
    """

    def run(_key, entries: pa.Table, said: pa.Table) -> pa.Table:
        found, own, part, root = [np.zeros(0, np.int64)] * 4, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        if entries.num_rows and said.num_rows:
            row, size, _, column, place = _unpacked(entries.column("packed")[0].as_py())
            own, root, part = (said.column(c).to_numpy() for c in ("row", "root", "part"))
            at = np.argsort(own)
            own, root, part = own[at], root[at], part[at]
            at = np.minimum(np.searchsorted(own, row), len(own) - 1)
            ok = own[at] == row
            found = part_meetings(row[ok], size[ok].astype(np.int64), column[ok], place[ok].astype(np.int64), root[at[ok]], part[at[ok]])
        at = np.searchsorted(own, found[0])
        return pa.table([pa.array(x, pa.int64()) for x in (found[0], root[at], part[at], *found[1:])], names=["row", "root", "own", "other", "bound", "shared"])

    long = "row long, root long, own long, other long, bound long, shared long"
    every = met.groupBy("block").cogroup(labels.groupBy("block")).applyInArrow(run, long)
    sums = every.groupBy("row", "root", "own", "other").agg(F.sum("shared").alias("shared"), F.min("bound").alias("bound"))
    return sums.filter("shared >= bound").select("row", "root", "own", "other")


def _parts(rows: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """(row, root, part): rows of one family and size band are a part, or several where they are too many for one.

    A row's family is named by the lesser of its hub and its hub's own hub. rows: (row, n). A part holds about TILE_ROWS
    rows and TILE_ENTRIES entries at most.
    """
    band = size_band_of(F.col("n"))
    all_ = rows.join(hubs.select(F.col("a").alias("row"), F.col("b").alias("hub")), "row", "left")
    all_ = all_.join(hubs.select(F.col("a").alias("hub"), F.col("b").alias("next")), "hub", "left").withColumn("family", F.least("hub", "next"))
    all_ = all_.join(roots.select(F.col("node").alias("row"), "root"), "row", "left")
    all_ = all_.select("row", "n", F.coalesce("root", "row").alias("root"), F.coalesce("hub", "row").alias("hub"), F.coalesce("family", "row").alias("family"), band.alias("band"))
    all_ = stored(rows.sparkSession, all_, "labelled-rows")

    def large(by: str) -> DataFrame:
        """What is too large for one tile, with the tiles it takes: few rows, as each holds a tile's worth."""
        tiles = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum("n") / TILE_ENTRIES)).cast("long")
        return sized(all_.groupBy(by, "band").agg(tiles.alias(f"{by}_tiles")).filter(f"{by}_tiles > 1"))

    of = all_.join(large("family"), ["family", "band"], "left").join(large("hub"), ["hub", "band"], "left")
    # rows of a hub go together unless they are too many for one tile
    salt = F.when(F.col("hub_tiles") > 1, F.xxhash64(F.lit("row"), "row")).otherwise(F.xxhash64(F.lit("hub"), "hub"))
    part = F.xxhash64("family", "band", F.pmod(salt, F.coalesce("family_tiles", F.lit(1))))
    out = stored(rows.sparkSession, of.select("row", "root", part.alias("part")), "parts")
    forget(all_)
    return out


def spanned(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, first node of its component) of a symmetric matrix of links, for all nodes but the first ones."""
    n = len(linked)
    left, out = linked.any(1), np.full(n, -1)
    for i in range(n):
        if left[i]:
            left[i] = False
            now = np.array([i])
            while len(now):
                out[now] = i
                now = np.flatnonzero(linked[now].any(0) & left)
                left[now] = False
    node = np.flatnonzero((out >= 0) & (out != np.arange(n)))
    return node, out[node]


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The product of these rows with their transpose: how many columns each two of them share.

    Columns of few rows are multiplied out as lists, the others as dense tiles.
    """
    n = len(sets)
    out = np.zeros((n, n), np.float32)  # counts below 2^24 are exact
    if not n:
        return out
    column, row = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    at = np.argsort(column, kind="stable")
    column, row = column[at], row[at]
    first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    many = np.diff(np.r_[first, len(column)])
    several = np.repeat((many > 1) & (many <= LIGHT), many)
    r, group = row[several], np.repeat(np.arange(len(many)), many)[several]
    for step in range(1, LIGHT):
        same = np.flatnonzero(group[step:] == group[:-step])
        flat = np.bincount(r[same] * n + r[same + step], minlength=n * n) if len(same) else 0
        if not len(same):
            break
        out += flat.reshape(n, n).astype(np.float32)
    out += out.T
    heavy = np.flatnonzero(many > LIGHT)
    for i in range(0, len(heavy), DENSE_COLUMNS):
        some = heavy[i : i + DENSE_COLUMNS]
        at = np.repeat(first[some], many[some]) + np.arange(many[some].sum()) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
        dense = np.zeros((n, len(some)), np.float32)
        dense[row[at], np.repeat(np.arange(len(some)), many[some])] = 1
        out += dense @ dense.T
    return out


def tile_links(rows: np.ndarray, roots: np.ndarray, own: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of rows that connect all rows of a tile which links between different components and parts connect.

    own: each row's part; with one part, its rows are compared with each other, with two, those of one with the other's.
    Rows that share too few columns with others leave first.
    """
    size = np.array([len(s) for s in sets], np.int64)
    side = own != own.min()
    two = bool(side.any())
    for _ in range(PRUNINGS):
        if not len(sets):
            break
        column, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.argsort(column, kind="stable")
        first = np.flatnonzero(np.r_[True, column[at][1:] != column[at][:-1]])
        group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(at)]))
        shared = np.zeros(len(column), bool)
        if two:
            there = np.add.reduceat(side[row[at]].astype(np.int64), first)
            every = np.diff(np.r_[first, len(at)])
            shared[at] = ((there > 0) & (there < every))[group]
        else:
            low, high = np.minimum.reduceat(roots[row[at]], first), np.maximum.reduceat(roots[row[at]], first)
            shared[at] = (low != high)[group]
        keep = 4 * np.bincount(row, weights=shared, minlength=len(sets)).astype(np.int64) >= 3 * size
        cuts = np.cumsum([0, *map(len, sets)])
        sets = [sets[i][shared[cuts[i] : cuts[i + 1]]] for i in np.flatnonzero(keep)]
        rows, roots, size, side = rows[keep], roots[keep], size[keep], side[keep]
    both = overlaps(sets).astype(np.int64)
    linked = (100 * both >= 75 * (size[:, None] + size[None, :] - both)) & (roots[:, None] != roots[None, :])
    if two:
        linked &= side[:, None] != side[None, :]
    node, to = spanned(linked)
    return rows[node], rows[to]


def _tile_links(meetings: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): pairs that connect what links between the rows of two parts connect, or within one."""

    def run(t: pa.Table) -> pa.Table:
        rows, roots, own = (t.column(c).to_numpy() for c in ("row", "root", "own"))
        cells = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("cells")]
        a, b = tile_links(rows, roots, own, cells)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    two = meetings.select("row", "root", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    # both parts need rows that may be linked with the other's
    able = two.groupBy("p", "q").agg(F.min("own").alias("x"), F.max("own").alias("y")).filter("x != y or p = q").select("p", "q")
    whole = two.join(able, ["p", "q"], "left_semi").join(sets.select("row", "cells"), "row")
    return whole.groupBy("p", "q").applyInArrow(run, "a long, b long")


def _pruned(met: DataFrame, members: DataFrame) -> DataFrame:
    """The entries of these members that still have a partner among them."""

    def run(key, entries: pa.Table, said: pa.Table) -> pa.Table:
        row, size, _, column, place = _unpacked(entries.column("packed")[0].as_py()) if entries.num_rows else [np.zeros(0, np.int64)] * 5
        keep = np.isin(row, said.column("row").to_numpy())
        row, size, column, place = row[keep], size[keep].astype(np.int64), column[keep], place[keep].astype(np.int64)
        keep = _has_partner(size, column, place)
        row, size, column, place = row[keep], size[keep], column[keep], place[keep]
        blob = _packed(row, size, np.ones(len(row), np.int64), column, place)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "packed": pa.array([blob], pa.binary())})

    return met.groupBy("block").cogroup(members.groupBy("block")).applyInArrow(run, "block int, packed binary")


def _needed(rows: DataFrame) -> np.ndarray:
    """A bit filter of the candidate rows, of eight bits a row and between 2^20 and 2^27 bits (16 MB)."""
    bits = min(1 << 27, max(1 << 20, 1 << (8 * rows.count()).bit_length()))
    h = F.xxhash64("row")
    at = rows.select(F.explode(F.array(h, F.shiftright(h, 24))).alias("h")).select(F.pmod("h", F.lit(bits)).alias("h"))
    words = at.groupBy(F.expr("cast(h div 32 as int)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h % 32 as int)))").alias("b"))
    out = np.zeros(bits // 32, np.uint32)
    found = words.toArrow()  # a row for each word of the filter at most
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


def _sets(df: DataFrame, k: int, needed) -> DataFrame:
    """(row, cells): the 64-bit columns of each row that the filter lets through, a row once a task."""

    def run(batches):
        filter_ = needed.value
        seen: set[int] = set()
        for b in batches:
            data, offsets = buffer_of(b.column(0))
            for i, j in slices(offsets):
                rows, cells = [], []
                sets = [s for s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k) if len(s)]
                if not sets:
                    continue
                numbers = np.array([row_number_of(s) for s in sets], np.int64)
                for s, row, ok in zip(sets, numbers.tolist(), _passes(filter_, numbers), strict=True):
                    if ok and row not in seen:
                        seen.add(row)
                        rows.append(row)
                        cells.append(s.tobytes())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cells, pa.binary())], ["row", "cells"])

    return df.select("text").mapInArrow(lean(run), "row long, cells binary")


def _passes(filter_: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which rows the filter lets through: the two positions that _needed has set, by Spark's xxhash64."""
    h = np.array([xxhash.xxh64_intdigest(x, 42) for x in rows.astype("<i8").view("V8").tolist()], np.uint64).view(np.int64)
    ok = np.ones(len(rows), bool)
    for p in (h, h >> np.int64(24)):
        p = p % (32 * len(filter_))
        ok &= (filter_[p // 32] >> (p % 32).astype(np.uint32) & np.uint32(1)).astype(bool)
    return ok


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact overlap reaches the threshold."""

    def run(batches):
        for b in batches:
            a_, b_ = b.column(0).to_pylist(), b.column(1).to_pylist()
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = overlap(x, y)
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            out = pa.RecordBatch.from_arrays([pa.array(a_, pa.int64()).filter(mask), pa.array(b_, pa.int64()).filter(mask)], ["a", "b"])
            if out.num_rows:
                yield out

    right = pairs.join(sets.select(F.col("row").alias("b"), F.col("cells").alias("cells_b")), "b")
    whole = right.join(sets.select(F.col("row").alias("a"), F.col("cells").alias("cells_a")), "a")
    return whole.select("a", "b", "cells_a", "cells_b").mapInArrow(lean(run), "a long, b long")


def _components_of(df: DataFrame, ident: F.Column, text: str, k: int) -> DataFrame:
    """(ident, n, row, least, copies) of every row of df: the size and number of its set, and, where it has one, the least
    ident of its component, nulls last, and how many rows that component has."""
    spark = df.sparkSession
    df = df.select(ident.alias("ident"), F.col(text).alias("text"))
    seen = stored(spark, _profiles(df, k), "profiles")
    docs = seen.filter("hash is null").select("ident", "n", "row")
    total, entries = seen.agg(F.sum("n"), F.sum(F.floor(F.col("n") / 4) + F.floor(F.col("n") / 16) + 1)).first()
    frequent = seen.filter("hash is not null").groupBy("hash").agg(F.sum("count").alias("c")).filter(F.col("c") >= max(4, (total or 0) // FREQUENT))
    frequent = frequent.toArrow()  # FREQUENT rows at most, as their counts add up to no more than total
    sc = spark.sparkContext
    order = sc.broadcast(_Order(frequent.column(0).to_numpy().astype(np.int64).view(np.uint64), frequent.column(1).to_numpy()))
    blocks = max(LEAST_BLOCKS, -(-int(entries or 0) // BLOCK_ENTRIES))

    met = stored(spark, _met(_entries(df, k, order, blocks)), "met")
    tidied(spark)
    for _ in range(PRUNINGS):
        members = stored(spark, _members(met), "members")
        last, met = met, stored(spark, _pruned(met, members.join(_candidates(members).select("row"), "row").select("block", "row")), "met")
        forget(last, members)
    members = stored(spark, _members(met), "members")
    some = stored(spark, _candidates(members), "candidates")
    sets = stored(spark, _sets(df, k, sc.broadcast(_needed(some))).dropDuplicates(["row"]), "sets")
    tidied(spark)

    hubs = stored(spark, _hubs(met), "hubs")
    links = stored(spark, _links(hubs.filter("able").select("a", "b"), sets), "links")
    roots = components(spark, links)
    parts = _parts(some, hubs, roots)
    forget(hubs, roots)
    tidied(spark)
    meetings = stored(spark, _meetings(met, members.join(parts, "row").select("block", "row", "root", "part")), "meetings")
    forget(met, members, some, parts)
    every = stored(spark, links.union(_tile_links(meetings, sets)), "links")
    forget(links, meetings, sets)
    tidied(spark)
    roots = components(spark, every)
    forget(every)

    small = docs.filter("row is not null").groupBy("row").agg(F.min("ident").alias("least"), F.count(F.lit(1)).alias("copies"))
    whole = small.join(roots, F.col("row") == F.col("node"), "left").withColumn("root", F.coalesce("root", "row"))
    least = whole.groupBy("root").agg(F.min("least").alias("least"), F.sum("copies").alias("copies")).filter("copies > 1")
    # a component may hold very many rows: its one value is copied to SALTS partitions
    salted = whole.select("row", "root", F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    least = salted.join(least, ["root", "salt"]).select(F.col("row").alias("grouped"), "least", "copies")
    out = docs.join(least, docs.row == F.col("grouped"), "left")
    return out.select("ident", "n", "row", "least", "copies")


def near_components(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(key, n_shingles, component_id) of every row; the id of a component is the least key in it."""
    ident = F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("key"))  # nulls last
    out = _components_of(df, ident, text, k)
    return out.select(F.col("ident.key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least.key", "ident.key").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """docs with one row of each component: one with its least key, and of rows that repeat that key the one whose text has
    the least hash. Of rows alike in key and text the one that is least as JSON stays. Rows without words all stay."""
    spark = docs.sparkSession
    x, y = fresh_names(docs, 2)
    marked = docs.withColumn(x, F.xxhash64(key, text)).withColumn(y, F.xxhash64(text, key, F.lit(1)))
    ident = F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("key"), F.col(x).alias("x"), F.col(y).alias("y"))
    found = stored(spark, _components_of(marked, ident, text, k).filter("copies > 1").select("ident", "least"), "components")
    gone = stored(spark, found.filter(~F.col("ident").eqNullSafe(F.col("least"))).select(F.col("ident.x").alias(x), F.col("ident.y").alias(y)), "gone")
    again = found.groupBy("ident.x", "ident.y").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = stored(spark, again.select(F.col("x").alias(x), F.col("y").alias(y)), "again")
    kept = without(marked, gone, [x, y])
    if not again.isEmpty():
        whole = F.struct(*[F.col(f"`{c}`") for c in marked.columns])
        twice = marked.join(again, [x, y], "left_semi").join(gone, [x, y], "left_anti")
        once = twice.groupBy(x, y).agg(F.min_by(whole, F.to_json(whole)).alias("whole")).select("whole.*")
        kept = without(kept, again, [x, y]).unionByName(once)
    return kept.drop(x, y)
