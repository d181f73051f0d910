"""Nearest neighbours by inner product: a forest of random-projection trees, then exact scores of what its leaves hold.

Each level of a tree projects on the difference of two random vectors and cuts its nodes at their medians. Trees are
fitted on a bounded sample, down to LEAF of its vectors a leaf, so that a larger table has deeper trees up to that bound,
and every row is routed to one leaf of each tree. A query pops leaves of all trees from one priority queue. A branch costs
the negative logarithm of the chance that a neighbour is on that side of the cut, as neighbours' projections were found to
follow queries' on the sample, and a leaf the sum of its branches, so that leaves come by how likely they hold neighbours.
How many leaves a query pops is measured on the sample: the rank at which the queue reaches REACH of the sample's true
neighbours; a query goes on while what it has popped holds fewer rows than it is to list.

Leaves are dealt to tasks in groups of bounded size: small leaves together, large ones in salted parts, and a group's
queries in as many blocks as they need, so neither a vector that very many rows share nor a crowded region ends up in one
task, and rows go only to blocks that probe their group. Equal vectors are one class, which keeps its smallest ids only, as
no query can list more of them.

Inner products become distances by one more dimension, sqrt(M^2 - |x|^2) with M the largest norm.

Defined results: rows with a null id, or whose vector is null, zero, or holds null or non-finite components, or has
another length than most vectors (the smaller length on ties) take no part; rows that repeat id and vector count once;
an id with several vectors has each of them as a query and a candidate; ties go to the smaller id; empty tables give empty
tables; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from heapq import heappop, heappush
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, ready, stored

#: Vectors that trees are fitted on at most, of them in a leaf, trees, and the share of the sample's neighbours to reach.
SAMPLE, LEAF, TREES, REACH = 1 << 17, 16, 8, 0.93
#: Distinct vectors up to which one leaf holds them all, as a forest saves nothing.
ONE_LEAF = 512
#: Directions of which a level takes the one that spreads the sample most.
DIRECTIONS = 8
#: Sample rows that act as queries to find how neighbours lie and the number of leaves.
TRIALS = 256
#: Index rows and queries of a task's group aimed at, and queries of a task that pops leaves.
GROUP_ROWS, GROUP_QUERIES, TASK_QUERIES = 2048, 4096, 256
#: The logistic curve of this steepness is close to the normal one.
_STEEP = 1.702


@dataclass
class Forest:
    planes: np.ndarray  # (trees, depth, dimensions + 1), orthogonal unit vectors, a level's or zero
    cuts: np.ndarray  # (trees, 2^depth - 1)
    depth: int
    norm: float  # the largest one
    slope: np.ndarray  # (trees, depth): a neighbour's projection is slope times the query's, give or take noise
    noise: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows with the dimension that turns inner products into distances."""
        return np.c_[x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """(trees, rows): the leaf of each row."""
        y = self.lifted(x)
        out = np.zeros((len(self.planes), len(x)), np.int64)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts, strict=True)):
            side = y @ planes.T
            for d in range(self.depth):
                out[t] = 2 * out[t] + (side[:, d] > cuts[(1 << d) - 1 + out[t]])
        return out

    def sides(self, q: np.ndarray) -> np.ndarray:
        """(rows, trees, depth): where neighbours of queries are expected on each level's direction."""
        return np.einsum("qx,tdx->qtd", np.c_[q, np.zeros(len(q))], self.planes) * self.slope

    def penalties(self, q: np.ndarray) -> np.ndarray:
        """(rows, trees * leaves): what each leaf costs."""
        side = self.sides(q)
        out = []
        for t, cuts in enumerate(self.cuts):
            level = np.zeros((len(q), 1))
            for d in range(self.depth):
                first = (1 << d) - 1
                odds = _STEEP * (side[:, t, d, None] - cuts[first : 2 * first + 1]) / self.noise[t, d]
                level = np.stack([level + np.logaddexp(0, odds), level + np.logaddexp(0, -odds)], 2).reshape(len(q), -1)
            out.append(level)
        return np.concatenate(out, 1)

    def popped(self, side: np.ndarray, budget: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The leaves (tree * leaves + leaf) that one query pops from the shared queue, in order: `budget` of them, and more
        while no tree's hold `least` rows together. side: the query's (trees, depth); held: rows of each leaf."""
        trees, depth, leaves = len(self.planes), self.depth, self.leaves
        scaled = (_STEEP * side / self.noise).tolist()
        steep, cuts = (_STEEP / self.noise).tolist(), self.cuts_as_lists
        queue = [(0.0, t, 0, 0) for t in range(trees)]  # cost, tree, depth, number of the node on its level
        out: list[int] = []
        rows = [0] * trees
        while queue and (len(out) < budget or (least and max(rows) < least)):
            cost, t, d, node = heappop(queue)
            at, by, cut = scaled[t], steep[t], cuts[t]
            while d < depth and not (queue and queue[0][0] < cost):
                odds = at[d] - by[d] * cut[(1 << d) - 1 + node]
                small = log1p(exp(-abs(odds)))
                near = 2 * node + (odds > 0)
                d += 1
                heappush(queue, (cost + small + abs(odds), t, d, near ^ 1))
                cost, node = cost + small, near
            if queue and queue[0][0] < cost:  # another branch is likelier by now
                heappush(queue, (cost, t, d, node))
                continue
            leaf = t * leaves + node
            out.append(leaf)
            if least:
                rows[t] += int(held[leaf])
        return out

    @cached_property
    def cuts_as_lists(self) -> list[list[float]]:
        return self.cuts.tolist()


def fit_forest(sample: np.ndarray, norm: float, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest:
    depth = int(np.log2(len(sample) / leaf)) if len(sample) > max(ONE_LEAF, leaf) else 0
    wide = sample.shape[1] + 1
    f = Forest(np.zeros((trees, depth, wide)), np.zeros((trees, (1 << depth) - 1)), depth, norm, np.ones((trees, depth)), np.ones((trees, depth)))
    y = f.lifted(sample)
    rng = np.random.default_rng(seed)
    for t in range(trees):
        at = np.zeros(len(y), np.int64)
        for d in range(depth):
            some = y[rng.integers(0, len(y), DIRECTIONS)] - y[rng.integers(0, len(y), DIRECTIONS)]
            for _ in range(2):  # twice, as rounding leaves some of the earlier directions
                some -= some @ f.planes[t, :d].T @ f.planes[t, :d]
            length = np.linalg.norm(some, axis=1, keepdims=True)
            some = np.where(length > 1e-9 * max(norm, 1e-300), some / np.maximum(length, 1e-300), 0)
            f.planes[t, d] = some[(y @ some.T).std(0).argmax()]
            side = y @ f.planes[t, d]
            order = np.lexsort((side, at))
            ends = np.searchsorted(at[order], np.arange((1 << d) + 1))
            middle = np.minimum((ends[:-1] + ends[1:]) // 2, len(y) - 1)
            f.cuts[t, (1 << d) - 1 : (2 << d) - 1] = side[order][np.maximum(middle - 1, 0)]
            at = 2 * at + (side > f.cuts[t, (1 << d) - 1 + at])
    return f


def trials(sample: np.ndarray, k: int, many: int = TRIALS) -> tuple[np.ndarray, np.ndarray]:
    """(places, neighbours): some rows of the sample that act as queries, and their k nearest others."""
    at = np.arange(0, len(sample), max(1, len(sample) // many))[:many]
    k = min(k, len(sample) - 1)
    best = []
    for i in range(0, len(at), 32):
        score = sample[at[i : i + 32]] @ sample.T
        score[np.arange(len(score)), at[i : i + 32]] = -np.inf
        best.append(np.argpartition(-score, k - 1, axis=1)[:, :k])
    return at, np.concatenate(best)


def fit_neighbours(f: Forest, sample: np.ndarray, at: np.ndarray, best: np.ndarray) -> None:
    """How neighbours' projections follow queries' on each level."""
    for t, planes in enumerate(f.planes):
        own = np.c_[sample[at], np.zeros(len(at))] @ planes.T
        near = (f.lifted(sample[best.ravel()]) @ planes.T).reshape(*best.shape, f.depth)
        f.slope[t] = (own[:, None] * near).mean((0, 1)) / np.maximum((own**2).mean(0), 1e-300)
        f.noise[t] = np.maximum((near - f.slope[t] * own[:, None]).std((0, 1)), 1e-9 * max(f.norm, 1e-300))


def budget_of(f: Forest, sample: np.ndarray, at: np.ndarray, best: np.ndarray, reach: float = REACH) -> int:
    """Leaves that the queue has to pop for `reach` of the neighbours of the trials."""
    leaf = f.leaf_of(sample) + np.arange(len(f.planes))[:, None] * f.leaves
    ranks = []
    for i in range(0, len(at), 32):
        p = f.penalties(sample[at[i : i + 32]])
        rank = np.empty(p.shape, np.int32)
        np.put_along_axis(rank, np.argsort(p, axis=1, kind="stable"), np.arange(p.shape[1], dtype=np.int32)[None, :], axis=1)
        ranks.append(np.min([np.take_along_axis(rank, own[best[i : i + 32]], axis=1) for own in leaf], axis=0))
    return int(np.quantile(np.concatenate(ranks), reach, method="higher")) + 1


def valid_rows(df: DataFrame, vector: str) -> DataFrame:
    """(id, v) of the rows whose vectors take part, v in the vectors' own precision. df: (id, vector)."""
    ready(df.sparkSession)
    dtype = _dtype(df, vector)

    def run(batches):
        for b in batches:
            ids, out = [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                a = x.values
                if i is not None and a is not None and len(a) and not a.null_count:
                    a = a.to_numpy(zero_copy_only=False).astype(dtype)
                    if np.isfinite(a).all() and a.any():
                        ids.append(i)
                        out.append((a + a.dtype.type(0)).tobytes())  # -0.0 is 0.0
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "v"])

    return df.select("id", vector).mapInArrow(lean(run), "id long, v binary")


def classes(df: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """(class, ids, v): each distinct valid vector with its `keep` smallest ids, the least of which names it."""
    spark = df.sparkSession
    few = valid_rows(df.select(F.col(key).cast("long").alias("id"), vector), vector).distinct()
    w = Window.partitionBy("v").orderBy("id")
    # the rank's limit is taken before the shuffle as well, so a vector of many rows costs few
    few = few.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep)
    each = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    each = stored(spark, each.select(F.col("ids")[0].alias("class"), "ids", "v"), "classes")
    sizes = each.groupBy(F.length("v").alias("n")).agg(F.sum(F.size("ids")).alias("k")).orderBy(F.desc("k"), "n").limit(1).collect()
    return each.filter(F.length("v") == sizes[0].n) if sizes else each


def _matrix(blobs: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    """Vectors in double precision."""
    parts = blobs.to_pylist()
    return np.frombuffer(b"".join(parts), dtype).reshape(len(parts), -1).astype(np.float64) if parts else np.zeros((0, 1))


def _dtype(df: DataFrame, vector: str) -> str:
    return "<f4" if df.schema[vector].dataType.elementType.typeName() == "float" else "<f8"


@dataclass
class Groups:
    """Which group each leaf is in, and into how many parts a group's rows and queries are dealt."""

    group: np.ndarray
    salts: np.ndarray
    splits: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, rows_aim: int) -> Groups:
        group, salts, held = np.zeros(len(rows), np.int64), [], 0
        for leaf, n in enumerate(rows.tolist()):
            if not salts or held + n > rows_aim:
                salts.append(max(1, -(-n // rows_aim)))
                held = 0
            held += n
            group[leaf] = len(salts) - 1
        return cls(group, np.array(salts or [1], np.int64), np.ones(max(len(salts), 1), np.int64))


def _route(df: DataFrame, forest, dtype: str) -> DataFrame:
    """(leaf): of every row its leaf in each tree, for counting."""

    def run(batches):
        f = forest.value
        for b in batches:
            if b.num_rows:
                leaf = f.leaf_of(_matrix(b.column(0), dtype)) + np.arange(len(f.planes))[:, None] * f.leaves
                at, n = np.unique(leaf, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["leaf", "n"])

    return df.select("v").mapInArrow(lean(run), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))


def _part(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _bytes4(leaf: np.ndarray) -> pa.Array:
    offsets = np.arange(0, 4 * len(leaf) + 1, 4, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(leaf), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(leaf.astype(np.int32).tobytes())])


def _rows(df: DataFrame, forest, groups, dtype: str) -> DataFrame:
    """(cell, class, leaf, v): every row in each cell of (group, its salt, each block of queries) of its leaves."""

    def run(batches):
        f, g = forest.value, groups.value
        base = np.cumsum(g.salts * g.splits) - g.salts * g.splits
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            leaf = (f.leaf_of(_matrix(b.column(1), dtype)) + np.arange(len(f.planes))[:, None] * f.leaves).T
            own = g.group[leaf]
            cell = base[own] + _part(ids[:, None], g.salts[own]) * g.splits[own]
            times = g.splits[own].ravel()
            at = np.repeat(np.arange(len(times)), times)
            step = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            row = at // leaf.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.ravel()[at] + step), b.column(0).take(pa.array(row)), _bytes4(leaf.ravel()[at]), b.column(1).take(pa.array(row))], ["cell", "class", "leaf", "v"]
            )

    return df.select("class", "v").mapInArrow(lean(run), "cell long, class long, leaf binary, v binary")


def _probed(df: DataFrame, forest, held, budget: int, least: int, dtype: str) -> DataFrame:
    """(class, leaves, v): the leaves that every query pops, in order of their numbers."""

    def run(batches):
        f, rows = forest.value, held.value
        for b in batches:
            if b.num_rows:
                side = f.sides(_matrix(b.column(1), dtype))
                leaves = [np.sort(np.array(f.popped(s, budget, rows, least), np.int32)).tobytes() for s in side]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(leaves, pa.binary()), b.column(1)], ["class", "leaves", "v"])

    return df.select("class", "v").mapInArrow(lean(run), "class long, leaves binary, v binary")


def _asked(probed: DataFrame, groups) -> DataFrame:
    """(group, n): the queries that probe a group."""

    def run(batches):
        g = groups.value
        n = np.zeros(len(g.salts), np.int64)
        for b in batches:
            for leaves in b.column(0).to_pylist():
                n[np.unique(g.group[np.frombuffer(leaves, np.int32)])] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["group", "n"])

    return probed.select("leaves").mapInArrow(lean(run), "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))


def _probes(probed: DataFrame, groups, dtype: str) -> DataFrame:
    """(cell, query, leaves, v): every query in each cell that holds a leaf it pops, with those leaves."""

    def run(batches):
        g = groups.value
        base = np.cumsum(g.salts * g.splits) - g.salts * g.splits
        for b in batches:
            ids, vectors = b.column(0).to_numpy(), b.column(2)
            cells, who, leaves = [], [], []
            for r, blob in enumerate(b.column(1).to_pylist()):
                leaf = np.frombuffer(blob, np.int32)
                own = g.group[leaf]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                k = own[first]
                part = _part(np.full(len(k), ids[r]), g.splits[k])
                for a, z, at, salts, splits in zip(first.tolist(), np.r_[first[1:], len(own)].tolist(), (base[k] + part).tolist(), g.salts[k].tolist(), g.splits[k].tolist(), strict=True):
                    for s in range(salts):
                        cells.append(at + s * splits)
                        who.append(r)
                        leaves.append(leaf[a:z].tobytes())
                if len(cells) >= HELD_PROBES or r == len(ids) - 1:
                    at = pa.array(who, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), b.column(0).take(at), pa.array(leaves, pa.binary()), vectors.take(at)], ["cell", "query", "leaves", "v"])
                    cells, who, leaves = [], [], []

    return probed.mapInArrow(lean(run), "cell long, query long, leaves binary, v binary")


def _best(owner: np.ndarray, who: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each owner the `keep` largest scores, ties to the smaller id, a (owner, id) once."""
    at = np.lexsort((who, -score, owner))
    owner, who, score = owner[at], who[at], score[at]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (who[1:] != who[:-1])] if len(owner) else np.zeros(0, bool)
    owner, who, score = owner[new], who[new], score[new]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    ok = place < keep
    return owner[ok], who[ok], score[ok]


def _full(owner: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The owners that have `keep` scores, and the least of them. Sorted by owner, then by falling score."""
    ids, first, n = np.unique(owner, return_index=True, return_counts=True)
    some = n >= keep
    return ids[some], score[first[some] + keep - 1]


class _Cell:
    """The queries of one cell, and what each of them finds in the rows that go by."""

    def __init__(self, keep: int) -> None:
        self.keep = keep
        self.ids: list[np.ndarray] = []
        self.leaves: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.all = None

    def ask(self, ids: np.ndarray, leaves: list[bytes], v: np.ndarray) -> None:
        self.ids.append(ids)
        self.leaves += [np.frombuffer(b, np.int32) for b in leaves]
        self.vectors.append(v)

    def answer(self, who: np.ndarray, leaf: np.ndarray, x: np.ndarray, floor: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, class, score) of the best rows of the leaves that queries probe. floor: queries in order of their ids, and
        scores that they already have enough of."""
        if not self.ids:
            return []
        if self.all is None:
            self.all, self.y = np.concatenate(self.ids), np.concatenate(self.vectors)
            every = np.concatenate(self.leaves)
            self.named = np.unique(every)
            asker = np.repeat(np.arange(len(self.leaves)), [len(w) for w in self.leaves])
            self.probes = np.zeros((len(self.all), len(self.named) + 1), bool)  # the last column is for leaves that none probes
            self.probes[asker, np.searchsorted(self.named, every)] = True
        at = np.minimum(np.searchsorted(self.named, leaf), len(self.named) - 1)
        at = np.where(self.named[at] == leaf, at, len(self.named))
        least = np.full(len(self.all), -np.inf)
        if len(floor[0]):
            place = np.minimum(np.searchsorted(floor[0], self.all), len(floor[0]) - 1)
            least = np.where(floor[0][place] == self.all, floor[1][place], least)
        out = []
        dense = self.probes[:, np.unique(at)].mean() > DENSE_SHARE
        for rows in [np.arange(len(at))] if dense else [np.flatnonzero(at == one) for one in np.unique(at)]:
            ask = np.arange(len(self.all)) if dense else np.flatnonzero(self.probes[:, at[rows[0]]])
            for i in range(0, len(ask), 512):
                part = ask[i : i + 512]
                s = self.y[part] @ x[rows].T
                if dense:
                    s[~self.probes[part][:, at]] = -np.inf
                low = least[part]
                if s.shape[1] > self.keep:
                    low = np.maximum(low, np.partition(s, s.shape[1] - self.keep, axis=1)[:, s.shape[1] - self.keep])
                a, b = np.nonzero((s >= low[:, None]) & (s > -np.inf))
                out.append((self.all[part[a]], who[rows[b]], s[a, b]))
        return out


#: Share of the pairs of a cell's queries and leaves from which their products are taken at once.
DENSE_SHARE = 0.2
#: Probes that are dealt out at a time.
HELD_PROBES = 1 << 14
#: Scores that a search task holds before it drops all but the best of each query.
HELD_SCORES = 1 << 20


def _searched(rows: DataFrame, probes: DataFrame, keep: int, dtype: str) -> DataFrame:
    """(query, class, score): the `keep` best classes of each query in each task, by exact products.

    A cell's queries come first, then its rows stream by; what queries find is merged over all cells of a task.
    """
    both = probes.select("cell", F.lit(0).alias("kind"), F.col("query").alias("id"), F.col("leaves").alias("leaf"), "v")
    both = both.union(rows.select("cell", F.lit(1).alias("kind"), F.col("class").alias("id"), "leaf", "v"))
    dealt = both.repartition("cell").sortWithinPartitions("cell", "kind")

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        many, limit = 0, HELD_SCORES
        cell, state = None, _Cell(keep)
        floor = (np.zeros(0, np.int64), np.zeros(0))
        merged = lambda: _best(*(np.concatenate(c) for c in zip(*held, strict=True)), keep)
        for b in batches:
            if not b.num_rows:
                continue
            cells, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])])
            for i, j in zip(cuts, np.r_[cuts[1:], len(cells)], strict=True):
                if cells[i] != cell:
                    cell, state = cells[i], _Cell(keep)
                ids, leaf, v = b.column(2).slice(i, j - i).to_numpy(), b.column(3).slice(i, j - i).to_pylist(), _matrix(b.column(4).slice(i, j - i), dtype)
                if kinds[i] == 0:
                    state.ask(ids, leaf, v)
                else:
                    found = state.answer(ids, np.frombuffer(b"".join(leaf), np.int32), v, floor)
                    held += found
                    many += sum(len(f[0]) for f in found)
                    if many > limit:
                        held = [merged()]
                        many = len(held[0][0])
                        floor = _full(held[0][0], held[0][2], keep)
                        if many > HELD_SCORES:  # more queries than fit: what they have found so far leaves the task
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["query", "class", "score"])
                            held, many = [], 0
                        limit = many + HELD_SCORES
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged()], ["query", "class", "score"])

    return dealt.mapInArrow(lean(run), "query long, class long, score double")


def nearest(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that `is_query` (over id) admits."""
    spark: SparkSession = df.sparkSession
    c = classes(df, key, vector, k + 1)
    dtype = _dtype(df, vector)
    norm = _norms(c, dtype).agg(F.max("n")).first()[0] or 1.0
    some = c.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()  # a bounded sample
    sample = _matrix(some.column(0), dtype)
    f = fit_forest(sample, norm)
    budget = 1
    if f.depth:
        own = trials(sample, k)
        fit_neighbours(f, sample, *own)
        budget = budget_of(f, sample, *own, reach)
    sc = spark.sparkContext
    forest = sc.broadcast(f)
    count = np.zeros(len(f.planes) * f.leaves, np.int64)
    for r in _route(c, forest, dtype).collect():  # a row for each leaf
        count[r.leaf] = r.n
    groups = Groups.of(count, GROUP_ROWS)
    # a query's row goes with the class of its vector; all ids of a class that are queries are asked for at once
    asked = df.select(F.col(key).cast("long").alias("id"), vector).filter(is_query)
    askers = stored(spark, valid_rows(asked, vector).distinct(), "askers")
    every = askers.groupBy("v").agg(F.min("id").alias("class"))
    every = every.filter(F.length("v") == int(dtype[2]) * sample.shape[1]) if len(sample) else every.limit(0)
    # popping costs far more than the few bytes of a query tell
    every = every.repartition(max(1, -(-askers.count() // TASK_QUERIES)), "v")
    probed = stored(spark, _probed(every, forest, sc.broadcast(count), budget, k + 1, dtype), "probed")
    groups.splits[:] = 0
    for r in _asked(probed, sc.broadcast(groups)).collect():  # a row for each group
        groups.splits[r.group] = -(-r.n // GROUP_QUERIES)
    shared = sc.broadcast(groups)
    found = _searched(_rows(c, forest, shared, dtype), _probes(probed, shared, dtype), k + 1, dtype)
    found = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    found = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).drop("r")
    wide = found.join(c.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    who = askers.join(probed.select("v", F.col("class").alias("query")), "v").select("query", F.col("id").alias("query_id"))
    out = wide.join(who, "query").filter("query_id != vec_id")
    w = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    out = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _norms(c: DataFrame, dtype: str) -> DataFrame:
    """(n): the largest norm of each batch."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dtype)
                yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((x * x).sum(1)).max())])], ["n"])

    return c.select("v").mapInArrow(lean(run), "n double")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
