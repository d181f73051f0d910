"""Benchmark decontamination: an inverted index of the test items, queried by every passage of every training document.

A passage is a window of twice the longest item's words (and some slack), half of it shared with the next, so that a
copy lies within one. Passages are queries, items are what BM25 scores. An item's threshold is the least score that a
passage with three quarters of its shingles can have, so retrieval loses nothing that verification would accept.

Retrieval is block-max WAND, for all passages of a slice at once. Items stand in order of their thresholds, in blocks, and
blocks in tiers of like thresholds. A passage's terms are ordered by their largest weights; up to the pivot, where these
add up to the tier's least threshold, terms alone cannot reach it, so only blocks that hold a term from the pivot on are
looked at. A block whose largest weights of the passage's terms do not add up to its least threshold stays closed; the
others' postings are scored. Only pairs of a term and a block that occur are kept, so the index grows with its words.
Retrieved items are verified in the passage: at least 3/4 of the item's five-word shingles, and at least 3/4 of the words
of its answer, its last third.

Defined results: null or empty texts hold nothing; items without words are never found; items of fewer than five words
are one shingle; repeated documents or items count once per id, and all items that tie with a threshold are verified;
empty tables give empty tables; other columns are ignored, whatever their names. The index is broadcast in parts of about
``INDEX_WORDS`` words, at most 60 bytes each; more items mean more passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffer_of, fresh_names, lean, ready, shingle_hashes, slices, stored, without, word_hashes, words

#: Words of an index part at most, items of a block, and words of slack in a window's half.
INDEX_WORDS, BLOCK, SLACK = 2_000_000, 64, 8
K1, B = 1.2, 0.75


@dataclass
class Index:
    ids: np.ndarray
    half: int  # words that windows move on by
    terms: np.ndarray  # sorted hashes
    maybe: np.ndarray
    most: np.ndarray  # largest weight of each term
    blocks: int
    tiers: list[tuple[float, int, int]]  # least threshold, first block, end
    opens: np.ndarray  # least threshold of each block
    limits: np.ndarray  # threshold of each place in the order of thresholds
    cells: np.ndarray  # term * blocks + block of each pair that occurs, in order
    bounds: np.ndarray  # largest weight of a cell
    at: np.ndarray  # postings of a cell: from at[cell]
    items: np.ndarray  # places
    weights: np.ndarray
    by: np.ndarray  # item at each place
    shingles: list[np.ndarray]
    answers: list[np.ndarray]
    lengths: np.ndarray  # words of each item

    def term_numbers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, term numbers) of the hashes that are terms."""
        some = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        if not len(self.terms):
            return some[:0], some[:0]
        t = np.minimum(np.searchsorted(self.terms, h[some]), len(self.terms) - 1)
        ok = self.terms[t] == h[some]
        return some[ok], t[ok]


def item_shingles(h: np.ndarray) -> np.ndarray:
    return np.unique(shingle_hashes(h, min(5, len(h)))) if len(h) else np.zeros(0, np.uint64)


def build_index(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, half: int) -> Index:
    starts, ends, owner = words(data, offsets)
    h = word_hashes(data, starts, ends)
    n = len(ids)
    size = np.bincount(owner, minlength=n)
    terms, t = np.unique(h, return_inverse=True)
    pair, tf = np.unique(owner * max(len(terms), 1) + t, return_counts=True)
    item, term = pair // max(len(terms), 1), pair % max(len(terms), 1)
    holders = np.bincount(term, minlength=len(terms))
    idf = np.log(1 + (n - holders + 0.5) / (holders + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / max(len(h) / max(n, 1), 1e-9)))
    cuts = np.searchsorted(owner, np.arange(n + 1))
    shingles = [item_shingles(h[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    answers = [np.unique(h[b - max(1, (b - a) // 3) : b]) if b > a else h[:0] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    thresholds = np.full(n, np.inf)
    by_item = np.searchsorted(item, np.arange(n + 1))
    for i in range(n):
        own = np.sort(weight[by_item[i] : by_item[i + 1]])[::-1]
        if len(own):
            lost = len(shingles[i]) - -(-3 * len(shingles[i]) // 4)  # shingles that may be missing, and words at most
            thresholds[i] = max(own[lost:].sum() * (1 - 1e-6), 1e-9)
    by = np.argsort(thresholds, kind="stable")
    place = np.empty(n, np.int64)
    place[by] = np.arange(n)
    item, limits = place[item], np.append(thresholds[by], np.full(-n % BLOCK or (BLOCK if n == 0 else 0), np.inf))
    blocks = max(1, -(-n // BLOCK))
    order = np.lexsort((item, term))
    item, term, weight = item[order], term[order], weight[order]
    cells, first = np.unique(term * blocks + item // BLOCK, return_index=True)
    bounds = np.maximum.reduceat(weight, first) if len(first) else weight
    most = np.zeros(len(terms))
    np.maximum.at(most, cells // blocks, bounds)
    maybe = np.zeros(1 << 20, bool)
    maybe[(terms >> np.uint64(44)).astype(np.int64)] = True
    opens = limits[::BLOCK]
    level = np.floor(np.log2(opens[np.isfinite(opens)]))
    ends = np.flatnonzero(np.r_[True, level[1:] != level[:-1], True]) if len(level) else np.zeros(0, np.int64)
    tiers = [(float(opens[a]), int(a), int(b)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return Index(ids, half, terms, maybe, most, blocks, tiers, opens, limits, cells, bounds, np.append(first, len(item)), item.astype(np.int32), weight, by, shingles, answers, size)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(first, sizes) + np.repeat(starts, sizes)


def retrieve(index: Index, term: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of all items that reach their thresholds. term, window: occurrences, in any order."""
    none = np.zeros(0, np.int64)
    if not len(term):
        return none, none
    pair = np.unique(window * len(index.terms) + term)
    window, term = pair // len(index.terms), pair % len(index.terms)
    order = np.lexsort((index.most[term], window))
    window, term = window[order], term[order]
    most = index.most[term]
    first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
    size = np.diff(np.r_[first, len(window)])
    number = np.repeat(np.arange(len(first)), size)  # of the window
    sums = np.cumsum(most)
    sums -= (sums[first] - most[first])[number]
    found = [_scored(index, tier, term, most, first, size, number, sums) for tier in index.tiers]
    w, i = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)
    return window[first[w]], i


def _scored(index: Index, tier: tuple[float, int, int], term, most, first, size, number, sums) -> tuple[np.ndarray, np.ndarray]:
    """(number of the window, item) of what reaches its threshold in the blocks of one tier."""
    least, begin, end = tier
    pivot = sums >= least * (1 - 1e-9)
    own = np.flatnonzero(pivot)
    a, b = (np.searchsorted(index.cells, term[own] * index.blocks + x) for x in (begin, end))
    cell = _spread(a, b - a)
    key = np.repeat(number[own], b - a) * index.blocks + index.cells[cell] % index.blocks
    near, which = np.unique(key, return_inverse=True)
    w, block = near // index.blocks, near % index.blocks
    before = np.add.reduceat(~pivot, first).astype(np.int64)  # terms in front of the pivot come first in their window
    rest = np.where(before > 0, sums[first + np.maximum(before - 1, 0)], 0.0)
    bound = np.bincount(which, index.bounds[cell], len(near))
    some = bound + rest[w] >= index.opens[block] * (1 - 1e-9)
    # the bounds of the terms in front of the pivot, in the blocks that are left
    left = np.flatnonzero(some)
    slot = np.repeat(left, before[w[left]])
    wanted = term[_spread(first[w[left]], before[w[left]])] * index.blocks + block[slot]
    at = np.minimum(np.searchsorted(index.cells, wanted), len(index.cells) - 1)
    ok = index.cells[at] == wanted
    slot, at = slot[ok], at[ok]
    bound += np.bincount(slot, index.bounds[at], len(near))
    some &= bound >= index.opens[block] * (1 - 1e-9)
    cell, slot = np.r_[cell, at], np.r_[which, slot]
    keep = some[slot]
    cell, slot = cell[keep], slot[keep]
    opened = np.cumsum(some) - 1
    many = index.at[cell + 1] - index.at[cell]
    post = _spread(index.at[cell], many)
    score = np.bincount(np.repeat(opened[slot], many) * BLOCK + index.items[post] % BLOCK, index.weights[post], int(some.sum()) * BLOCK)
    k, i = np.nonzero(score.reshape(-1, BLOCK) >= index.limits.reshape(-1, BLOCK)[block[some]])
    return w[some][k], index.by[block[some][k] * BLOCK + i]


def search(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, item, shared shingles, item's shingles) of the verified items, the best passage of each."""
    starts, ends, owner = words(data, offsets)
    h = word_hashes(data, starts, ends)
    cuts = np.searchsorted(owner, np.arange(len(offsets)))
    at, term = index.term_numbers(h)
    doc, k = owner[at], (at - cuts[owner[at]]) // index.half
    windows = np.maximum(1, -(-np.diff(cuts) // index.half) - 1)
    base = np.cumsum(windows) - windows
    own, before = k < windows[doc], k > 0
    found = retrieve(index, np.r_[term[own], term[before]], np.r_[(base[doc] + k)[own], (base[doc] + k - 1)[before]])
    best: dict[tuple[int, int], int] = {}
    for w, i in zip(found[0].tolist(), found[1].tolist(), strict=True):
        d = int(np.searchsorted(base, w, "right")) - 1
        a = cuts[d] + (w - int(base[d])) * index.half
        part = h[a : min(a + 2 * index.half, cuts[d + 1])]
        k_ = min(5, int(index.lengths[i]))
        shared = int(np.isin(index.shingles[i], shingle_hashes(part, k_)).sum())
        if 4 * shared >= 3 * len(index.shingles[i]) and 4 * np.isin(index.answers[i], part).sum() >= 3 * len(index.answers[i]):
            best[d, i] = max(best.get((d, i), 0), shared)
    return [(d, i, s, len(index.shingles[i])) for (d, i), s in best.items()]


def verified(spark: SparkSession, docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, shared, similarity) of every item that a document holds, by its best passage."""
    ready(spark)
    own = items.filter(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()
    count = F.size(F.regexp_extract_all("t", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    total, longest = own.agg(F.sum(count), F.max(count)).first()
    parts = max(1, -(-(total or 0) // INDEX_WORDS))
    half = (longest or 0) + SLACK
    kind = docs.schema[key].dataType.simpleString()
    out = None
    for p in range(parts):
        rows = own.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).orderBy("i", "t").toArrow()  # INDEX_WORDS words, about
        index = spark.sparkContext.broadcast(build_index(rows.column(0).to_numpy(), *buffer_of(rows.column(1)), half))

        def run(batches, index=index):
            for b in batches:
                data, offsets = buffer_of(b.column(1))
                for i, j in slices(offsets):
                    found = search(index.value, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    if found:
                        d, k, s, n = map(np.array, zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(i + d)), pa.array(index.value.ids[k]), pa.array(s, pa.int64()), pa.array(s / n)], [key, "item_id", "shared", "similarity"]
                        )

        each = docs.select(key, text).mapInArrow(lean(run), f"`{key}` {kind}, item_id long, shared long, similarity double")
        out = each if out is None else out.union(each)
    return out.groupBy(key, "item_id").agg(F.max("shared").alias("shared"), F.max("similarity").alias("similarity"))


def decontaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows whose text holds an item: rows go by their text's hash, so null and repeated ids don't matter."""
    (mark,) = fresh_names(docs, 1)
    marked = docs.withColumn(mark, F.struct(F.xxhash64(text).alias("x"), F.xxhash64(text, F.lit(1)).alias("y")))
    leaks = verified(spark, marked.filter(F.col(text).isNotNull()), items, mark, text).select(mark)
    return without(marked, stored(spark, leaks, "leaks"), [mark]).drop(mark)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return verified(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
