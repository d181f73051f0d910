"""Joins: fuzzy, range, nearest, spatial, one-to-one and prioritised ones, each on an equality that deals out its rows."""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import names as N


def deletions(text: Column) -> Column:
    """text and what is left of it without each one of its characters: texts one edit apart have one of these in common."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.array_distinct(F.concat(F.array(text), F.transform(at, lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))))


def snap(values: DataFrame, keys: DataFrame) -> DataFrame:
    """values (.., val) with `snapped`: val itself if it is a key, else the only long key one edit away, else null.

    keys: (key), which may repeat. Candidates meet on what is left without one character, so no common prefix is hot.
    """
    keys = keys.select("key").distinct()
    v = values.select("val").distinct()
    exact = v.join(keys.select(F.col("key").alias("val"), F.lit(True).alias("is_key")), "val", "left")
    rest = exact.filter("is_key is null and length(val) >= 6").select("val", F.explode(deletions(F.col("val"))).alias("left_"))
    long_ = keys.filter(F.length("key") >= 6).select("key", F.explode(deletions(F.col("key"))).alias("left_"))
    near = rest.join(long_, "left_").filter(F.substring("val", 1, 2) == F.substring("key", 1, 2)).filter(N.edit_distance_one(F.col("val"), F.col("key")))
    one = near.groupBy("val").agg(F.min("key").alias("one"), F.max("key").alias("last_")).filter("one = last_").select("val", "one")
    found = exact.join(one, "val", "left").select("val", F.when(F.col("is_key"), F.col("val")).otherwise(F.col("one")).alias("snapped"))
    return values.join(found, "val", "left").select(*values.columns, "snapped")


def range_join(points: DataFrame, ranges: DataFrame, keys: list[str], value: str, lo: str, hi: str, width: int) -> DataFrame:
    """Points with every range of their key that holds them, ends included.

    Ranges are laid out over cells of `width`, points lie in one; so a key with many ranges or points is dealt out too.
    Ranges far wider than `width` cost a row for each cell.
    """
    cells = F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))
    r = ranges.filter(F.col(lo) <= F.col(hi)).withColumn("cell_", F.explode(cells))
    p = points.withColumn("cell_", F.floor(F.col(value) / width))
    return p.join(r, [*keys, "cell_"]).filter(F.col(value).between(F.col(lo), F.col(hi))).drop("cell_")


def address_sides(segments: DataFrame) -> DataFrame:
    """A row for each frontage of a segment that has a range: side, first, last, lo, hi, parity."""
    s = segments.withColumn("sides_", G.range_sides(F.col("l_from"), F.col("l_to"), F.col("r_from"), F.col("r_to")))
    s = s.select("*", F.explode("sides_").alias("side", "range_")).drop("sides_")
    parity = F.upper(F.trim(F.coalesce(F.when(F.col("side") == "l", F.col("l_parity")).otherwise(F.col("r_parity")), F.lit(""))))
    first, last = F.col("range_.first"), F.col("range_.last")
    s = s.select("*", first.alias("first"), last.alias("last"), F.least(first, last).alias("lo"), F.greatest(first, last).alias("hi"))
    return s.withColumn("parity", parity).drop("range_")


#: Equal frontages that numerals meet at once; more are dealt out.
FRONTAGES = 1024


def match_address(numerals: DataFrame, segments: DataFrame, width: int = 100, digits: int | None = None) -> DataFrame:
    """Numerals (street_key, value, ..) with each frontage of their street that holds them and agrees in parity.

    Adds side and fraction, the place along the segment, rounded to `digits`; 0.5 where a frontage has one number only. Equal
    numbers of a street are held against its equal frontages once; every numeral with every segment there is a row.
    """
    sides = address_sides(segments)
    same = ["street_key", "side", "first", "last", "parity"]
    places = sides.groupBy(*same, "lo", "hi").agg(F.ceil(F.count(F.lit(1)) / FRONTAGES).alias("parts_"))
    found = range_join(numerals.select("street_key", "value").distinct(), places, ["street_key"], "value", "lo", "hi", width)
    odd = F.when(F.col("parity") == "O", 1).when(F.col("parity") == "E", 0)
    found = found.filter(odd.isNull() | (F.pmod(F.col("value"), F.lit(2)) == odd))
    span = F.col("last") - F.col("first")
    raw = F.when(span == 0, 0.5).otherwise((F.col("value") - F.col("first")) / F.nullif(span, F.lit(0)))
    fraction = F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
    found = found.select("value", *same, "parts_", (fraction if digits is None else F.round(fraction, digits)).alias("fraction"))
    dealt = numerals.join(found, ["street_key", "value"]).withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1))).drop("parts_")
    own = F.pmod(F.xxhash64(*[c for c in sides.columns if c not in same]), F.col("parts_"))
    parts = sides.join(places.select(*same, "parts_"), same).withColumn("part_", own).drop("parts_")
    every = dealt.join(parts.hint("merge"), [*same, "part_"])  # a broadcast would leave all rows to the few tasks of the places
    return every.select("street_key", *[c for c in (*numerals.columns, *sides.columns) if c != "street_key"], "fraction")


def convert_numbers(numbers: DataFrame, table: DataFrame, tolerance: float, width: int = 100) -> DataFrame:
    """numbers (id, street_key, value) with `modern`: the first answer in the table's order, or null.

    Null where no entry covers the number, or where its answers differ by more than tolerance. Equal numbers of a street are
    looked up once. table: (ord, street_key, old_first, old_last, new_first, new_last), whose ranges may run down.
    """
    t = table.withColumns({"lo": F.least("old_first", "old_last"), "hi": F.greatest("old_first", "old_last")})
    found = range_join(numbers.select("street_key", "value").distinct(), t, ["street_key"], "value", "lo", "hi", width)
    way = lambda a, b: F.when(F.col(b) < F.col(a), -1).otherwise(1)
    answer = F.col("new_first") + way("old_first", "old_last") * way("new_first", "new_last") * (F.col("value") - F.col("old_first"))
    agg = found.withColumn("answer", answer).groupBy("street_key", "value")
    agg = agg.agg(F.min_by("answer", "ord").alias("first_"), (F.max("answer") - F.min("answer")).alias("apart_"))
    modern = agg.filter(F.col("apart_") <= tolerance).select("street_key", "value", F.col("first_").alias("modern"))
    return numbers.join(modern, ["street_key", "value"], "left").select(*numbers.columns, "modern")


#: Segments of a cell aimed at, and cells of a key along each axis at most.
CELL_SEGMENTS, MOST_CELLS = 32, 64


def nearest_segment(points: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """points (id, key, px, py, ..) with the nearest segment (seg, x0, y0, x1, y1) of their key: seg, distance, fraction.

    Ties go to the smaller seg. Each key has a grid over its segments, finer the more it has. The farthest corner of the
    occupied cells bounds a point's distance, so it meets only the segments of cells that begin within the least of these
    bounds, on key and cell; the list of a key's cells is at most MOST_CELLS squared.
    """
    n = F.least(F.lit(float(MOST_CELLS)), F.ceil(F.sqrt(F.count(F.lit(1)) / CELL_SEGMENTS))).cast("double")
    low = [F.min(F.least(f"{c}0", f"{c}1")).cast("double").alias(f"{c}_") for c in "xy"]
    size = [F.greatest((F.max(F.greatest(f"{c}0", f"{c}1")) - F.min(F.least(f"{c}0", f"{c}1"))) / n, F.lit(1e-9)).alias(f"{c}s_") for c in "xy"]
    grid = segments.groupBy(key).agg(*low, *size)
    cell = lambda v, c: F.floor((v - F.col(f"{c}_")) / F.col(f"{c}s_"))
    dealt = segments.join(grid, key)
    for c in "xy":
        dealt = dealt.withColumn(f"c{c}_", F.explode(F.sequence(cell(F.least(f"{c}0", f"{c}1"), c), cell(F.greatest(f"{c}0", f"{c}1"), c))))
    dealt = dealt.drop("x_", "y_", "xs_", "ys_")
    # a cell counts by the segment ends in it, as only these are sure to lie in it
    ends = segments.join(grid, key).select(key, F.explode(F.array(*[F.struct(cell(F.col(f"x{k}"), "x").alias("cx_"), cell(F.col(f"y{k}"), "y").alias("cy_")) for k in (0, 1)])).alias("c_"))
    ends = ends.groupBy(key).agg(F.collect_set("c_").alias("ends_"))
    occupied = dealt.groupBy(key).agg(F.collect_set(F.struct("cx_", "cy_")).alias("cells_"))

    def far(c: Column, axis: str) -> Column:
        a = F.col(f"{axis}_") + c * F.col(f"{axis}s_")
        return F.greatest(F.abs(F.col(f"p{axis}") - a), F.abs(F.col(f"p{axis}") - a - F.col(f"{axis}s_")))

    def near(c: Column, axis: str) -> Column:
        a = F.col(f"{axis}_") + c * F.col(f"{axis}s_")
        return F.greatest(a - F.col(f"p{axis}"), F.col(f"p{axis}") - a - F.col(f"{axis}s_"), F.lit(0.0))

    p = points.join(grid.join(ends, key).join(occupied, key), key)
    p = p.withColumn("most_", F.array_min(F.transform("ends_", lambda c: F.hypot(far(c["cx_"], "x"), far(c["cy_"], "y")))))
    p = p.withColumn("c_", F.explode(F.filter("cells_", lambda c: F.hypot(near(c["cx_"], "x"), near(c["cy_"], "y")) <= F.col("most_") * (1 + 1e-9) + 1e-9)))
    both = p.select(*points.columns, "c_.cx_", "c_.cy_").join(dealt, [key, "cx_", "cy_"])
    both = both.withColumn("near_", G.segment_point_distance(*[F.col(c) for c in ("px", "py", "x0", "y0", "x1", "y1")]))
    best = both.groupBy("id").agg(F.min(F.struct(F.col("near_.distance").alias("distance"), "seg", F.col("near_.fraction").alias("fraction"))).alias("b"))
    return best.select("id", "b.seg", "b.distance", "b.fraction")


def in_block(numerals: DataFrame, segments: DataFrame, key: str, perp_tol: float, address_tol: float) -> DataFrame:
    """(id, in_block, distance, off) of numerals (id, key, px, py, value): whether the nearest segment of their street is near
    enough and its numbers there, between its ends, come close enough to the value.

    segments: (seg, key, x0, y0, x1, y1, sides array<struct(first, last)>). Sides with an end of the value's parity are
    compared; where there are none, all are.
    """
    best = nearest_segment(numerals.select("id", key, "px", "py"), segments.drop("sides"), key)
    b = best.join(numerals.select("id", "value"), "id").join(segments.select("seg", "sides"), "seg")
    odd = lambda n: F.pmod(n, F.lit(2)) == F.pmod(F.col("value"), F.lit(2))
    same = F.filter("sides", lambda s: odd(s["first"]) | odd(s["last"]))
    some = F.when(F.size(same) > 0, same).otherwise(F.col("sides"))
    off = F.array_min(F.transform(some, lambda s: F.abs(s["first"] + F.col("fraction") * (s["last"] - s["first"]) - F.col("value"))))
    b = b.withColumn("off", off)
    return b.select("id", ((F.col("distance") <= perp_tol) & (F.col("off") <= address_tol)).alias("in_block"), "distance", "off")


def crossings(a: DataFrame, b: DataFrame, cell: float, same: bool = True) -> DataFrame:
    """(key_a, key_b, x, y): points where segments of two keys cross; key pairs that share a stretch have none.

    Segments (key, x0, y0, x1, y1) meet in the grid cells that their boxes cover. same: whether equal keys of a and b are
    one street, which doesn't cross itself.
    """

    def gridded(s: DataFrame, side: str) -> DataFrame:
        cx = F.sequence(F.floor(F.least("x0", "x1") / cell), F.floor(F.greatest("x0", "x1") / cell))
        cy = F.sequence(F.floor(F.least("y0", "y1") / cell), F.floor(F.greatest("y0", "y1") / cell))
        s = s.withColumn("cx", F.explode(cx)).withColumn("cy", F.explode(cy))
        return s.select("cx", "cy", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "x0", "y0", "x1", "y1")])

    both = gridded(a, "a").join(gridded(b, "b"), ["cx", "cy"])
    both = both.filter("key_a <> key_b") if same else both
    ends = [F.col(f"{c}_{s}") for s in ("a", "b") for c in ("x0", "y0", "x1", "y1")]
    both = both.withColumn("p", G.segment_crossing(*ends)).withColumn("flat", G.collinear_overlap(*ends)).filter("p is not null or flat")
    shared = both.filter("flat").select("key_a", "key_b").distinct()
    points = both.filter("p is not null").select("key_a", "key_b", F.round("p.x", 9).alias("x"), F.round("p.y", 9).alias("y")).distinct()
    return points.join(shared, ["key_a", "key_b"], "left_anti")


def ordered_pairs(labels: DataFrame, group: list[str], ord_: str, key: str) -> DataFrame:
    """Pairs of a group's labels, the earlier first, whose keys differ: (group, ord_a, ord_b, key_a, key_b).

    Every pair is a row of the result, so a group of n labels gives up to n^2 / 2; a hot group is split by Spark's skew join.
    """
    a = labels.select(*group, F.col(ord_).alias("ord_a"), F.col(key).alias("key_a"))
    b = labels.select(*group, F.col(ord_).alias("ord_b"), F.col(key).alias("key_b"))
    return a.join(b, group).filter("ord_a < ord_b and key_a <> key_b")


def mutual_edges(edges: DataFrame, opposite: Column) -> DataFrame:
    """(page, side, neighbor) of edges that the neighbour returns on the opposite side, each pair once.

    opposite: the opposite of column `side`.
    """
    e = edges.select("page", "side", "neighbor").distinct()
    back = e.select(F.col("page").alias("neighbor"), F.col("side").alias("back_"), F.col("neighbor").alias("page"))
    return e.filter("page < neighbor").withColumn("back_", opposite).join(back, ["neighbor", "back_", "page"], "left_semi").select("page", "side", "neighbor")


def first_uses(uses: DataFrame) -> DataFrame:
    """(node, page, px, py): the first use of a node on each page. uses: (node, page, ord, px, py)."""
    return uses.groupBy("node", "page").agg(F.min(F.struct("ord", "px", "py")).alias("u")).select("node", "page", "u.px", "u.py")


def seam_ties(uses: DataFrame) -> DataFrame:
    """Pairs of pages that share a node, with the first use on each. uses: (node, page, ord, px, py).

    Every pair is a row of the result; uses are reduced to one a page first, and a hot node is split by Spark's skew join.
    """
    first = first_uses(uses)
    a = first.select("node", F.col("page").alias("page_a"), F.col("px").alias("px_a"), F.col("py").alias("py_a"))
    b = first.select("node", F.col("page").alias("page_b"), F.col("px").alias("px_b"), F.col("py").alias("py_b"))
    return a.join(b, "node").filter("page_a < page_b")


def resolve_pages(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """pages (page) with `key`: the equal key, else the only one equal but for case, one to one both ways.

    An exact match takes its key out of the second round.
    """
    exact = pages.join(keys, pages.page == keys.key, "left_semi").select("page", F.col("page").alias("key"))
    left = pages.join(exact, "page", "left_anti").select("page", F.lower("page").alias("fold"))
    open_ = keys.join(exact, "key", "left_anti").select("key", F.lower("key").alias("fold"))
    one = lambda df, c: df.groupBy("fold").agg(F.min(c).alias(c), F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    folded = one(left, "page").join(one(open_, "key"), "fold").select("page", "key")
    return pages.join(exact.union(folded), "page", "left")


def first_by_priority(rows: DataFrame, key: Column, order: list[str], value: list[str]) -> DataFrame:
    """One row for each key: the first by `order`. Aggregates, so nothing is sorted."""
    picked = rows.groupBy(key.alias("key_")).agg(F.min(F.struct(*order, *[c for c in value if c not in order])).alias("r"))
    return picked.select(*[F.col(f"r.{c}").alias(c) for c in value])


def _folded(rows: DataFrame, place: list[str], name: str) -> DataFrame:
    """A row for each place, with all else of its rows as an array."""
    others = [c for c in rows.columns if c not in place]
    return rows.groupBy(*place).agg(F.collect_list(F.struct(*others)).alias(name))


def covering_boxes(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Points (id, x, y) with the boxes (box, x0, y0, x1, y1) that hold them, borders included, by grid cell.

    Equal points and equal boxes are compared once; every pair of the result is a row.
    """
    cx = F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))
    cy = F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))
    b = _folded(boxes, ["x0", "y0", "x1", "y1"], "b_").withColumn("cx", F.explode(cx)).withColumn("cy", F.explode(cy))
    p = _folded(points, ["x", "y"], "p_").withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    found = p.join(b, ["cx", "cy"]).filter("x between x0 and x1 and y between y0 and y1").drop("cx", "cy")
    found = found.select("*", F.inline("p_")).drop("p_").select("*", F.inline("b_")).drop("b_")
    return found.select(*points.columns, *boxes.columns)


#: Areas that one task holds of a cell, at most, and pairs of boxes and areas that are taken at once.
AREAS, PAIRS = 1 << 18, 1 << 18


def _rounded(v: np.ndarray, digits: int) -> np.ndarray:
    """Half up by the digits that a number is printed with, as Spark rounds."""
    s = v * 10.0**digits
    n = np.floor(s + 0.5)
    for i in np.flatnonzero((np.abs(s - np.floor(s) - 0.5) < 1e-6 + np.abs(s) * 1e-15) | (np.abs(s) > 2.0**51)):
        n[i] = float(Decimal(repr(float(v[i]))).scaleb(digits).to_integral_value(ROUND_HALF_UP))
    return n / 10.0**digits


def _most_shared(a: np.ndarray, b: np.ndarray, rank: np.ndarray, own: np.ndarray, top: int, digits: int, clip: Callable | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, area): the `top` areas b with which each box a shares most, by rounded area, then rank. a, b: x0, y0, x1, y1.

    Areas are gone through from the most that a box could share with them, ties from the highest rank, so a box is done as
    soon as what follows can't be among its top. own: an area's own size; clip(i, j): what pairs share that don't lie one
    within the other, NaN where they don't meet; without it areas are boxes, and those that only touch don't count.
    """
    near, half = (1e-14 if clip is None else 1e-9), 0.5 * 0.1**digits
    reach = [f(v) for f, v in zip((np.min, np.min, np.max, np.max), a, strict=True)]
    bound = lambda w, h, size: np.minimum(w * h, size) * (1 + near) + half / 50
    most = bound(*[np.maximum(np.minimum(reach[k + 2], b[k + 2]) - np.maximum(reach[k], b[k]), 0.0) for k in (0, 1)], own)
    most = np.floor(most * 10.0**digits + 0.5) / 10.0**digits
    by = np.lexsort((-rank, -most))
    b, rank, own, most = b[:, by], rank[by], own[by], most[by]
    least = np.full((2, a.shape[1]), -np.inf)  # rounded area and rank of a box's last among its top
    kept = np.zeros((2, 0), int), np.zeros(0)
    left = np.arange(a.shape[1])

    def beats(size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (size + half > least[0, i]) & ((size - half > least[0, i]) | (rank[j] > least[1, i]))

    def take(i: np.ndarray, j: np.ndarray, area: np.ndarray) -> None:
        nonlocal kept
        better = _rounded(area, digits)
        better = (better > least[0, i]) | ((better == least[0, i]) & (rank[j] > least[1, i]))
        if not better.any():
            return
        at, area = np.concatenate([kept[0], np.stack([i, j])[:, better]], 1), np.concatenate([kept[1], area[better]])
        size = _rounded(area, digits)
        by = np.lexsort((-rank[at[1]], -size, at[0]))
        at, area, size = at[:, by], area[by], size[by]
        first = np.r_[True, at[0, 1:] != at[0, :-1]]
        place = np.arange(len(area)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        last = place == top - 1
        least[:, at[0, last]] = size[last], rank[at[1, last]]
        kept = at[:, place < top], area[place < top]

    begin, step = 0, 64
    while begin < len(own) and len(left):
        end = begin + max(1, min(step, PAIRS // len(left)))
        some, (x0, y0, x1, y1) = b[:, begin:end], a[:, left, None]
        w = np.minimum(x1, some[2]) - np.maximum(x0, some[0])
        h = np.minimum(y1, some[3]) - np.maximum(y0, some[1])
        i, j = np.nonzero((w > 0) & (h > 0) if clip is None else (w >= 0) & (h >= 0))
        w, h, i, j = w[i, j], h[i, j], left[i], j + begin
        can = beats(bound(w, h, own[j]), i, j)
        w, h, i, j = w[can], h[can], i[can], j[can]
        if clip is None:
            some = w * h > 0
            take(i[some], j[some], (w * h)[some])
        else:
            within = (a[0, i] <= b[0, j]) & (b[2, j] <= a[2, i]) & (a[1, i] <= b[1, j]) & (b[3, j] <= a[3, i])
            take(i[within], j[within], own[j[within]])
            can = ~within & beats(bound(w, h, own[j]), i, j)
            i, j = i[can], j[can]
            area = clip(i, by[j])
            some = ~np.isnan(area)
            take(i[some], j[some], area[some])
        begin, step = end, step * 2
        if begin < len(own):
            left = left[(most[begin] > least[0, left]) | ((most[begin] == least[0, left]) & (rank[begin] > least[1, left]))]
    return kept[0][0], by[kept[0][1]], kept[1]


def _top_shared(boxes: DataFrame, areas: DataFrame, group: list[str], cell: float, top: int, digits: int) -> DataFrame:
    """(id, rank, name, area): of each box (group, id, x0, y0, x1, y1) the `top` areas (group, name, bx0, by0, bx1, by1) of its group
    with which it shares most; with (own_, ring) areas are rings.

    A box lies in one cell, that of its lower corner in the grid whose cells are as large as it is: `cell`, doubled as often as
    needed, each way. Areas lie in the cells of the boxes that they can meet, dealt out to parts of bounded size; each part
    gives a box no more than its top. Bounds that are null, NaN or the wrong way round meet nothing.
    """
    sound = lambda lo, hi: (F.col(lo) <= F.col(hi)) & ~F.isnan(F.col(hi) - F.col(lo))
    at = {c: F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "bx0", "by0", "bx1", "by1")}
    rings = "ring" in areas.columns
    ring = [F.col("own_"), F.transform("ring", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))).alias("ring")] if rings else []
    a = boxes.select(*group, "id", *[at[c] for c in ("x0", "y0", "x1", "y1")]).dropna(subset=group).filter(sound("x0", "x1") & sound("y0", "y1"))
    b = areas.select(*group, "name", *[at[c] for c in ("bx0", "by0", "bx1", "by1")], *ring).dropna(subset=group).filter(sound("bx0", "bx1") & sound("by0", "by1"))
    levels, cells = ["lx_", "ly_"], ["cx_", "cy_"]
    size = {c: F.pow(F.lit(2.0), f"l{c}_") * cell for c in "xy"}
    # a little more than its own size, so that rounding never takes a box into a third cell
    a = a.withColumns({f"l{c}_": F.greatest(F.lit(0.0), F.ceil(F.log2((F.col(f"{c}1") - F.col(f"{c}0")) / cell * (1 + 1e-6)))).cast("int") for c in "xy"})
    a = a.withColumns({f"c{c}_": F.floor(F.col(f"{c}0") / size[c]) for c in "xy"})
    parts = -(-areas.select(*group, "name", "bx0").count() // AREAS) or 1
    b = b.withColumn("part_", F.pmod(F.xxhash64("name", "bx0", "by0", "bx1", "by1"), F.lit(parts)))
    b = b.join(F.broadcast(a.select(*levels).distinct()))
    for c in "xy":
        b = b.withColumn(f"c{c}_", F.explode(F.sequence(F.floor(F.col(f"b{c}0") / size[c]) - 1, F.floor(F.col(f"b{c}1") / size[c]))))
    keys = [*group, *levels, *cells]
    b = b.join(a.select(*keys).distinct(), keys, "left_semi")
    a = a.withColumn("part_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    types = {f.name: f.dataType.simpleString() for d in (boxes, areas) for f in d.schema.fields}
    schema = f"id {types['id']}, name {types['name']}, area double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        i = j = np.zeros(0, int)
        area = np.zeros(0)
        if len(left) and len(right):
            corners = lambda t, names: np.stack([t.column(c).to_numpy() for c in names])
            box, of = corners(left, ["x0", "y0", "x1", "y1"]), corners(right, ["bx0", "by0", "bx1", "by1"])
            rank = pd.factorize(right.column("name").to_pandas(), sort=True)[0].astype(float)
            own, clip = (of[2] - of[0]) * (of[3] - of[1]), None
            if rings:
                own, ring = right.column("own_").to_numpy(), right.column("ring").combine_chunks()

                def clip(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                    of = pa.FixedSizeListArray.from_arrays(pa.array(box[:, i].T.ravel()), 4)
                    return G._areas_in_boxes(ring.take(pa.array(j)), of).to_numpy(zero_copy_only=False)

            i, j, area = _most_shared(box, of, rank, own, top, digits, clip)
        return pa.table([left.column("id").take(pa.array(i)), right.column("name").take(pa.array(j)), pa.array(area)], names=["id", "name", "area"])

    keys = [*keys, "part_"]
    b = b.toDF(*b.columns)  # columns of one origin are told apart
    found = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(run, schema).withColumn("area", F.round("area", digits))
    w = Window.partitionBy("id").orderBy(F.desc("area"), F.desc("name"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("id", "rank", "name", "area")


def top_overlaps(a: DataFrame, b: DataFrame, group: list[str], cell: float, top: int = 3, digits: int = 4) -> DataFrame:
    """Of each a the `top` boxes of its group with which it shares most area: (id, rank, name, area), ties to the later name.

    Areas are rounded to `digits` first, so that the last bits of a difference decide no tie. a: (group, id, x0, y0, x1, y1); b: (group,
    name, bx0, by0, bx1, by1). Pairs are held against each other as arrays; none is a row that isn't among the top of its part.
    """
    return _top_shared(a, b.select(*group, "name", "bx0", "by0", "bx1", "by1"), group, cell, top, digits)


def candidates(labels: DataFrame, nodes: DataFrame, group: list[str], ord_: str, key: str) -> DataFrame:
    """Pairs of a sheet's street labels with the crossings of their streets: (group, ord_a, ord_b, px, py, key_a, key_b, x, y).

    labels: (group, ord, key, px, py); nodes: (key_a, key_b, x, y), a crossing under one order of its keys. The pixel is
    where the label that runs along takes its row and the other its column: px of the first, py of the second.
    """
    at = labels.select(*group, ord_, "px", "py")
    pairs = ordered_pairs(labels, group, ord_, key)
    both = pairs.withColumns({"lo_": F.least("key_a", "key_b"), "hi_": F.greatest("key_a", "key_b")})
    n = nodes.select(F.least("key_a", "key_b").alias("lo_"), F.greatest("key_a", "key_b").alias("hi_"), "x", "y").distinct()
    both = both.join(n, ["lo_", "hi_"]).drop("lo_", "hi_")
    both = both.join(at.select(*group, F.col(ord_).alias("ord_a"), "px"), [*group, "ord_a"])
    return both.join(at.select(*group, F.col(ord_).alias("ord_b"), "py"), [*group, "ord_b"])


def window_of_neighbors(edges: DataFrame, centres: DataFrame, ew_m: float = 220.0, ns_m: float = 400.0, least_m: float = 100.0) -> DataFrame:
    """(page, x, y, radius_m): where a page's placed neighbours put its centre, one sheet away; the least radius counts.

    edges: (page, side, neighbor); centres: (neighbor, cx, cy) in projected metres.
    """
    along = F.col("side").isin("left", "right")
    far = F.when(along, ew_m).otherwise(ns_m)
    step = far / G.mercator_scale(F.col("cy"))
    dx = F.when(F.col("side") == "left", step).when(F.col("side") == "right", -step).otherwise(0.0)
    dy = F.when(F.col("side") == "top", -step).when(F.col("side") == "bottom", step).otherwise(0.0)
    near = edges.join(centres, "neighbor").select("page", (F.col("cx") + dx).alias("x"), (F.col("cy") + dy).alias("y"), F.greatest(F.lit(least_m), far / 2).alias("r"))
    return near.groupBy("page").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("r").alias("radius_m"))


def gazetteer_pairs(labels: DataFrame, streets: DataFrame, gazetteer: DataFrame, page: str) -> DataFrame:
    """Labels (page, ord, label) of another kind with a page's street labels (page, ord_s, key), by the groups that a
    gazetteer (label, group_key) binds a label to."""
    bound = labels.join(gazetteer, "label")
    return bound.join(streets, page).select(page, "ord", "ord_s", "group_key", "key")


def locality(crossings_: DataFrame, candidates: DataFrame) -> DataFrame:
    """(key, sheets, distance): upper median over sheets of the least distance from a sheet's crossings to a candidate.

    crossings_: (key, sheet, x, y); candidates: (key, cx, cy).
    """
    d = crossings_.join(candidates, "key").withColumn("d", F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")))
    near = d.groupBy("key", "sheet").agg(F.min("d").alias("d"))
    return near.groupBy("key").agg(F.count(F.lit(1)).alias("sheets"), F.expr("-percentile_disc(0.5) WITHIN GROUP (ORDER BY -d)").alias("distance"))


def rivals(candidates_: DataFrame, key: str, top: int = 4) -> DataFrame:
    """(key, rivals): each key's `top` nearest candidates (name, distance) as one text, ties by name."""
    w = Window.partitionBy(key).orderBy("distance", "name")
    few = candidates_.withColumn("r_", F.row_number().over(w)).filter(F.col("r_") <= top)  # the limit is taken before the shuffle too
    said = F.array_sort(F.collect_list(F.struct("r_", F.format_string("%s (%.1f m)", "name", "distance").alias("t"))))
    return few.groupBy(key).agg(F.array_join(F.transform(said, lambda s: s["t"]), " / ").alias("rivals"))


def superseded(keys: DataFrame, notes: DataFrame, group: list[str]) -> DataFrame:
    """keys (group, key) that a note (group, note) of their group names as a whole word. Words meet by equality."""
    said = notes.select(*group, F.explode(F.split(F.upper("note"), "[^A-Z0-9]+")).alias("w_")).filter("w_ <> ''").distinct()
    first = keys.withColumn("w_", F.regexp_extract(F.upper("key"), "([A-Z0-9]+)", 1))
    near = first.join(said, [*group, "w_"]).join(notes, group)
    # a key of several words has to stand there as a whole
    there = F.contains(F.concat(F.lit(" "), N.clean(F.col("note")), F.lit(" ")), F.concat(F.lit(" "), N.clean(F.col("key")), F.lit(" ")))
    return near.filter(there).select(*keys.columns).distinct()


def best_claims(claims: DataFrame) -> DataFrame:
    """(winner, cell, loser, ink, dist): the best claim on each of a winner's cells, most ink, then nearest, then first."""
    best = claims.groupBy("winner", "cell").agg(F.min(F.struct((-F.col("ink")).alias("i"), "dist", "ord", "loser")).alias("b"))
    return best.select("winner", "cell", "b.loser", (-F.col("b.i")).alias("ink"), "b.dist")


def with_sources(keys: DataFrame, key: str, sources: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """keys with the value of the first source that has one, and that source's name."""
    out = keys
    for n, (_, s) in enumerate(sources):
        out = out.join(s.select(key, F.col(value).alias(f"v{n}_")), key, "left")
    values = [F.col(f"v{n}_") for n in range(len(sources))]
    name = F.coalesce(*[F.when(v.isNotNull(), F.lit(label)) for v, (label, _) in zip(values, sources, strict=True)])
    return out.select(*keys.columns, F.coalesce(*values).alias(value), name.alias("source"))


def required(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows joined to keys, failing on a row without one."""
    joined = rows.join(keys.withColumn("there_", F.lit(True)), key, "left")
    return joined.filter(F.assert_true(F.coalesce("there_", F.lit(False)), F.concat(F.lit("unknown: "), F.col(key).cast("string"))).isNull()).drop("there_")


def shared_share(ours: DataFrame, theirs: DataFrame, floor: float) -> DataFrame:
    """(volume, shared, same, suspect): pages that both have, the share with equal digests, and below the floor the other
    volume that agrees with most of ours. Tables: (volume, page, digest)."""
    t = theirs.withColumnRenamed("volume", "other").withColumnRenamed("digest", "d2")
    both = ours.join(t, "page").withColumn("same", (F.col("digest") == F.col("d2")).cast("int"))
    by = both.groupBy("volume", "other").agg(F.count(F.lit(1)).alias("shared"), F.sum("same").alias("same"))
    own = by.filter("volume = other").select("volume", "shared", (F.col("same") / F.col("shared")).alias("share"))
    best = by.filter("volume <> other and same > 0").groupBy("volume").agg(F.min(F.struct((-F.col("same")).alias("s"), "other")).alias("b"))
    out = own.join(best, "volume", "left")
    return out.select("volume", "shared", "share", F.when(F.col("share") < floor, F.col("b.other")).alias("suspect"))


def area_bounds(features: DataFrame, wanted: DataFrame, buffer: float = 0.01) -> DataFrame:
    """(x0, y0, x1, y1) about all vertices of the named areas and a margin; a name that no area has fails.

    features: (name, x, y), a row for each vertex; wanted: (name). Names are compared without case and outer blanks.
    """
    key = lambda c: F.upper(F.trim(c))
    names = wanted.select(key("name").alias("name")).filter("name <> ''").distinct()
    have = features.select(key("name").alias("name"), "x", "y")
    found = have.join(names, "name", "left_semi").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    missing = names.join(have, "name", "left_anti").agg(F.array_sort(F.collect_list("name")).alias("missing"))  # names of one request
    ok = found.join(missing).filter(F.assert_true(F.size("missing") == 0, F.concat(F.lit("unknown areas: "), F.array_join("missing", ", "))).isNull())
    return ok.select((F.col("x0") - buffer).alias("x0"), (F.col("y0") - buffer).alias("y0"), (F.col("x1") + buffer).alias("x1"), (F.col("y1") + buffer).alias("y1"))


def index_priors(entries: DataFrame, segments: DataFrame, table: DataFrame | None, tolerance: float = 75.0, radius: float = 600.0, width: int = 100) -> DataFrame:
    """(page, x, y, radius_m, entries): where a printed index says that a page lies, in projected metres.

    entries: (id, page, street_key, first, last). The middle of each range is converted (unless table is None, for modern
    numbers) and looked up along the segments of its street (with x0, y0, x1, y1). Where that gives several places, the one
    nearest the centre of the page's entries with one place counts, or of all places. A page whose places lie farther
    apart than the radius has no window; entries without a number or place say nothing.
    """
    middle = entries.withColumn("value", F.floor((F.col("first") + F.col("last")) / 2).cast("int"))
    if table is not None:
        middle = convert_numbers(middle, table, tolerance, width).withColumn("value", F.col("modern").cast("int")).filter("value is not null")
    middle = middle.select("id", "page", "street_key", "value")
    number = ["street_key", "value"]
    hits = match_address(middle.select(*number).distinct(), segments, width)
    along = lambda c: F.col(f"{c}0") + F.col("fraction") * (F.col(f"{c}1") - F.col(f"{c}0"))
    hits = hits.select(*number, along("x").alias("x"), along("y").alias("y"), "seg", "side")
    sums = hits.groupBy(*number).agg(F.count(F.lit(1)).alias("n_"), F.sum("x").alias("sx_"), F.sum("y").alias("sy_"))
    many = middle.join(sums, number)
    twice = many.groupBy("page", "id").agg(*[F.sum(c).alias(c) for c in ("n_", "sx_", "sy_")])
    one = F.col("n_") == 1
    centre = twice.groupBy("page").agg(*[F.coalesce(F.avg(F.when(one, F.col(f"s{c}_"))), F.sum(f"s{c}_") / F.sum("n_")).alias(f"c{c}_") for c in "xy"])
    places = hits.groupBy(*number, "x", "y").agg(F.min(F.struct("seg", "side")).alias("s_")).select(*number, "x", "y", "s_.seg", "s_.side")
    picked = _nearest_places(many.select("id", "page", *number).join(centre, "page"), places, number)
    picked = picked.groupBy("page", "id").agg(F.min(F.struct("d_", "seg", "side", "x", "y")).alias("b")).select("page", "id", "b.x", "b.y")
    places = picked.groupBy("page").agg(F.collect_list(F.struct("x", "y")).alias("p_"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("entries"))  # a page's entries
    apart = F.exists("p_", lambda a: F.exists("p_", lambda b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]) > radius))
    return places.filter(~apart).select("page", "x", "y", (radius * G.mercator_scale(F.col("y"))).alias("radius_m"), "entries")


#: Distances taken at once.
AT_ONCE = 1 << 20


def _nearest_places(entries: DataFrame, places: DataFrame, number: list[str]) -> DataFrame:
    """(page, id, d_, seg, side, x, y): of the places of an entry's number that nearest the entry's (cx_, cy_), ties to the
    first seg and side. Distances are taken as arrays, so no row is made for an entry and a place."""
    types = {f.name: f.dataType.simpleString() for d in (entries, places) for f in d.schema.fields}
    out = ["page", "id", "d_", "seg", "side", "x", "y"]

    def run(e: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["seg", "side"], kind="stable")
        of = p.groupby(number).indices
        found = []
        for key, at in e.groupby(number).indices.items():
            if key not in of:
                continue
            some, own = p.iloc[of[key]], e.iloc[at]
            x, y = some.x.to_numpy(), some.y.to_numpy()
            cx, cy = own.cx_.to_numpy(), own.cy_.to_numpy()
            step = max(1, AT_ONCE // len(x))
            near = np.concatenate([np.argmin((x - cx[k : k + step, None]) ** 2 + (y - cy[k : k + step, None]) ** 2, axis=1) for k in range(0, len(cx), step)])
            got = some.iloc[near]
            found.append(pd.DataFrame({"page": own.page.to_numpy(), "id": own.id.to_numpy(), "d_": np.hypot(x[near] - cx, y[near] - cy), **{c: got[c].to_numpy() for c in ("seg", "side", "x", "y")}}))
        return pd.concat(found) if found else pd.DataFrame(columns=out)

    some = lambda d: d.withColumn("some_", F.floor(F.col(number[1]) / 256)).groupBy(number[0], "some_")  # noqa: E731 - some numbers at a time
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in out)
    return some(entries).cogroup(some(places.toDF(*places.columns))).applyInPandas(run, schema)  # columns of one origin are told apart


def street_positions(segments: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, at): where the segments of a line's street cross it: the mean of the distinct points, or the middle of what lies
    along the line, by length. segments: (key, x0, y0, x1, y1); lines: (id, key, y), lines of one latitude."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    both = segments.join(lines, "key").filter(F.col("y").between(low, high))
    flat = F.col("y0") == F.col("y1")
    x = F.when(~flat, F.col("x0") + (F.col("y") - F.col("y0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0)) * (F.col("x1") - F.col("x0")))
    points = both.filter(~flat).select("id", F.round(x, 9).alias("x")).distinct().groupBy("id").agg(F.avg("x").alias("point"))
    length = F.abs(F.col("x1") - F.col("x0"))
    along = both.filter(flat & (length > 0)).groupBy("id").agg((F.sum((F.col("x0") + F.col("x1")) / 2 * length) / F.sum(length)).alias("middle"))
    return points.join(along, "id", "full").select("id", F.coalesce("middle", "point").alias("at"))


def seam_mismatches(ties: DataFrame, shifts: DataFrame, volume: str) -> DataFrame:
    """(volume, page_a, page_b, before, after): how far tied pages are apart before and after their shifts (page, dx, dy)."""
    s = lambda side: shifts.select(volume, F.col("page").alias(f"page_{side}"), F.col("dx").alias(f"dx_{side}"), F.col("dy").alias(f"dy_{side}"))
    t = ties.join(s("a"), [volume, "page_a"]).join(s("b"), [volume, "page_b"])
    after = F.hypot(F.col("gap_x") + F.col("dx_b") - F.col("dx_a"), F.col("gap_y") + F.col("dy_b") - F.col("dy_a"))
    return t.select(volume, "page_a", "page_b", F.hypot("gap_x", "gap_y").alias("before"), after.alias("after"))


def top_areas(boxes: DataFrame, areas: DataFrame, cell: float, top: int = 3, digits: int = 6) -> DataFrame:
    """Of each box (id, x0, y0, x1, y1) the `top` areas (name, ring array<struct(x, y)>) with which it shares most: (id, rank,
    name, area), ties to the later name. Areas that only touch a box count with 0, last; all are rounded to `digits` first, so
    that equal ones are. What lies within a box counts whole; of the others those are clipped that could still be among the
    top, as no area shares more than its own and what the bounds share. No pair is a row that isn't among the top of its part.
    """
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    a = areas.select("name", "ring", F.array_min(xs).alias("bx0"), F.array_min(ys).alias("by0"), F.array_max(xs).alias("bx1"), F.array_max(ys).alias("by1"))
    a = a.withColumn("own_", G.area_in_box(F.col("ring"), F.array("bx0", "by0", "bx1", "by1")))
    return _top_shared(boxes, a, [], cell, top, digits)
