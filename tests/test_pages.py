import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import geometry as G
from plumbline.functions.rows import row_class
from plumbline.operators import joins as J
from plumbline.operators import kernels as K
from plumbline.operators import sequences as S
from plumbline.operators.stitching import adopt_siblings


def test_row_classes(spark):
    said = [
        (["101", "55"], ("pair", 101, 55)), (["101 S 55w"], ("pair", 101, 55)), (["14000", "5"], ("junk", None, None)), (["0", "5"], ("junk", None, None)), (["7S"], ("lone", 7, None)), (["1", "2", "3"], ("multi", None, None)),
        (["New", "Old"], ("label", None, None)), (["Even", "Nos. cont"], ("label", None, None)), (["Nos."], ("header", None, None)), (["cont 5"], ("header", None, None)), (["to, to"], ("to", None, None)), (["\u201d", "''"], ("ditto", None, None)),
        ([""], ("junk", None, None)), (["5", "x"], ("lone", 5, None)), (["123456"], ("junk", None, None)), (["5 S S"], ("lone", 5, None)), (["(5)", "|6!"], ("pair", 5, 6)),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(said)], "i int, t array<string>").select("i", row_class(F.col("t")).alias("r")).orderBy("i")
    got = [r.r for r in df.collect()]
    assert [(r.kind, r.new, r.old) for r in got] == [w for _, w in said]
    assert (got[1].new_suffix, got[1].old_suffix) == ("S", "W") and (got[7].parity, got[7].cont) == ("even", True)


def test_siblings(spark):
    rows = [
        (1, 1, 0, "", "odd", [1], 100, 300, 40), (1, 1, 1, "ELM", "even", [2], 102, 302, 40), (1, 2, 2, "", "odd", [1], 100, 300, 29), (1, 2, 3, "ELM", "even", [2], 102, 302, 40),
        (1, 3, 4, "", "odd", [1], 100, 300, 40), (1, 3, 5, "ELM", "even", [2], 102, 302, 40), (1, 3, 6, "OAK", "even", [0], 102, 302, 40), (1, 4, 7, "", "odd", [1, 5], 100, 300, 40), (1, 4, 8, "ELM", "even", [2], 102, 302, 40),
        # a chain that gets its name is a twin of a later one
        (2, 1, 0, "ASH", "even", [2], 100, 300, 40), (2, 1, 1, "", "odd", [3], 100, 300, 40), (2, 1, 2, "", "even", [4], 100, 300, 40), (2, 1, 3, "", "odd", [9], 900, 999, 40),
    ]
    df = spark.createDataFrame(rows, "book int, page int, chain int, street string, parity string, strips array<int>, lo int, hi int, n int").repartition(3)
    got = {(r.book, r.chain): r.street for r in adopt_siblings(df, "book").collect() if r.adopted}
    assert got == {(1, 0): "ELM", (2, 1): "ASH", (2, 2): "ASH"}


def test_drawn_samples_replay(spark):
    pool = {"a": list(range(0, 60)), "b": list(range(100, 109)), "c": [7]}
    df = spark.createDataFrame([(k, v, str(v)) for k, vs in pool.items() for v in reversed(vs)], "s string, n int, t string")
    got = S.drawn(df, "s", ["n"], [("b", 4), ("a", 9)], 5).orderBy("s", "draw").collect()
    assert [r.n for r in got] == random.Random(6).sample(pool["a"], 9) + random.Random(5).sample(pool["b"], 4)
    with pytest.raises(ValueError, match="c: 1 rows"):
        S.drawn(df, "s", ["n"], [("c", 2)], 5)


def test_polygons_in_boxes(spark):
    """Areas of rings that aren't convex, against points on a grid."""
    rings = [[(0, 0), (8, 0), (8, 8), (4, 2), (0, 8)], [(1, 1), (9, 5), (1, 9), (3, 5)], [(0, 0), (2, 0), (2, 2), (0, 2)]]
    boxes = [(0, 1, 1, 7, 6), (1, -5, -5, 20, 20), (2, 2, 0, 4, 4), (3, 30, 30, 31, 31), (4, 3, 3, 5, 9)]
    r = spark.createDataFrame([(f"r{i}", [{"x": float(x), "y": float(y)} for x, y in ring]) for i, ring in enumerate(rings)], "name string, ring array<struct<x: double, y: double>>")
    b = spark.createDataFrame([(i, *map(float, v)) for i, *v in boxes], "id int, x0 double, y0 double, x1 double, y1 double")
    got = {(x.id, x.name): x.area for x in J.top_areas(b, r, 3.0, 9).collect()}
    step = 0.02
    gx, gy = np.meshgrid(np.arange(-1, 10, step) + step / 2, np.arange(-1, 10, step) + step / 2)
    for n, ring in enumerate(rings):
        inside = np.zeros(gx.shape, bool)
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            if y0 != y1:
                inside ^= ((y0 > gy) != (y1 > gy)) & (gx < (x1 - x0) * (gy - y0) / (y1 - y0) + x0)
        for i, x0, y0, x1, y1 in boxes:
            want = (inside & (gx > x0) & (gx < x1) & (gy > y0) & (gy < y1)).sum() * step**2
            assert abs(got.get((i, f"r{n}"), 0) - want) < 0.4, (i, n)
    assert got[2, "r2"] == 0 and (3, "r0") not in got
    two = {(x.id, x.rank): x.name for x in J.top_areas(b, r, 3.0, 2).collect()}
    assert two[1, 1] == "r0" and two[1, 2] == "r1" and (1, 3) not in two
    assert spark.range(1).select(G.area_in_box(F.array().cast("array<struct<x: double, y: double>>"), F.array(*[F.lit(1.0)] * 4)).alias("a")).first().a is None


def test_masks_are_clipped_to_a_margin_about_the_hull():
    mask = np.array([(0, 0), (100, 0), (100, 100), (0, 100.0)])
    points = np.array([(20, 20), (60, 20), (60, 70), (20, 70), (40, 40.0)])
    out = K.polygon_area(K.clipped_to_hull(mask, points, 10.0))
    assert abs(out - (40 * 50 + 2 * 10 * 90 + np.pi * 100)) < 2  # rectangle, strips and round corners
    assert K.polygon_area(K.clipped_to_hull(mask, points + 35, 10.0)) < out
    assert K.clipped_to_hull(mask, points[:2], 10.0) is mask and K.clipped_to_hull(mask, points + 1000, 10.0) is mask


def test_mismatches_shrink(spark):
    ties = spark.createDataFrame([(1, "a", "b", 4.0, 0.0), (1, "b", "c", 0.0, 2.0)], "v int, page_a string, page_b string, gap_x double, gap_y double")
    shifts = K.seam_solve(ties, "v")
    d = {r.page: (r.dx, r.dy) for r in shifts.collect()}
    for r in J.seam_mismatches(ties, shifts, "v").collect():
        gap = (4.0, 0.0) if r.page_a == "a" else (0.0, 2.0)
        assert r.before == np.hypot(*gap) and r.after == pytest.approx(np.hypot(*(g + d[r.page_b][i] - d[r.page_a][i] for i, g in enumerate(gap)))) and r.after < r.before
