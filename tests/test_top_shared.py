"""The areas that boxes share most with, without a row for each pair."""

import random
import threading
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins as J


def ranked(found: list[tuple], top: int) -> list[tuple]:
    """(id, area, name) in order, no name last."""
    out = []
    for i in {f[0] for f in found}:
        mine = sorted((f for f in found if f[0] == i), key=lambda f: (f[1], f[2] is not None, f[2] or ""), reverse=True)
        out += [(i, k + 1, f[2], f[1]) for k, f in enumerate(mine[:top])]
    return sorted(out, key=str)


@pytest.fixture
def soon(spark):
    """All pairs took minutes."""
    timer = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    timer.start()
    yield
    timer.cancel()


def test_overlaps_equal_those_of_all_pairs(spark, monkeypatch):
    """Boxes of many sizes, in parts; ties, repeated ids, no name, no group, and bounds that meet nothing."""
    monkeypatch.setattr(J, "AREAS", 90)
    r = random.Random(7)
    at = lambda w: (x := r.randrange(-60, 60) / 4, y := r.randrange(-60, 60) / 4, x + r.choice(w), y + r.choice(w))
    boxes = [(r.choice("AB"), i // 2, *at([0.0, 1.0, 2.5, 9.0, 40.0])) for i in range(80)]
    areas = [(r.choice("AB"), None if i % 11 == 0 else f"n{i % 90}", *at([0.0, 0.5, 2.0, 2.0, 30.0])) for i in range(250)]
    odd = [(None, 0.0, 0.0, 9.0, 9.0), ("A", None, 0.0, 9.0, 9.0), ("A", float("nan"), 0.0, 9.0, 9.0), ("A", 0.0, 0.0, float("nan"), 9.0), ("A", 9.0, 0.0, 0.0, 9.0)]
    a = spark.createDataFrame(boxes + [(g, 900, *o) for g, *o in odd], "g string, id int, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame(areas + [(g, "odd", *o) for g, *o in odd], "g string, name string, bx0 double, by0 double, bx1 double, by1 double")
    found = []
    for g, i, x0, y0, x1, y1 in boxes:
        for h, name, bx0, by0, bx1, by1 in areas:
            area = max(min(x1, bx1) - max(x0, bx0), 0) * max(min(y1, by1) - max(y0, by0), 0)
            if g == h and area > 0:
                found.append((i, float(Decimal(repr(area)).quantize(Decimal("0.1"), ROUND_HALF_UP)), name))
    got = J.top_overlaps(a, b, ["g"], 2.0, 4, 1)
    assert sorted(map(tuple, got.collect()), key=str) == ranked(found, 4) and len(found) > 500


def test_equal_boxes_and_areas_are_not_paired(spark, soon):
    box = [F.lit(v).alias(c) for c, v in {"x0": 0.0, "y0": 0.0, "x1": 8.0, "y1": 10.0}.items()]
    area = [(F.col("id") % 7 * 0.5).alias("bx0"), F.lit(0.0).alias("by0"), (F.col("id") % 7 * 0.5 + 5.0).alias("bx1"), F.lit(12.0).alias("by1")]
    name = F.format_string("n%06d", "id").alias("name")
    got = J.top_overlaps(spark.range(40_000).select(F.lit(1).alias("g"), "id", *box), spark.range(40_000).select(F.lit(1).alias("g"), name, *area), ["g"], 500.0)
    assert sorted(map(tuple, got.groupBy("rank", "name", "area").count().collect())) == [(1, "n039999", 50.0, 40_000), (2, "n039998", 50.0, 40_000), (3, "n039997", 50.0, 40_000)]


def test_polygons_are_not_paired_with_all_boxes_about_them(spark, soon):
    """Triangles, most of which lie within each box."""
    box = [F.lit(v).alias(c) for c, v in {"x0": 0.0, "y0": 0.0, "x1": 60.0, "y1": 20.0}.items()]
    x = F.col("id") % 53
    corner = lambda i, j: F.struct((x + i).cast("double").alias("x"), F.lit(float(j)).alias("y"))
    rings = spark.range(40_000).select(F.format_string("n%06d", "id").alias("name"), F.array(corner(0, 0), corner(10, 0), corner(0, 10)).alias("ring"))
    got = J.top_areas(spark.range(20_000).select("id", *box), rings, 50.0)
    want = [f"n{i:06d}" for i in range(39_999, 39_900, -1) if i % 53 <= 50][:3]
    assert sorted(map(tuple, got.groupBy("rank", "name", "area").count().collect())) == [(k + 1, n, 50.0, 20_000) for k, n in enumerate(want)]


def test_numbers_are_rounded_as_spark_rounds(spark):
    r = random.Random(1)
    v = [0.5 * round(r.uniform(0, 9), 3) ** 2 for _ in range(2000)] + [2.5e-7, 1e13 + 0.25, 0.0]
    want = [x[0] for x in spark.createDataFrame([(float(x),) for x in v], "v double").select(F.round("v", 6)).collect()]
    assert J._rounded(np.array(v), 6).tolist() == want
