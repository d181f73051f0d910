"""Joins whose rows repeat: work by what differs, results for every row."""

import random
import threading

from pyspark.sql import functions as F

from plumbline.operators import aggs as A
from plumbline.operators import joins as J


def test_equal_numbers_are_looked_up_once(spark, monkeypatch):
    seen = []
    plain = J.range_join
    monkeypatch.setattr(J, "range_join", lambda points, *a: seen.append(points.count()) or plain(points, *a))
    t = spark.createDataFrame([(1, "K", 1, 99, 101, 199), (2, "K", 1, 50, 300, 251), (3, "K", 90, 99, 191, 200)], "ord int, street_key string, old_first int, old_last int, new_first int, new_last int")
    n = spark.range(3000).select("id", F.when(F.col("id") % 4 < 3, "K").alias("street_key"), F.when(F.col("id") % 4 < 2, F.lit(95)).when(F.col("id") % 4 == 2, 7).alias("value"))
    got = J.convert_numbers(n, t, 75.0).groupBy("street_key", "value", "modern").count().collect()
    assert sorted(map(tuple, got), key=str) == [("K", 7, None, 750), ("K", 95, 195, 1500), (None, None, None, 750)]
    assert seen == [3]


def test_contradictions_among_many_copies(spark):
    """Against all pairs; then more copies than can be paired."""
    r = random.Random(5)
    rows = [(i if i % 50 else 0, r.choice("AB"), lo := r.randrange(0, 3000, 20), lo + r.randrange(-1, 150), lo + r.choice([7, 7, 7, 7, 7, 7, 7, 7, 10, 13])) for i in range(600)]
    e = spark.createDataFrame([*rows, (900, None, 1, 5, 9), (901, "A", None, 5, 9)], "id int, street string, old_lo int, old_hi int, new_lo int")
    bad = {a[0] for a in rows for b in rows if a[0] != b[0] and a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3] and abs(a[4] - a[2] - b[4] + b[2]) > 4}
    got = sorted(x.id for x in A.agreeing_ranges(e, 100).collect())
    assert any(a[2] > a[3] for a in rows) and 0 < len(bad) < 600 and got == sorted([a[0] for a in rows if a[0] not in bad] + [900, 901])
    many = spark.range(400_000).select("id", F.lit("A").alias("street"), F.lit(5).alias("old_lo"), F.lit(80).alias("old_hi"), (F.col("id") % 4).alias("new_lo"))
    timer = threading.Timer(60, spark.sparkContext.cancelAllJobs)  # 1.6e11 pairs took hours
    timer.start()
    assert A.agreeing_ranges(many, 100).count() == 400_000
    timer.cancel()


def test_entries_with_one_number_share_its_places(spark, monkeypatch):
    seen = []
    plain = J.match_address
    monkeypatch.setattr(J, "match_address", lambda numerals, *a: seen.append(numerals.count()) or plain(numerals, *a))
    text = lambda v: F.lit(v).cast("string")
    x = (F.col("id") % 7 * 10.0)
    s = spark.range(70).select(
        F.col("id").alias("seg"), F.lit("K").alias("street_key"), F.when(F.col("id") == 0, "300").otherwise("100").alias("l_from"), F.when(F.col("id") == 0, "398").otherwise("198").alias("l_to"),
        text(None).alias("r_from"), text(None).alias("r_to"), F.lit("E").alias("l_parity"), text(None).alias("r_parity"), x.alias("x0"), F.lit(5.0).alias("y0"), x.alias("x1"), F.lit(5.0).alias("y1"),
    )
    # each page has an entry with one place, at x = 0, and one with many, the nearest of which is there too
    e = spark.range(4000).select("id", F.floor(F.col("id") / 2).alias("page"), F.lit("K").alias("street_key"), *[F.when(F.col("id") % 2 == 0, 350).otherwise(150).alias(c) for c in ("first", "last")])
    got = J.index_priors(e, s, None, radius=250.0).groupBy("x", "y", "entries").count().collect()
    assert [tuple(r) for r in got] == [(0.0, 5.0, 2, 2000)] and seen == [2]


def test_equal_points_and_boxes_are_compared_once(spark):
    p = spark.range(3000).select("id", (F.col("id") % 3 * 10.0).alias("x"), F.lit(1.0).alias("y"))
    b = spark.range(2000).select(F.col("id").alias("box"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") % 2 * 10.0).alias("x1"), F.lit(1.0).alias("y1"))
    out = J.covering_boxes(p, b, 100.0)
    assert out.groupBy("x").count().collect() and {r.x: r["count"] for r in out.groupBy("x").count().collect()} == {0.0: 2000 * 1000, 10.0: 1000 * 1000}
    assert out.select("id", "box").distinct().count() == out.count()
    assert spark.createDataFrame([], "id int, x double, y double").transform(lambda e: J.covering_boxes(e, b, 100.0)).count() == 0
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 2


def test_equal_numbers_and_frontages_meet_once(spark, monkeypatch):
    """Against all pairs, equal segments dealt out to parts; repeated rows stay."""
    seen = []
    plain = J.range_join
    monkeypatch.setattr(J, "range_join", lambda points, ranges, *a: seen.append((points.count(), ranges.count())) or plain(points, ranges, *a))
    monkeypatch.setattr(J, "FRONTAGES", 7)
    ends = [("100", "198", "199", "101", "E", None), ("300", "300", None, "5", None, None), ("198", "100", "1", "", "o", "E")]
    segments = [(0 if i < 9 else i, "K" if i % 5 else None, *ends[i % 3]) for i in range(90)]
    s = spark.createDataFrame(segments, "seg int, street_key string, l_from string, l_to string, r_from string, r_to string, l_parity string, r_parity string")
    numerals = [(i // 2, "K" if i % 10 else None, [101, 102, 300, 150, 999, None][i % 6]) for i in range(120)]
    n = spark.createDataFrame(numerals, "id int, street_key string, value int")
    want = []
    for i, street, v in numerals:
        for seg, other, lf, lt, rf, rt, lp, rp in segments:
            for side, a, b, parity in (("l", lf, lt, lp), ("r", rf, rt, rp)):
                if street and street == other and v and a and b and min(int(a), int(b)) <= v <= max(int(a), int(b)) and (parity or "").upper() in ("", "OE"[v % 2 == 0]):
                    want.append((i, v, seg, side, round(0.5 if a == b else (v - int(a)) / (int(b) - int(a)), 3)))
    got = J.match_address(n, s, digits=3)
    assert sorted(map(tuple, got.select("id", "value", "seg", "side", "fraction").collect())) == sorted(want) and len({w[4] for w in want}) == 5
    assert seen == [(6 + 3, 4 + 4)]  # of K and of no street
    assert got.columns[:3] == ["street_key", "id", "value"] and set(s.columns) < set(got.columns)
