import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins as J
from plumbline.operators import rescue as R
from plumbline.operators import stages as T

SCALE = 0.067


def points(rows, rotation=0.0, at=(1000.0, 2000.0)):
    """rows: (px, py, streets, stray metres)."""
    c, s = math.cos(math.radians(rotation)) * SCALE, math.sin(math.radians(rotation)) * SCALE
    world = [(at[0] + c * x + s * y + off, at[1] + s * x - c * y) for x, y, _, off in rows]
    return R.Points(np.array([(x, y) for x, y, _, _ in rows], float), np.array(world), [frozenset(s) for _, _, s, _ in rows])


A, B, C, X = ("ELM", "OAK"), ("ASH", "MILL"), ("ELM", "MILL"), ("RR X", "ELM")


def test_a_cluster_is_found_at_the_pinned_rotation():
    how, angle, shift, own = R.rescued(points([(0, 0, A, 0), (5000, 900, B, 3), (300, 4000, C, 500)]), SCALE, 0.0)
    assert (how, angle, own) == ("pinned", 0.0, [0, 1]) and np.allclose(shift, (1001.5, 2000))
    assert R.rescued(points([(0, 0, A, 0), (5000, 900, B, 30)]), SCALE, 0.0) is None
    # one pair of streets, or one pixel, is no independent evidence
    assert R.rescued(points([(0, 0, A, 0), (5000, 900, A, 0)]), SCALE, 0.0) is None
    assert R.rescued(points([(0, 0, A, 0), (0.2, 0.3, B, 0)]), SCALE, 0.0) is None
    assert R.rescued(points([]), SCALE, 0.0) is None


def test_railways_do_not_evict():
    shared = [(0, 0, X, 500), (4000, 0, ("RR X", "OAK"), 500), (0, 4000, ("RR X", "ASH"), 500)]
    p = points([(100, 100, A, 0), (5000, 900, B, 0), *shared])
    assert R.pinned_fit(p, SCALE, 0.0)[1] == [0, 1]  # three of one railway against two that share nothing
    assert R.pinned_fit(points(shared), SCALE, 0.0)[1] == [0, 1, 2]  # but they are taken where nothing else is
    apart = [*shared, (4000, 4000, ("RR Y", "ASH"), 500)]
    assert len(R.pinned_fit(points([(100, 100, A, 0), (5000, 900, B, 0), *apart]), SCALE, 0.0)[1]) == 4


def test_own_grid_and_quadrants():
    rows = [(0, 0, A, 0), (5000, 900, B, 0), (300, 4000, C, 0)]
    p = points(rows, 30.0)
    assert R.rescued(p, SCALE, 0.0) is None
    assert R.rescued(p, SCALE, 0.0, own=30.0)[:2] == ("own grid", 30.0)
    assert R.rescued(points(rows, 210.0), SCALE, 0.0, own=30.0)[:2] == ("own grid", 210.0)
    assert R.rescued(points(rows[:2], 30.0), SCALE, 0.0, own=30.0) is None  # two are too few there
    same = [(0, 0, A, 0), (5000, 900, C, 0), (300, 4000, ("ELM", "ASH"), 0)]
    assert R.rescued(points(same, 30.0), SCALE, 0.0, own=30.0) is None  # and three that share a street
    assert R.rescued(p, SCALE, 29.0, own=30.0)[0] == "pinned" if R.pinned_fit(p, SCALE, 29.0) else R.own_grid_pin(30.0, 29.0) is None
    assert R.own_grid_pin(90.0, 0.0) == 90.0 and R.own_grid_pin(181.0, 0.0) is None and R.own_grid_pin(None, 0.0) is None
    assert R.rescued(points(rows, 180.0), SCALE, 0.0, quadrants=True)[:2] == ("quadrant", 180.0)
    assert R.rescued(points(rows, 180.0), SCALE, 0.0) is None


@pytest.mark.parametrize("seed", range(4))
def test_clusters_against_all_subsets(seed):
    """Without railways the cluster is the largest ball of offsets about one of them."""
    r = random.Random(seed)
    p = points([(r.randrange(6000), r.randrange(6000), (f"S{r.randrange(9)}", f"T{r.randrange(9)}"), r.choice([0, 4, 9, 14, 60, 70])) for _ in range(14)])
    offsets = p.offsets(SCALE, 0.0)
    balls = [[j for j in range(14) if math.dist(offsets[i], offsets[j]) <= R.TOL_M] for i in range(14)]
    best = max(balls, key=len)
    found = R.pinned_fit(p, SCALE, 0.0)
    assert (found[1] if found else None) == (best if p.independent(best) else None)


def test_records(spark):
    p = points([(0, 0, A, 0), (5000, 900, B, 3)])
    q = points([(0, 0, A, 0), (5000, 900, C, 3)])
    rows = [(1, page, i, *map(float, (*k.pixel[i], *k.world[i])), *sorted(k.streets[i])) for page, k in ((1, p), (2, q), (4, p), (5, p)) for i in (1, 0)]
    cands = spark.createDataFrame(rows, "v int, page int, ord int, px double, py double, x double, y double, street_a string, street_b string")
    records = [(1, 1, T.REJECTED), (1, 2, T.REJECTED), (1, 3, T.REJECTED), (1, 4, "OK"), (1, 5, T.REVOKED), (2, 6, T.REJECTED), (1, 7, None)]
    df = spark.createDataFrame([(*x, SCALE, 0.0, None) for x in records], "v int, page int, status string, scale double, rotation double, own_rotation double")
    got = {x.page: (x.status, x.how, x.anchors) for x in R.rescue(df, cands, "v", "page").collect()}
    assert got == {1: (T.RESCUED, "pinned", 2), 2: (T.REVOKED, "pinned", 2), 3: (T.REJECTED, None, 0), 4: ("OK", None, 0), 5: (T.REVOKED, None, 0), 6: (T.REJECTED, None, 0), 7: (None, None, 0)}
    old = spark.createDataFrame([(1, T.RESCUED, [["a", "b"], ["a", "c"]]), (2, T.RESCUED, [["a", "b"], ["c", "d"]]), (3, T.RESCUED, []), (4, "OK", [["a", "b"]]), (5, T.RESCUED, None)], "page int, status string, anchors array<array<string>>")
    assert {x.page: x.status for x in R.revoke_shared(old, "anchors").collect()} == {1: T.REVOKED, 2: T.RESCUED, 3: T.RESCUED, 4: "OK", 5: T.RESCUED}


def test_export_is_all_or_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    records = spark.createDataFrame([("1", "OK"), ("2", T.RESCUED), ("3", T.REJECTED)], "page string, status string")
    services = spark.createDataFrame([("1", "a"), ("2", "b")], "page string, service string")
    assert T.staged_export(records, services, "page", folder) == 2
    assert T.staged_export(records.filter("page = '1'"), services, "page", folder) == 1
    assert [x.page for x in spark.read.json(folder).collect()] == ["1"]
    with pytest.raises(Exception, match="unknown: 2"):
        T.staged_export(records, services.filter("page = '1'"), "page", folder)
    assert [x.page for x in spark.read.json(folder).collect()] == ["1"]


def test_unknown_areas_fail(spark):
    f = spark.createDataFrame([("Lake", 1.0, 2.0), ("lake", 3.0, 1.0), ("Hill", 9.0, 9.0)], "name string, x double, y double")
    w = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    assert tuple(J.area_bounds(f, w(" LAKE ", ""), 0.5).first()) == (0.5, 0.5, 3.5, 2.5)
    with pytest.raises(Exception, match="unknown areas: MOOR"):
        J.area_bounds(f, w("lake", "moor")).collect()


def test_priors_prefer_entries_with_one_place(spark):
    text = "string"
    s = spark.createDataFrame([(1, "A", "100", "198", 0.0, 0.0, 100.0, 0.0), (2, "A", "100", "198", 5000.0, 0.0, 5100.0, 0.0), (3, "B", "200", "298", 0.0, 50.0, 0.0, 150.0)], f"seg int, street_key {text}, l_from {text}, l_to {text}, x0 double, y0 double, x1 double, y1 double")
    s = s.withColumns({c: F.lit(None).cast("string") for c in ("r_from", "r_to", "l_parity", "r_parity")})
    e = spark.createDataFrame([(1, "p", "A", 140, 160), (2, "p", "B", 240, 250), (3, "q", "A", 140, 160), (4, "r", "C", 1, 9), (5, "s", "B", 240, 250)], "id int, page string, street_key string, first int, last int")
    got = {x.page: x for x in J.index_priors(e, s, None).collect()}
    assert got.keys() == {"p", "q", "s"} and got["p"].entries == 2 and got["p"].x < 100 and got["s"].entries == 1
    t = spark.createDataFrame([(1, "B", 240, 250, 260, 270)], "ord int, street_key string, old_first int, old_last int, new_first int, new_last int")
    assert [(x.page, x.entries) for x in J.index_priors(e, s, t).orderBy("page").collect()] == [("p", 1), ("s", 1)]
    far = spark.createDataFrame([(1, "p", "A", 140, 160), (2, "p", "B", 240, 250)], e.schema)
    assert J.index_priors(far, s.withColumn("x0", F.col("x0") + F.when(F.col("seg") == 3, 900).otherwise(0)), None, radius=300.0).count() == 0
