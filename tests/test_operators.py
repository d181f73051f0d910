"""Join, aggregate, sequence, stage and source operators on small hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions.names import signed
from plumbline.operators import aggs as A
from plumbline.operators import joins as J
from plumbline.operators import sequences as S
from plumbline.operators import stages as T
from plumbline.sources import documents as D


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_range_join_keeps_both_ends_and_empty_ranges_hold_nothing(spark):
    p = spark.createDataFrame([("k", 100), ("k", 199), ("k", 200), ("x", 150), (None, 150)], "key string, v int")
    r = spark.createDataFrame([("k", 100, 200, 1), ("k", 200, 100, 2), ("k", 199, 199, 3)], "key string, lo int, hi int, id int")
    assert rows(J.range_join(p, r, ["key"], "v", "lo", "hi", 50), "v", "id") == [(100, 1), (199, 1), (199, 3), (200, 1)]


def test_renumbering(spark):
    t = spark.createDataFrame([(1, "A", 100, 198, 1000, 1098), (2, "A", 198, 100, 5000, 5098), (3, "B", 10, 20, 110, 120), (4, "B", 10, 20, 112, 122)], "ord int, street_key string, old_first int, old_last int, new_first int, new_last int")
    n = spark.createDataFrame([(1, "A", 120), (2, "B", 15), (3, "B", 99), (4, "C", 15)], "id int, street_key string, value int")
    assert rows(J.convert_numbers(n, t, 75.0), "id", "modern") == [(1, None), (2, 115), (3, None), (4, None)]


def test_addresses_take_parity_and_both_sides(spark):
    s = spark.createDataFrame([(1, "K", "101", "199", "100", "198", "O", "E"), (2, "K", "5", "5", "", "x", None, None)], "seg int, street_key string, l_from string, l_to string, r_from string, r_to string, l_parity string, r_parity string")
    n = spark.createDataFrame([("K", 101), ("K", 198), ("K", 150), ("K", 5)], "street_key string, value int")
    got = rows(J.match_address(n, s).select("value", "seg", "side", F.round("fraction", 3)))
    assert got == [(101, 1, "l", 0.0), (150, 1, "r", 0.51), (198, 1, "r", 1.0), (5, 2, "l", 0.5)]


def test_streets_that_share_a_stretch_have_no_crossing(spark):
    seg = "key string, x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 0.0), ("a", 4.0, 0.0, 4.0, 4.0)], seg)
    b = spark.createDataFrame([("b", 2.0, -1.0, 2.0, 1.0), ("c", 3.0, 0.0, 9.0, 0.0), ("c", 3.0, -1.0, 3.0, 2.0)], seg)
    assert rows(J.crossings(a, b, 1.0)) == [("a", "b", 2.0, 0.0)]


def test_pages_resolve_one_to_one(spark):
    p = spark.createDataFrame([("7a",), ("7A",), ("8b",), ("9",), ("x",), ("X",)], "page string")
    k = spark.createDataFrame([("7a",), ("8B",), ("9",), ("x ",)], "key string")
    assert rows(J.resolve_pages(p, k)) == [("7A", None), ("7a", "7a"), ("8b", "8B"), ("9", "9"), ("X", None), ("x", None)]


def test_mutual_edges_need_the_opposite_side(spark):
    e = spark.createDataFrame([("1", "right", "2"), ("2", "left", "1"), ("1", "top", "3"), ("3", "top", "1")], "page string, side string, neighbor string")
    opposite = F.expr("CASE side WHEN 'top' THEN 'bottom' WHEN 'bottom' THEN 'top' WHEN 'left' THEN 'right' ELSE 'left' END")
    assert rows(J.mutual_edges(e, opposite)) == [("1", "right", "2")]


def test_affine_fits(spark):
    grid = [(1, float(x), float(y), 10 + 2.0 * x - y, 5 + 0.5 * x - 3.0 * y) for x in range(3) for y in range(3)]
    line = [(2, float(x), float(2 * x), 1.0 * x, 0.0) for x in range(4)]
    f = {r.k: r for r in A.fit_affine(spark.createDataFrame([*grid, *line, (3, 0.0, 0.0, 0.0, 0.0)], "k int, px double, py double, x double, y double"), ["k"]).collect()}
    assert [round(f[1].m[c], 9) for c in ("a0", "a1", "a2", "b0", "b1", "b2")] == [10, 2, -1, 5, 0.5, -3]
    assert f[2].m is None and f[3].m is None


@pytest.mark.parametrize("n", range(1, 12))
def test_medians(spark, n):
    values = [float((i * 7) % 11) for i in range(n)]
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(A.upper_median_of("x"), A.p90_of("x")).first()
    assert got[0] == sorted(values)[n // 2] and got[1] == sorted(values)[-(-9 * n // 10) - 1]


def test_votes_abstain(spark):
    votes = lambda **v: F.create_map(*[x for k, b in v.items() for x in (F.lit(k), F.lit(b).cast("boolean"))])
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(A.decide(votes(a=True, b=None, c=True))).accept
    assert not one(A.decide(votes(a=True, b=False, c=True))).accept
    assert not one(A.decide(votes(a=True, b=None, c=None))).accept
    t = lambda *v: one(A.tri_state_vote(*[F.lit(x) for x in v]))
    assert (t(3, 0, 0.0), t(4, 3, 10.0), t(4, 3, 1e4), t(2, 2, 0.0), t(6, 3, 0.0)) == (False, True, None, None, None)


def test_conflicts_and_ranges(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 3), ("b", 2, 4), ("c", None, 5), ("c", None, 6)], "k string, v int, o int")
    assert rows(A.dedupe_conflict(df, ["k"], "v", "o")) == [("a", 1, 1), ("c", None, 5)]
    e = spark.createDataFrame([(1, "s", 0, 100, 1000), (2, "s", 50, 150, 1056), (3, "s", 400, 500, 9), (4, "s", 90, 95, 1093)], "id int, street string, old_lo int, old_hi int, new_lo int")
    assert rows(A.agreeing_ranges(e, 100), "id") == [(3,), (4,)]


def test_even_samples(spark):
    r = spark.range(5000).withColumn("g", F.lit(1))
    got = [x.id for x in S.sample_evenly(r, ["g"], ["id"], 5).orderBy("id").collect()]
    assert got == [0, 1250, 2500, 3749, 4999]
    assert S.sample_evenly(r.limit(3), ["g"], ["id"], 5).count() == 3


def test_places_are_dense(spark):
    r = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    got = sorted((x.place, x.v) for x in S.places(r, [F.col("v").asc()], "place").collect())
    assert [p for p, _ in got] == list(range(1, 1001)) and [v for _, v in got] == sorted(v for _, v in got)


def test_cut_vertices_belong_to_both_pieces(spark):
    v = [("w", "s", i, f"n{i}") for i in range(5)] + [("x", "t", 0, "n2"), ("x", "t", 1, "m"), ("y", "t", 0, "n4"), ("y", "t", 1, "n0")]
    c = S.cut_at_shared(spark.createDataFrame(v, "way string, street string, pos int, node string"))
    assert sorted(tuple(r.nodes) for r in c.filter("way = 'w'").collect()) == [("n0", "n1", "n2"), ("n2", "n3", "n4")]


def test_a_rejection_never_replaces_a_commit(spark):
    p = spark.createDataFrame([(1, "OK"), (2, "REJECTED"), (3, "OK"), (4, None)], "k int, status string")
    n = spark.createDataFrame([(1, "REJECTED"), (2, "OK (rescued)"), (4, "REJECTED"), (5, "OK")], "k int, status string")
    assert rows(T.transition(p, n, "k"), "k", "status") == [(1, "OK"), (2, "OK (rescued)"), (3, "OK"), (4, "REJECTED"), (5, "OK")]


def test_report_of_nothing_accepted(spark):
    r = spark.createDataFrame([(1, T.REVOKED, 1.0, 2.0, 0.0), (1, None, 1.0, 2.0, 0.0), (1, T.REVIEWER, 1.0, 99.0, 0.0)], "volume int, status string, residual_m double, rmse_m double, rotation_deg double")
    x = T.build_report(r).first()
    assert (x.n_sheets, x.revoked, x.flagged, x.reviewer_verified, x.scored, x.median_rmse_m) == (3, 1, 2, 1, 0, None)


def test_seam_shifts(spark):
    d = lambda *v: spark.range(1).select(T.seam_shift(*[F.lit(x).cast("double") for x in v]).alias("d")).first().d
    assert tuple(d(3.0, 0.0, None, None)) == (3.0, 0.0) and tuple(d(1.0, 1.0, None, None)) == (0.0, 0.0) and tuple(d(3.0, 0.0, 3.0, 0.001)) == (0.0, 0.0)


def test_readers(spark, tmp_path):
    (tmp_path / "r").mkdir()
    gcps = {"features": [{"geometry": {"coordinates": [1.0, 2.0]}, "properties": {"image": [3, 4], "note": "synthetic corner"}}]}
    (tmp_path / "r" / "p7a.json").write_text(json.dumps({"status": "OK", "n_inliers": 4, "gcps_geojson": gcps}, indent=1))
    (tmp_path / "r" / "p8.json").write_text("{broken")
    r = D.read_records(spark, str(tmp_path / "r" / "p*.json"))
    assert rows(r, "page", "status", "damaged") == [("7a", "OK", False), ("8", None, True)]
    assert rows(D.control_points(r)) == [("7a", 0, 3.0, 4.0, 1.0, 2.0, True)]
    with pytest.raises(Exception, match="(?i)malformed|corrupt|fail"):
        D.read_records(spark, str(tmp_path / "r" / "p*.json"), strict=True).collect()
    line = lambda kind, c: {"type": "Feature", "properties": {"name": "A"}, "geometry": {"type": kind, "coordinates": c}}
    (tmp_path / "f.json").write_text(json.dumps({"features": [line("LineString", [[0, 0], [1, 1]]), line("MultiLineString", [[[0, 0], [2, 2]], [[3, 3], [4, 4]]]), line("Point", [0, 0])]}, indent=1))
    f = D.read_features(spark, str(tmp_path / "f.json")).orderBy("ord").collect()
    assert [len(x.parts) for x in f] == [1, 2] and f[0].properties["name"] == "A" and f[1].parts[1][0].x == 3.0


def test_ways_queue_and_sums(spark):
    w = spark.createDataFrame([("way", 1, {"name": "A", "highway": "residential"}, [1.0, 2.0]), ("way", 2, {"name": "B", "highway": "path"}, [1.0, 2.0]), ("node", 3, {"name": "C", "highway": "x"}, [1.0, 2.0]), ("way", 4, {"name": "D", "highway": "x", "area": "yes"}, [1.0, 2.0]), ("way", 5, {"highway": "x"}, [1.0, 2.0])], "type string, id long, tags map<string,string>, geometry array<double>")
    assert rows(D.usable_ways(w), "id") == [(1,)]
    w = spark.createDataFrame([("way", 6, {"name": "Oak Street"}, [1.0, 2.0]), ("way", 7, {"name": "..."}, [1.0, 2.0]), ("way", 8, {"name": ""}, [1.0, 2.0]), ("way", 9, {"name": "Elm", "area": "yes"}, [1.0, 2.0]), ("way", 10, None, [1.0, 2.0]), ("way", 11, {"name": "E"}, [1.0])], w.schema)
    assert rows(D.usable_ways(w), "id") == [(6,)]
    q = spark.createDataFrame([('{"volume": "v", "odd": 1}',), ("not json",)], "value string")
    assert rows(D.read_queue(q), "volume", "track", "status", "quarantined") == [("v", "place", "queued", False), (None, "place", "queued", True)]
    m = spark.createDataFrame([(0, "a", "1"), (1, "b", "2")], "ord long, path string, sha256 string")
    n = spark.createDataFrame([("b", "9"), ("c", "3")], "path string, sha256 string")
    assert rows(D.updated_sums(m, n)) == [(0, "a", "1"), (1, "b", "9"), (None, "c", "3")]


def test_ground_truth_last_in_file_first_source(spark):
    g = spark.createDataFrame([(0, 0, "v_p1", "x"), (0, 1, "v_p1", "y"), (1, 0, "v_p1", "z"), (1, 1, "v_p2_1", "q"), (1, 2, "v_p3A", "r"), (2, 0, "w_p3a", "s")], "rank int, ord int, slug string, value string")
    assert rows(D.ground_truth(g), "rank", "page", "value") == [(0, "1", "y"), (1, "3A", "r")]


def test_write_if_changed(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.lit("a"))
    path = f"file://{tmp_path}/t"
    assert D.write_if_changed(spark, df, path) and not D.write_if_changed(spark, df.repartition(3), path)
    assert D.write_if_changed(spark, df.withColumn("x", F.lit("b")), path)
    twice = lambda v: spark.createDataFrame([(v,), (v,)], "x string")
    path = f"file://{tmp_path}/u"
    assert D.write_if_changed(spark, twice("a"), path) and D.write_if_changed(spark, twice("b"), path) and not D.write_if_changed(spark, twice("b"), path)
    assert D.write_if_changed(spark, twice("b").limit(1), path) and D.write_if_changed(spark, twice(None), path)
    assert rows(spark.read.parquet(path)) == [(None,), (None,)]


def test_unknown_directions_raise(spark):
    with pytest.raises(Exception, match="no direction"):
        spark.range(1).select(signed(F.lit("Q"), F.lit(1.0))).collect()


def test_snap(spark):
    v = spark.createDataFrame([("WESTFELD",), ("MONTRSE",), ("WESTFELDS",), ("IOWAA",), ("CLARKSON",), ("XLARKSON",), (None,), ("",)], "val string")
    k = spark.createDataFrame([("WESTFELD",), ("WESTFELD",), ("MONTROSE",), ("MONTROSE",), ("IOWA",), ("CLARKSEN",), ("CLARKSAN",), (None,)], "key string")
    assert rows(J.snap(v, k)) == sorted([("WESTFELD", "WESTFELD"), ("MONTRSE", "MONTROSE"), ("WESTFELDS", "WESTFELD"), ("IOWAA", None), ("CLARKSON", None), ("XLARKSON", None), (None, None), ("", None)], key=str)


def test_first_json_object(spark):
    said = [
        ('{"a": 1}', '{"a":1}'), ('```json\n{"a": 1}\n```', '{"a":1}'), ('Sure: {"a": "}{"} or {"b": 2}', '{"a":"}{"}'), ('{"result": "So {\\"a\\": 2} }"}', '{"a":2}'),
        ('{"result": {"a": 3}, "b": 1}', '{"result":{"a":3},"b":1}'), ('{"result": "{}"} and more', '{"result":"{}"}'), ("no object", None), ("{broken", None), ("", None), (None, None), ('[{"a": 1}]', '{"a":1}'),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(said)], "i int, t string").select("i", D.json_from_prose(F.col("t")).alias("j"))
    assert [r.j for r in df.orderBy("i").collect()] == [w for _, w in said]


def test_entries_run_on_and_sustained_drops_split(spark):
    t = spark.createDataFrame([("a", 1, "Elm St.,  "), ("a", 2, ""), ("a", 3, " Old Pl."), ("a", 4, "-Oak"), ("a", 5, "-Ash "), ("b", 1, "x")], "doc string, n int, line string")
    assert rows(S.joined_lines(t, ["doc"], ["n"], "line")) == [("a", "-Ash"), ("a", "-Oak"), ("a", "Elm St., Old Pl."), ("b", "x")]
    v = [10, 20, 5, 30, 8, 9, 40, 7]
    r = spark.createDataFrame([(1, i, x, i != 6) for i, x in enumerate(v)], "k int, i int, v int, ok boolean")
    # 5 stands alone under 20 and stays; 8 is confirmed by 9; 40 isn't accepted; nothing follows 7
    assert [x[2] for x in rows(S.split_sustained(r, ["k"], ["i"], "v", F.col("ok")), "k", "i", "piece")] == [0, 0, 0, 0, 1, 1, 1, 1]


def test_entries_of_a_rename_list(spark):
    from plumbline.functions.names import renames

    cases = {
        "-Quarry Street, Ridge Avenue. Vacated.": {("QUARRY ST", "RIDGE AV")},
        "-Quarry St., Ridge Av. and Dale Court from 200N to 400N.": {("QUARRY ST", "RIDGE AV"), ("QUARRY ST", "DALE CT")},
        "-Quarry St., Heron.": {("QUARRY ST", "HERON")},
        "-North 12 Quarry, Heron": {("NORTH", "HERON")},
        "Ridge St., 300N Quarry St., W. Mill Pl., Ridge St.": {("QUARRY ST", "RIDGE ST"), ("MILL PL", "RIDGE ST")},
        "St., Quarry Pl.": set(), "Ridge, Quarry Pl.": set(), "Ridge St.": set(), "-": set(), "-300N, Quarry Pl.": set(), "": set(),
        "Ridge St., was named after a very long and winding brook of old": {("OLD", "RIDGE ST"), ("OLD", "RIDGE ST")},
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", renames(F.col("t")).alias("r"))
    assert {r.t: {(x.old, x.new) for x in r.r} for r in df.collect()} == cases


def test_nearest_segments_against_all_pairs(spark):
    import math
    import random

    r = random.Random(3)
    segments = [(i, i % 3, *(r.uniform(0, 900) for _ in range(2))) for i in range(700)]
    segments = [(i, k, x, y, x + r.uniform(-9, 9), y + r.choice([0.0, r.uniform(-300, 300)])) for i, k, x, y in segments]
    points = [(i, r.choice([0, 1, 2, 7]), r.uniform(-300, 1200), r.uniform(-300, 1200)) for i in range(150)]

    def distance(p, s):
        _, _, x0, y0, x1, y1 = s
        f = max(0.0, min(1.0, ((p[2] - x0) * (x1 - x0) + (p[3] - y0) * (y1 - y0)) / max((x1 - x0) ** 2 + (y1 - y0) ** 2, 1e-300)))
        return math.hypot(p[2] - x0 - f * (x1 - x0), p[3] - y0 - f * (y1 - y0))

    got = {x.id: (x.seg, x.distance) for x in J.nearest_segment(spark.createDataFrame(points, "id int, k int, px double, py double"), spark.createDataFrame(segments, "seg int, k int, x0 double, y0 double, x1 double, y1 double"), "k").collect()}
    assert set(got) == {p[0] for p in points if p[1] != 7}
    for p in points:
        if p[1] != 7:
            d, s = min((distance(p, s), s[0]) for s in segments if s[1] == p[1])
            assert got[p[0]][0] == s and abs(got[p[0]][1] - d) < 1e-9


def test_densest_angle_against_all_pairs(spark):
    import random

    r = random.Random(5)
    angles = [(g, r.choice([3.0, 178.5, 90.0, 91.25, r.uniform(0, 180)])) for g in range(6) for _ in range(40)]
    got = {x.g: (x.angle, x.n, x.spread) for x in A.densest_angle(spark.createDataFrame(angles, "g int, a double"), "g", "a", 5.0).collect()}
    for g in range(6):
        own = [a for k, a in angles if k == g]
        dev = lambda a, b: abs((b - a + 90) % 180 - 90)
        best = min((-sum(dev(a, b) <= 5 for b in own), round(sum(dev(a, b) for b in own if dev(a, b) <= 5), 6), a) for a in own)
        assert got[g] == (best[2], -best[0], pytest.approx(best[1], abs=1e-6))
