"""Queries without SQL that have to read every row of their tables: brute force over all rows beside them."""

from plumbline.plans import catalog
from plumbline.plans.registry import table

LARGER = "/root/testdata/sf0.01"  # more orders than the first block of any of these queries


def line_items(spark):
    rows = table(spark, LARGER, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").collect()
    assert max(r.l_orderkey for r in rows) >= 4000
    return rows


def test_candidates_are_of_all_orders(spark):
    from plumbline.plans.sequence_queries import candidates

    want = {(r.l_orderkey // 4000 * 60 + r.l_orderkey % 60, r.l_orderkey, r.l_linenumber) for r in line_items(spark)}
    got = [tuple(r) for r in candidates(spark, LARGER).select("sheet", "i", "j").collect()]
    assert len(got) == len(want) and set(got) == want


def test_sheets_are_of_all_orders(spark):
    sheets = {r.l_orderkey // 4000 * 60 + r.l_orderkey % 60 for r in line_items(spark)}
    points = {(r.l_orderkey, r.l_linenumber) for r in line_items(spark)}
    fits = catalog.QUERIES["ransac_groups"](spark, LARGER).collect()
    assert {r.sheet for r in fits} == sheets and sum(r.n for r in fits) == len(points)
    for name in ("translation_cluster", "fit_diagnosis"):
        assert sorted(r.sheet for r in catalog.QUERIES[name](spark, LARGER).collect()) == sorted(sheets)


def test_offsets_are_of_all_orders(spark):
    rows = table(spark, LARGER, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity").collect()
    cells: dict[int, set] = {}
    for r in rows:
        cells.setdefault(r.l_orderkey // 600 * 10 + r.l_suppkey % 10, set()).add((float(r.l_extendedprice) // 1000, float(r.l_quantity) // 1))
    got = {r.volume: r for r in catalog.QUERIES["verify_offsets"](spark, LARGER).collect()}
    assert set(got) == set(cells)
    for v in sorted(cells)[:: max(1, len(cells) // 5)]:
        moved = {(x + 3, y - 5) for x, y in cells[v]}
        scores = {(a, b): sum((x + a, y + b) in moved for x, y in cells[v]) for a in range(-20, 21) for b in range(-20, 21)}
        assert (got[v].dx, got[v].dy) == (3, -5) and got[v].score == scores[3, -5] == max(scores.values())


def test_reachable_cells_are_of_all_orders(spark):
    rows = table(spark, LARGER, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").collect()
    edges: dict[int, list] = {}
    for r in rows:
        edges.setdefault(r.l_orderkey // 1500 * 10 + r.l_suppkey % 10, []).append((r.l_orderkey % 200, r.l_partkey % 200, r.l_linenumber == 7))
    want = set()
    for v, some in edges.items():
        seen, n = {a for a, _, start in some if start}, -1
        while n != len(seen):
            n = len(seen)
            seen |= {y for a, b, _ in some for x, y in ((a, b), (b, a)) if x in seen}
        want |= {(v, c) for c in seen}
    got = [tuple(r) for r in catalog.QUERIES["reachable_cells"](spark, LARGER).collect()]
    assert len(got) == len(want) and set(got) == want


def test_first_readings_are_of_all_events(spark):
    events = table(spark, LARGER, "events").select("event_id", "user_id", "event_type", "value").collect()
    assert max(e.event_id for e in events) >= 3000
    sheets: dict[int, set] = {}
    for e in events:
        lo = int(e.value // 1)
        sheets.setdefault(e.event_id // 3000 * 20 + e.user_id % 20, set()).add((e.event_type, e.event_id % 30, lo, lo + 6))
    want = set()
    for sheet, rows in sheets.items():
        taken: list[tuple] = []
        for m, v, lo, hi in sorted(rows):
            if any(x == v and a < hi and lo < b for _, x, a, b in taken):
                continue
            if len({o for o, x, a, b in rows if x == v and a < hi and lo < b}) >= 2:
                taken.append((m, v, lo, hi))
        want |= {(sheet, *r) for r in taken}
    got = [tuple(r) for r in catalog.QUERIES["first_readings"](spark, LARGER).collect()]
    assert len(got) == len(want) and set(got) == want


def test_fits_take_the_fixed_number_of_draws(spark):
    import numpy as np

    from plumbline.operators import kernels as K
    from plumbline.plans.sequence_queries import candidates

    fits = {r.sheet: r for r in catalog.QUERIES["ransac_groups"](spark, LARGER).collect()}
    some = sorted(fits)[::10]
    rows = candidates(spark, LARGER).filter(f"sheet in ({', '.join(map(str, some))})").orderBy("i", "j").collect()
    fewer = 0
    for sheet in some:
        p = np.array([(r.px, r.py, r.x, r.y) for r in rows if r.sheet == sheet], float)
        found, short = K.consensus_fit(p, 25.0, 4, 5000), K.consensus_fit(p, 25.0, 4, 200)
        fewer += len(short[1]) < len(found[1])
        assert fits[sheet].inliers == len(found[1])
        assert [fits[sheet][c] for c in ("a0", "a1", "a2", "b0", "b1", "b2")] == [round(float(v), 6) for v in found[0].ravel()]
    assert fewer  # 200 draws are told apart


def test_diagnosis_takes_the_fixed_number_of_draws(spark):
    import numpy as np

    from plumbline.operators import kernels as K

    r = np.random.default_rng(4)
    px, py = (v.ravel() * 1000.0 for v in np.meshgrid(np.arange(3), np.arange(3)))
    grid = np.c_[px, py, 100 + 0.067 * px, 200 - 0.067 * py]
    p = np.r_[grid, r.random((90, 4)) * [3000, 3000, 9e6, 9e6]]
    assert K.consensus_fit(p, 25.0, 6, 200) is None and K.consensus_fit(p, 25.0, 6, 5000) is not None
    df = spark.createDataFrame([(1, i, *map(float, q)) for i, q in enumerate(p)], "sheet int, i int, px double, py double, x double, y double")
    assert K.refusal(p, K.Gates(), (3000.0, 3000.0), draws=200) != K.ACCEPTED
    assert K.fit_diagnosis(df, ["sheet"], ["i"], K.Gates(), (3000.0, 3000.0)).first().reason == K.ACCEPTED


def test_bootstrap_takes_ten_thousand_draws(spark):
    import random

    from plumbline.operators import kernels as K

    n, k = [11 + c * c % 17 for c in range(30)], [c * 7 % 11 for c in range(30)]
    pages = [(1, c, i < k[c]) for c in range(30) for i in range(n[c])]
    rng = random.Random(7)
    shares = sorted(sum(k[i] for i in at) / sum(n[i] for i in at) for at in (rng.choices(range(30), k=30) for _ in range(10_000)))
    got = K.bootstrap(spark.createDataFrame(pages, "stratum int, cluster int, hit boolean"), "stratum", "cluster", "hit").first()
    assert (got.low, got.high) == (shares[250], shares[9750])


def test_clusters_are_the_first_largest_ones(spark):
    import math

    from plumbline.plans.sequence_queries import candidates

    got = {r.sheet: r for r in catalog.QUERIES["translation_cluster"](spark, LARGER).collect()}
    some = sorted(got)[::40]
    rows = candidates(spark, LARGER).filter(f"sheet in ({', '.join(map(str, some))})").orderBy("i", "j").collect()
    for sheet in some:
        p = [(r.x - 0.067 * float(r.px), r.y + 0.067 * float(r.py)) for r in rows if r.sheet == sheet]
        balls = [[q for q in p if math.dist(a, q) <= 12] for a in p]
        best = max(balls, key=len)
        assert got[sheet].n == len(best)
        centre = (sum(x for x, _ in best) / len(best), sum(y for _, y in best) / len(best))
        assert math.dist(centre, (got[sheet].dx, got[sheet].dy)) < 1e-5


def test_hulls_hold_all_points_and_touch_their_corners(spark):
    import numpy as np

    rows = table(spark, LARGER, "lineitem").select("l_suppkey", "l_extendedprice", "l_quantity").collect()
    sheets: dict[int, list] = {}
    for r in rows:
        sheets.setdefault(r.l_suppkey, []).append((float(r.l_extendedprice), float(r.l_quantity)))
    got = {r.sheet: r for r in catalog.QUERIES["sheet_hulls"](spark, LARGER).collect()}
    assert got.keys() == sheets.keys()
    for k in sorted(sheets)[::20]:
        p = np.array(sorted(set(sheets[k])))
        at, hull = 0, []  # wrapped like a gift, the next corner having all points on its left
        while at not in hull:
            hull.append(at)
            v = p - p[at]
            to = 1 if at == 0 else 0
            for i in range(len(p)):
                turn = v[to, 0] * v[i, 1] - v[to, 1] * v[i, 0]
                if turn < 0 or (turn == 0 and v[i] @ v[i] > v[to] @ v[to]):
                    to = i
            at = to
        x, y = p[hull].T
        area = abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2
        assert got[k].corners == len(hull) and abs(got[k].area - area) < 1e-3


def test_readers_rows_are_paired_in_order(spark):
    events = table(spark, LARGER, "events").filter("event_type in ('click', 'view')").select("user_id", "event_type", "value").collect()
    got: dict[int, list] = {}
    for r in catalog.QUERIES["merge_reads"](spark, LARGER).collect():
        got.setdefault(r.user_id, []).append((r.y_a, r.y_b))
    for user in {e.user_id for e in events}:
        a, b = (sorted(e.value for e in events if e.user_id == user and e.event_type == t) for t in ("click", "view"))
        rows = sorted(got[user], key=lambda r: min(v for v in r if v is not None))
        assert [x for x, _ in rows if x is not None] == a and [y for _, y in rows if y is not None] == b
        assert all(abs(x - y) <= 1 for x, y in rows if x is not None and y is not None)
        # no two neighbours that stay alone could have been a pair
        alone = [(r[0] if r[0] is not None else r[1], r[0] is not None) for r in rows if None in r]
        order = sorted(a + b)
        for (u, is_a), (v, is_b) in zip(alone, alone[1:], strict=False):
            between = [w for w in order if u < w < v]
            assert is_a == is_b or abs(u - v) > 1 or between
