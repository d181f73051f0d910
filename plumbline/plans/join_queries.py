"""Queries over fuzzy, range, nearest, spatial, one-to-one and prioritised joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import node_key
from ..operators import aggs as A
from ..operators import joins as J
from .registry import query, table


@query("""
WITH r AS (SELECT p_partkey, p_brand AS street, (p_partkey % 40) * 100 AS lo, (p_partkey % 40) * 100 + 98 AS hi, p_partkey AS ord,
  CASE WHEN p_size % 2 = 0 THEN 5000 + (p_partkey % 40) * 100 ELSE 5098 + (p_partkey % 40) * 100 END AS nf, p_size FROM part),
v AS (SELECT l_orderkey * 10 + l_linenumber AS k, min(l_partkey % 4000) AS value, min('Brand#' || (l_suppkey % 25 + 1)) AS street FROM lineitem GROUP BY 1),
a AS (SELECT v.k, v.value, r.ord, nf + CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END * (value - lo) AS answer FROM v LEFT JOIN r ON r.street = v.street AND value BETWEEN lo AND hi)
SELECT k AS id, value, CASE WHEN max(answer) - min(answer) <= 75 THEN arg_min(answer, ord) END AS modern FROM a GROUP BY 1, 2""")
def renumber_range_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    lo, even = (F.col("p_partkey") % 40 * 100), F.col("p_size") % 2 == 0
    t = p.select(
        F.col("p_partkey").alias("ord"), F.col("p_brand").alias("street_key"), lo.alias("old_first"), (lo + 98).alias("old_last"),
        F.when(even, 5000 + lo).otherwise(5098 + lo).alias("new_first"), F.when(even, 5098 + lo).otherwise(5000 + lo).alias("new_last"),
    )
    li = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).agg(
        F.min(F.col("l_partkey") % 4000).alias("value"), F.min(F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 25 + 1).cast("string"))).alias("street_key")
    )
    return J.convert_numbers(li, t, 75.0).select("id", "value", "modern")


@query("""
WITH s AS (SELECT p_partkey AS seg, p_brand AS street, p_size * 100 AS lf, p_size * 100 + 98 AS lt, p_size * 100 + 99 AS rf, p_size * 100 + 1 AS rt FROM part),
n AS (SELECT o_orderkey AS id, 'Brand#' || (o_custkey % 25 + 1) AS street, (o_orderkey % 5100)::INT AS value FROM orders),
b AS (SELECT id, value, seg, 'l' AS side, (value - lf) / (lt - lf)::DOUBLE AS fraction FROM n JOIN s USING (street) WHERE value BETWEEN lf AND lt AND value % 2 = 0
  UNION ALL SELECT id, value, seg, 'r', (value - rf) / (rt - rf)::DOUBLE FROM n JOIN s USING (street) WHERE value BETWEEN rt AND rf)
SELECT id, value, seg, side, round(fraction, 6) AS fraction FROM b""")
def address_match(spark, sf_dir):
    text = lambda c: c.cast("string")
    h = F.col("p_size") * 100
    s = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seg"), F.col("p_brand").alias("street_key"), text(h).alias("l_from"), text(h + 98).alias("l_to"), text(h + 99).alias("r_from"), text(h + 1).alias("r_to"),
        F.lit("e").alias("l_parity"), F.lit(None).cast("string").alias("r_parity"),
    )
    n = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Brand#"), text(F.col("o_custkey") % 25 + 1)).alias("street_key"), (F.col("o_orderkey") % 5100).cast("int").alias("value")
    )
    return J.match_address(n, s, digits=6).select("id", "value", "seg", "side", "fraction")


_NEAR = """
WITH p AS (SELECT s_suppkey AS id, s_nationkey AS nation, s_acctbal / 100 AS px, s_suppkey % 50 AS py FROM supplier),
s AS (SELECT c_custkey AS seg, c_nationkey AS nation, c_acctbal / 100 AS x0, c_custkey % 50 AS y0, c_acctbal / 100 + 3 AS x1, c_custkey % 50 + 4 AS y1 FROM customer),
t AS (SELECT id, seg, greatest(0, least(1, ((px - x0) * 3 + (py - y0) * 4) / 25)) AS f, px, py, x0, y0 FROM p JOIN s USING (nation)),
d AS (SELECT id, seg, f, sqrt((px - x0 - 3 * f) ** 2 + (py - y0 - 4 * f) ** 2) AS d FROM t)"""


def _near_tables(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") / 100).alias("px"), (F.col("s_suppkey") % 50).cast("double").alias("py"))
    x, y = F.col("c_acctbal") / 100, (F.col("c_custkey") % 50).cast("double")
    s = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seg"), F.col("c_nationkey").alias("nation"), x.alias("x0"), y.alias("y0"), (x + 3).alias("x1"), (y + 4).alias("y1"))
    return p, s


@query(_NEAR + " SELECT id, round(min(d), 4) AS distance FROM d GROUP BY id")
def nearest_segment(spark, sf_dir):
    return J.nearest_segment(*_near_tables(spark, sf_dir), "nation").select("id", F.round("distance", 4).alias("distance"))


@query(_NEAR + """, b AS (SELECT id, arg_min(struct_pack(seg, d, f), struct_pack(d, seg)) AS b FROM d GROUP BY id),
v AS (SELECT id, b.seg AS seg, b.d AS d, b.f AS f, (id * 7 % 200)::INT AS value, (b.seg % 4 * 50)::INT AS base FROM b),
o AS (SELECT *, CASE WHEN seg % 3 = 0 THEN abs(base + f * 48 - value) WHEN value % 2 = 0 THEN abs(base + f * 48 - value) ELSE abs(base + 49 - f * 48 - value) END AS off FROM v)
SELECT id, d <= 5 AND off <= 40 AS in_block, round(d, 4) AS distance, round(off, 4) AS off FROM o""")
def numeral_in_block(spark, sf_dir):
    """Even numbers on one side, odd ones the other way round on the other; every third segment has its even side only."""
    p, s = _near_tables(spark, sf_dir)
    base = (F.col("seg") % 4 * 50).cast("int")
    side = lambda a, z: F.struct(a.alias("first"), z.alias("last"))
    even, odd = side(base, base + 48), side(base + 49, base + 1)
    s = s.withColumn("sides", F.when(F.col("seg") % 3 == 0, F.array(even)).otherwise(F.array(even, odd)))
    b = J.in_block(p.withColumn("value", (F.col("id") * 7 % 200).cast("int")), s, "nation", 5.0, 40.0)
    return b.withColumns({"distance": F.round("distance", 4), "off": F.round("off", 4)})


@query("""
WITH l AS (SELECT l_orderkey AS sheet, l_linenumber AS ord, min(l_suppkey % 40) AS key, min(l_quantity) AS px, min(l_extendedprice) AS py FROM lineitem GROUP BY 1, 2),
n AS (SELECT a.s_suppkey % 40 AS ka, b.s_suppkey % 40 AS kb, min(a.s_acctbal) AS x, min(b.s_acctbal) AS y FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey % 40 < b.s_suppkey % 40 GROUP BY 1, 2)
SELECT a.sheet, a.ord AS ord_a, b.ord AS ord_b, a.key AS key_a, b.key AS key_b, a.px, b.py, n.x, n.y FROM l a JOIN l b ON a.sheet = b.sheet AND a.ord < b.ord AND a.key <> b.key
  JOIN n ON n.ka = least(a.key, b.key) AND n.kb = greatest(a.key, b.key)""")
def crossing_candidates(spark, sf_dir):
    """Pairs of a sheet's labels with the crossings of their streets."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("ord"))
    labels = li.agg(F.min(F.col("l_suppkey") % 40).alias("key"), F.min("l_quantity").alias("px"), F.min("l_extendedprice").alias("py"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("key_a"), "s_nationkey", F.col("s_acctbal").alias("x"))
    t = s.select(F.col("key_a").alias("key_b"), "s_nationkey", F.col("x").alias("y"))
    nodes = s.join(t, "s_nationkey").filter("key_a < key_b").groupBy("key_a", "key_b").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return J.candidates(labels, nodes, ["sheet"], "ord", "key")


@query("""
WITH a AS (SELECT s_suppkey AS key, (s_suppkey % 10) * 10 AS x0, 0 AS y0, (s_suppkey % 10) * 10 + 5 AS x1, 100 AS y1 FROM supplier),
b AS (SELECT 1000 + n_nationkey AS key, 0 AS x0, n_nationkey * 4 AS y0, 100 AS x1, n_nationkey * 4 + 3 AS y1 FROM nation)
SELECT key_a, key_b, round(ax0 + t * rx, 6) AS x, round(ay0 + t * ry, 6) AS y FROM (
  SELECT a.key AS key_a, b.key AS key_b, a.x0 AS ax0, a.y0 AS ay0, a.x1 - a.x0 AS rx, a.y1 - a.y0 AS ry, b.x1 - b.x0 AS sx, b.y1 - b.y0 AS sy,
    ((b.x0 - a.x0) * (b.y1 - b.y0) - (b.y0 - a.y0) * (b.x1 - b.x0))::DOUBLE / ((a.x1 - a.x0) * (b.y1 - b.y0) - (a.y1 - a.y0) * (b.x1 - b.x0)) AS t,
    ((b.x0 - a.x0) * (a.y1 - a.y0) - (b.y0 - a.y0) * (a.x1 - a.x0))::DOUBLE / ((a.x1 - a.x0) * (b.y1 - b.y0) - (a.y1 - a.y0) * (b.x1 - b.x0)) AS u FROM a, b)
WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1""")
def street_crossings(spark, sf_dir):
    d = lambda c: c.cast("double")
    k, n = F.col("s_suppkey") % 10 * 10, F.col("n_nationkey") * 4
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), d(k).alias("x0"), F.lit(0.0).alias("y0"), d(k + 5).alias("x1"), F.lit(100.0).alias("y1"))
    b = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1000).cast("long").alias("key"), F.lit(0.0).alias("x0"), d(n).alias("y0"), F.lit(100.0).alias("x1"), d(n + 3).alias("y1"))
    return J.crossings(a, b, 10.0, same=False).select("key_a", "key_b", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey % 20 AS key FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber AS ord_a, b.l_linenumber AS ord_b, a.key AS key_a, b.key AS key_b FROM l a JOIN l b USING (l_orderkey) WHERE a.l_linenumber < b.l_linenumber AND a.key <> b.key""")
def candidate_pairs(spark, sf_dir):
    labels = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 20).alias("key")).distinct()
    return J.ordered_pairs(labels, ["l_orderkey"], "l_linenumber", "key")


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, list_sort(list_distinct([l_suppkey % 6, l_partkey % 6])) AS s FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS l_suppkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2))
SELECT a.l_orderkey, bool_or(NOT list_has_any(a.s, b.s)) AS disjoint FROM k a JOIN k b USING (l_orderkey) GROUP BY 1""")
def disjoint_pair(spark, sf_dir):
    """Whether two anchors of a group share no street: a fold over each group's few distinct sets."""
    from ..operators.rescue import disjoint_pair as disjoint

    k = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("a"), F.min("l_partkey").alias("b"))
    k = k.select("l_orderkey", F.array_sort(F.array_distinct(F.array(F.col("a") % 6, F.col("b") % 6))).alias("s"))
    sets = k.groupBy("l_orderkey").agg(F.collect_set("s").alias("sets"))
    return sets.select("l_orderkey", disjoint(F.col("sets")).alias("disjoint"))


_NODES = """
WITH e AS (SELECT user_id AS page, event_id AS ord, round(value, 1) AS nx, user_id % 5 AS ny, value AS px, event_type FROM events WHERE event_type IN ('click', 'view'))"""


@query(_NODES + """, c AS (SELECT * FROM e WHERE event_type = 'click'), v AS (SELECT * FROM e WHERE event_type = 'view')
SELECT c.page, count(*) AS hits, count(DISTINCT (c.nx, c.ny)) AS nodes, round(min(abs(c.px - v.px)), 6) AS best FROM c JOIN v ON c.nx = v.nx AND c.ny = v.ny AND c.page <> v.page GROUP BY 1""")
def node_key_join(spark, sf_dir):
    h = _hits(spark, sf_dir)
    return h.groupBy("page").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("node").alias("nodes"), F.round(F.min("d"), 6).alias("best"))


def _hits(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type in ('click', 'view')")
    e = e.select(F.col("user_id").alias("page"), F.col("event_id").alias("ord"), node_key(F.round("value", 1), (F.col("user_id") % 5).cast("double")).alias("node"), F.col("value").alias("px"), "event_type")
    a = e.filter("event_type = 'click'").drop("event_type", "ord")
    b = e.filter("event_type = 'view'").select("node", F.col("page").alias("other"), F.col("px").alias("qx"))
    return a.join(b, "node").filter("page <> other").withColumn("d", F.abs(F.col("px") - F.col("qx")))


@query(_NODES + """, h AS (SELECT c.page, c.nx, c.ny, min(abs(c.px - v.px)) AS d FROM e c JOIN e v ON c.nx = v.nx AND c.ny = v.ny AND c.page <> v.page AND c.event_type = 'click' AND v.event_type = 'view' GROUP BY 1, 2, 3),
g AS (SELECT page, count(*) FILTER (round(d, 6) <= 0.01) AS good, list_sort(list(round(d, 6))) AS ds FROM h GROUP BY 1)
SELECT page, good >= 2 AS corroborated, coalesce(ds[1] <= 0.01 AND ds[2] <= 0.02, false) AS near FROM g""")
def corroborated(spark, sf_dir):
    h = _hits(spark, sf_dir).withColumn("d", F.round("d", 6))
    return A.corroborated(h, ["page"], "node", "d", tol=0.01, least=2, near=2.0)


@query("""
WITH u AS (SELECT l_partkey AS node, l_suppkey AS page, arg_min(l_quantity, (l_orderkey, l_linenumber, l_quantity)) AS px FROM lineitem GROUP BY 1, 2)
SELECT a.node, a.page AS page_a, a.px AS px_a, b.page AS page_b, b.px AS px_b FROM u a JOIN u b ON a.node = b.node AND a.page < b.page""")
def seam_ties(spark, sf_dir):
    return J.seam_ties(node_uses(spark, sf_dir)).select("node", "page_a", "px_a", "page_b", "px_b")


def node_uses(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("node"), F.col("l_suppkey").alias("page"), F.struct("l_orderkey", "l_linenumber", "l_quantity").alias("ord"), F.col("l_quantity").alias("px"), F.lit(0.0).alias("py"))


_OPP = "CASE side WHEN 'top' THEN 'bottom' WHEN 'bottom' THEN 'top' WHEN 'left' THEN 'right' ELSE 'left' END"
_SIDE = "CASE l_linenumber % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' WHEN 2 THEN 'left' ELSE 'right' END"


@query(f"""
WITH e AS (SELECT DISTINCT l_suppkey AS page, {_SIDE} AS side, l_partkey % 100 AS neighbor FROM lineitem)
SELECT a.page, a.side, a.neighbor FROM e a JOIN e b ON b.page = a.neighbor AND b.neighbor = a.page
  AND b.side = CASE a.side WHEN 'top' THEN 'bottom' WHEN 'bottom' THEN 'top' WHEN 'left' THEN 'right' ELSE 'left' END WHERE a.page < a.neighbor""")
def mutual_edges(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page"), F.expr(_SIDE).alias("side"), (F.col("l_partkey") % 100).alias("neighbor"))
    return J.mutual_edges(e, F.expr(_OPP))


@query(f"""
WITH e AS (SELECT DISTINCT l_suppkey AS page, {_SIDE} AS side, l_partkey % 100 AS neighbor FROM lineitem),
c AS (SELECT s_suppkey AS neighbor, -9750000 + s_suppkey * 220.0::DOUBLE AS cx, 5100000 + s_acctbal AS cy FROM supplier),
w AS (SELECT page, side, cx, cy, CASE WHEN side IN ('left', 'right') THEN 220.0::DOUBLE ELSE 400.0::DOUBLE END AS far, cos(atan(sinh(cy / 6378137.0::DOUBLE))) AS k FROM e JOIN c USING (neighbor))
SELECT page, round(avg(cx + CASE side WHEN 'left' THEN far / k WHEN 'right' THEN -far / k ELSE 0 END), 3) AS x,
  round(avg(cy + CASE side WHEN 'top' THEN -far / k WHEN 'bottom' THEN far / k ELSE 0 END), 3) AS y, min(greatest(100, far / 2)) AS radius_m FROM w GROUP BY 1""")
def neighbor_windows(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page"), F.expr(_SIDE).alias("side"), (F.col("l_partkey") % 100).alias("neighbor")).distinct()
    c = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("neighbor"), (F.lit(-9750000) + F.col("s_suppkey") * 220.0).alias("cx"), (F.lit(5100000) + F.col("s_acctbal")).alias("cy"))
    return J.window_of_neighbors(e, c).select("page", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "radius_m")


@query("""
WITH p AS (SELECT DISTINCT CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS page FROM supplier UNION SELECT 'DUP' UNION SELECT 'Dup'),
k AS (SELECT DISTINCT CASE WHEN s_suppkey % 4 = 0 THEN lower(s_name) ELSE s_name END AS key FROM supplier WHERE s_suppkey % 7 <> 0 UNION SELECT 'dup'),
x AS (SELECT page, page AS key FROM p WHERE page IN (SELECT key FROM k)),
lp AS (SELECT page, lower(page) AS f, count(*) OVER (PARTITION BY lower(page)) AS n FROM p WHERE page NOT IN (SELECT page FROM x)),
lk AS (SELECT key, lower(key) AS f, count(*) OVER (PARTITION BY lower(key)) AS n FROM k WHERE key NOT IN (SELECT key FROM x))
SELECT p.page, coalesce(x.key, z.key) AS key FROM p LEFT JOIN x USING (page) LEFT JOIN (SELECT lp.page, lk.key FROM lp JOIN lk USING (f) WHERE lp.n = 1 AND lk.n = 1) z ON z.page = p.page""")
def resolve_case_fold(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    p = s.select(F.when(F.col("s_suppkey") % 3 == 0, F.upper("s_name")).otherwise(F.col("s_name")).alias("page")).union(spark.sql("VALUES ('DUP'), ('Dup')")).distinct()
    k = s.filter("s_suppkey % 7 <> 0").select(F.when(F.col("s_suppkey") % 4 == 0, F.lower("s_name")).otherwise(F.col("s_name")).alias("key")).union(spark.sql("VALUES ('dup')")).distinct()
    return J.resolve_pages(p, k)


@query("""
WITH u AS (SELECT 0 AS rank, doc_id AS ord, lower(lang) || (doc_id % 50) AS page, source AS value FROM documents UNION ALL SELECT 1, item_id, 'EN' || item_id, 'bench' FROM benchmark)
SELECT rank, ord, page, value FROM u QUALIFY row_number() OVER (PARTITION BY lower(page) ORDER BY rank, ord) = 1""")
def merge_precedence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.lit(0).alias("rank"), F.col("doc_id").alias("ord"), F.concat(F.lower("lang"), (F.col("doc_id") % 50).cast("string")).alias("page"), F.col("source").alias("value"))
    b = table(spark, sf_dir, "benchmark").select(F.lit(1).alias("rank"), F.col("item_id").alias("ord"), F.concat(F.lit("EN"), F.col("item_id").cast("string")).alias("page"), F.lit("bench").alias("value"))
    return J.first_by_priority(d.union(b), F.lower("page"), ["rank", "ord"], ["rank", "ord", "page", "value"])


@query("""
WITH b AS (SELECT p_partkey AS box, p_size * 100 AS x0, p_retailprice - 50 AS y0, p_size * 100 + 120 AS x1, p_retailprice + 50 AS y1 FROM part),
p AS (SELECT c_custkey AS id, (c_custkey * 37 % 5000)::DOUBLE AS x, 900 + c_custkey % 700 AS y FROM customer)
SELECT id, box FROM p JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def covering_boxes(spark, sf_dir):
    s, r = F.col("p_size") * 100, F.col("p_retailprice")
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("box"), s.alias("x0"), (r - 50).alias("y0"), (s + 120).alias("x1"), (r + 50).alias("y1"))
    p = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 37 % 5000).cast("double").alias("x"), (900 + F.col("c_custkey") % 700).cast("double").alias("y"))
    return J.covering_boxes(p, b, 100.0).select("id", "box")


@query("""
WITH a AS (SELECT s_suppkey AS id, s_nationkey AS g, s_acctbal AS x0, 0 AS y0, s_acctbal + 800 AS x1, 10 AS y1 FROM supplier),
b AS (SELECT c_nationkey AS g, c_name AS name, c_acctbal AS bx0, c_custkey % 10 AS by0, c_acctbal + 500 AS bx1, 12 AS by1 FROM customer),
o AS (SELECT id, name, greatest(least(x1, bx1) - greatest(x0, bx0), 0) * greatest(least(y1, by1) - greatest(y0, by0), 0) AS area FROM a JOIN b USING (g))
SELECT id, row_number() OVER (PARTITION BY id ORDER BY round(area, 4) DESC, name DESC) AS rank, name, round(area, 4) AS area FROM o WHERE area > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(area, 4) DESC, name DESC) <= 3""")
def top_areas(spark, sf_dir):
    d = lambda c: c.cast("double")
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("g"), F.col("s_acctbal").alias("x0"), F.lit(0.0).alias("y0"), (F.col("s_acctbal") + 800).alias("x1"), F.lit(10.0).alias("y1"))
    b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bx0"), d(F.col("c_custkey") % 10).alias("by0"), (F.col("c_acctbal") + 500).alias("bx1"), F.lit(12.0).alias("by1"))
    return J.top_overlaps(a, b, ["g"], 500.0)


@query("""
WITH b AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'), f AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'), d AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
SELECT DISTINCT o_custkey FROM b WHERE o_custkey IN (SELECT o_custkey FROM f) AND o_custkey NOT IN (SELECT o_custkey FROM d)""")
def unread_pages(spark, sf_dir):
    """Failed and not read since: a semi join, then an anti join."""
    o = table(spark, sf_dir, "orders")
    key = lambda c: o.filter(c).select("o_custkey").distinct()
    return key("o_orderstatus = 'F'").join(key("o_orderstatus = 'P'"), "o_custkey", "left_semi").join(key("o_orderstatus = 'O' and o_orderpriority = '1-URGENT'"), "o_custkey", "left_anti")


