"""Queries over localities, claims, gates, audits, spans and sequential chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import aggs as A
from ..operators import joins as J
from ..operators import kernels as K
from ..operators.stitching import stitched
from ..sources import documents as D
from .registry import query, table


@query("""
WITH c AS (SELECT l_suppkey AS key, l_orderkey % 40 AS sheet, l_quantity AS x, l_linenumber AS y FROM lineitem), s AS (SELECT s_suppkey AS key, s_acctbal / 300 AS cx, 3.0::DOUBLE AS cy FROM supplier),
n AS (SELECT key, sheet, min(sqrt((x - cx) ** 2 + (y - cy) ** 2)) AS d FROM c JOIN s USING (key) GROUP BY 1, 2)
SELECT key, count(*) AS sheets, round(-quantile_disc(-d, 0.5), 6) AS distance FROM n GROUP BY 1""")
def locality_distance(spark, sf_dir):
    li, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    c = li.select(F.col("l_suppkey").alias("key"), (F.col("l_orderkey") % 40).alias("sheet"), F.col("l_quantity").alias("x"), F.col("l_linenumber").cast("double").alias("y"))
    d = J.locality(c, s.select(F.col("s_suppkey").alias("key"), (F.col("s_acctbal") / 300).alias("cx"), F.lit(3.0).alias("cy")))
    return d.withColumn("distance", F.round("distance", 6))


@query("""
SELECT winner, cell, loser, ink, dist FROM (SELECT l_suppkey AS winner, l_partkey % 50 AS cell, l_orderkey AS loser, l_quantity AS ink, l_discount AS dist, l_orderkey * 10 + l_linenumber AS ord FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY winner, cell ORDER BY ink DESC, dist, ord, loser) = 1""")
def collect_claims(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("winner"), (F.col("l_partkey") % 50).alias("cell"), F.col("l_orderkey").alias("loser"), F.col("l_quantity").alias("ink"), F.col("l_discount").alias("dist"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )
    return J.best_claims(c)


@query("""
WITH a AS (SELECT c_custkey AS volume, c_mktsegment AS v FROM customer WHERE c_custkey % 4 = 0), b AS (SELECT o_custkey AS volume, max(o_orderpriority) AS v FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1)
SELECT c_custkey AS volume, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'manifest' WHEN b.v IS NOT NULL THEN 'pins' END AS source FROM customer LEFT JOIN a ON a.volume = c_custkey LEFT JOIN b ON b.volume = c_custkey""")
def footprint_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("volume"), F.col("c_mktsegment").alias("v"))
    o = table(spark, sf_dir, "orders").filter("o_custkey % 3 = 0").groupBy(F.col("o_custkey").alias("volume")).agg(F.max("o_orderpriority").alias("v"))
    return J.with_sources(c.select("volume"), "volume", [("manifest", c.filter("volume % 4 = 0")), ("pins", o)], "v")


@query("""
WITH u AS (SELECT o_custkey % 12 AS volume, o_orderkey // 12 % 400 AS page, min(o_orderpriority) AS digest FROM orders GROUP BY 1, 2), t AS (SELECT volume, page, CASE WHEN page % 3 = 0 THEN digest ELSE 'x' END AS digest FROM u),
b AS (SELECT u.volume, t.volume AS other, count(*) AS shared, sum((u.digest = t.digest)::INT) AS same FROM u JOIN t USING (page) GROUP BY 1, 2),
o AS (SELECT volume, shared, same / shared::DOUBLE AS share FROM b WHERE volume = other), m AS (SELECT volume, other FROM b WHERE volume <> other AND same > 0 QUALIFY row_number() OVER (PARTITION BY volume ORDER BY same DESC, other) = 1)
SELECT o.volume, shared, round(share, 9) AS share, CASE WHEN share < 0.5 THEN m.other END AS suspect FROM o LEFT JOIN m USING (volume)""")
def audit_pages(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    u = o.groupBy((F.col("o_custkey") % 12).alias("volume"), (F.floor(F.col("o_orderkey") / 12) % 400).alias("page")).agg(F.min("o_orderpriority").alias("digest"))
    t = u.withColumn("digest", F.when(F.col("page") % 3 == 0, F.col("digest")).otherwise("x"))
    return J.shared_share(u, t, 0.5).withColumn("share", F.round("share", 9))


@query("""
WITH s AS (SELECT user_id, count(*) AS n, sum(cos(2 * radians(value))) AS c, sum(sin(2 * radians(value))) AS s FROM events GROUP BY 1)
SELECT user_id, n, CASE WHEN n >= 8 THEN round(((degrees(atan2(s, c)) / 2) % 180 + 180) % 180, 4) END AS angle FROM s""")
def own_grid(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return A.circular_mean(e, "user_id", "value", 8).withColumn("angle", F.round("angle", 4))


@query("""
WITH c AS (SELECT p_partkey AS chain, CASE WHEN p_partkey % 6 <> 0 THEN p_name END AS name, p_partkey % 2 AS parity, p_partkey * 30 AS lo, p_partkey * 30 + 20 + p_size AS hi FROM part),
m AS (SELECT DISTINCT o.chain, n.name AS twin, n.lo, n.hi FROM c o JOIN c n ON o.name IS NULL AND n.name IS NOT NULL AND o.parity <> n.parity AND o.lo <= n.hi AND n.lo <= o.hi), k AS (SELECT chain, min(twin) AS twin FROM m GROUP BY 1 HAVING count(*) = 1)
SELECT c.chain, coalesce(c.name, k.twin) AS name FROM c LEFT JOIN k USING (chain)""")
def adopt_orphans(spark, sf_dir):
    k = F.col("p_partkey")
    c = table(spark, sf_dir, "part").select(k.alias("chain"), F.when(k % 6 != 0, F.col("p_name")).alias("name"), (k % 2).alias("parity"), (k * 30).alias("lo"), (k * 30 + 20 + F.col("p_size")).alias("hi"))
    return A.adopted(c).select("chain", "name")


@query("""
WITH s AS (SELECT l_suppkey % 12 AS volume, l_orderkey AS page, sqrt(avg(l_tax * l_tax)) AS b, sqrt(avg(l_discount * l_discount)) AS a FROM lineitem GROUP BY 1, 2)
SELECT volume, round(median(b), 9) AS before, round(median(a), 9) AS after, count(*) AS n, median(a) <= median(b) + 0.001 AS passed FROM s GROUP BY 1""")
def seam_gate(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 12).alias("volume"), F.col("l_orderkey").alias("page")).agg(A.rms(F.col("l_tax")).alias("rms_before"), A.rms(F.col("l_discount")).alias("rms_after"))
    return A.gate(s, "volume", 0.001).withColumns({c: F.round(c, 9) for c in ("before", "after")})


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'no-candidate' WHEN o_orderkey % 5 < 2 THEN 'held: too few reads' WHEN o_orderkey % 4 > 1 THEN 'held: several candidates' WHEN o_orderkey % 7 = 0 THEN 'held: no locality' WHEN o_totalprice / 500 > 400 THEN 'refused: far' ELSE 'clean' END AS tier FROM orders""")
def proposal_tier(spark, sf_dir):
    k = F.col("o_orderkey")
    t = A.tier(k % 5, k % 4, F.when(k % 7 != 0, F.col("o_totalprice") / 500))
    return table(spark, sf_dir, "orders").select("o_orderkey", t.alias("tier"))


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'ns' WHEN s_suppkey % 3 = 1 THEN 'ew' END AS axis,
  CASE WHEN s_suppkey % 3 = 0 THEN round(s_suppkey * 0.001 * 111132.0 / 1609.344 * 800, 3) WHEN s_suppkey % 3 = 1 THEN 0.0 END::DOUBLE AS along_lo, s_suppkey % 3 = 1 AS holds_ten FROM supplier""")
def grid_span(spark, sf_dir):
    k = F.col("s_suppkey")
    d = lambda c: c.cast("double")
    wide, tall = F.when(k % 3 == 0, 0.0001).when(k % 3 == 1, 0.02).otherwise(0.01), F.when(k % 3 == 0, 0.02).when(k % 3 == 1, 0.0001).otherwise(0.0095)
    lat = F.lit(41.0) + d(k) * 0.001
    lat = F.when(k % 3 == 0, lat).otherwise(F.lit(41.0))
    span = G.street_span(F.array(F.lit(-87.0), lat, F.lit(-87.0) + wide, lat + tall), -87.0, 41.0, 800.0)
    s = table(spark, sf_dir, "supplier").withColumn("s", span)
    ten = F.coalesce((F.col("s.axis") == "ew") & G.along_covers(F.col("s"), F.lit(10.0)) & G.along_overlaps(F.col("s"), F.lit(20.0), F.lit(5.0)), F.lit(False))
    return s.select("s_suppkey", "s.axis", F.round("s.along_lo", 3).alias("along_lo"), ten.alias("holds_ten"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 3 THEN 90.0 ELSE 45.0 END::DOUBLE AS bearing FROM part""")
def principal_bearing(spark, sf_dir):
    pt = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    line = F.when(F.col("p_size") % 4 == 0, F.array(pt(0, 0), pt(1, 0), pt(1, 1))).when(F.col("p_size") % 4 == 3, F.array(pt(0, 0), pt(0, -5))).otherwise(F.array(pt(0, 0), pt(2, 2), pt(1, 1)))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(G.principal_bearing(line), 6).alias("bearing"))


@query("""SELECT c_custkey, (c_custkey % 60)::BIGINT AS low, CASE WHEN c_custkey % 3 > 0 THEN ceil(c_custkey % 100 * 0.41::DOUBLE) ELSE 0 END::BIGINT AS gated,
  (c_custkey % 60 * 2 + CASE WHEN c_custkey % 3 > 0 THEN ceil(c_custkey % 100 * 0.41::DOUBLE) ELSE 0 END * (c_custkey % 3) * 2)::BIGINT AS ceiling FROM customer""")
def estimate_spend(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", G.spend(k % 100, k % 60, k % 3).alias("s")).select("c_custkey", "s.*")


@query("""
SELECT s_suppkey, 'RAIL ' || s_suppkey || ' CO' AS label, 'GROUP ' || s_nationkey AS group_key FROM supplier""")
def rail_gazetteer(spark, sf_dir):
    value = F.expr("""concat('{"bindings": {"rail. ', s_suppkey, ' co.": ["group ', s_nationkey, '"]}, "unbound": ["x"]}')""")
    s = table(spark, sf_dir, "supplier").select(value.alias("value"))
    g = D.gazetteer(s)
    return g.select(F.regexp_extract("label", r"(\d+)", 1).cast("long").alias("s_suppkey"), "label", "group_key")


@query("""
WITH l AS (SELECT DISTINCT l_orderkey AS page, l_linenumber AS ord, l_suppkey AS label FROM lineitem WHERE l_linenumber % 2 = 0), s AS (SELECT DISTINCT l_orderkey AS page, l_linenumber AS ord_s, l_partkey % 30 AS key FROM lineitem WHERE l_linenumber % 2 = 1),
g AS (SELECT s_suppkey AS label, s_nationkey AS group_key FROM supplier)
SELECT page, ord, ord_s, group_key, key FROM l JOIN g USING (label) JOIN s USING (page)""")
def rail_crossing_candidates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = li.filter("l_linenumber % 2 = 0").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("ord"), F.col("l_suppkey").alias("label")).distinct()
    b = li.filter("l_linenumber % 2 = 1").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("ord_s"), (F.col("l_partkey") % 30).alias("key")).distinct()
    g = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("label"), F.col("s_nationkey").alias("group_key"))
    return J.gazetteer_pairs(a, b, g, "page")


_LETTERS = "'Q' || translate(p_partkey::VARCHAR, '0123456789', 'ABCDEFGHIJ')"


@query(f"""
WITH p AS (SELECT p_partkey AS k, upper(p_name) AS n, {_LETTERS} AS w FROM part)
SELECT n || ' ST' AS old, w || ' AV' AS new FROM p WHERE k % 3 = 0
UNION ALL SELECT w || ' PL', n || ' ST' FROM p WHERE k % 3 = 1
UNION ALL SELECT w || 'X CT', n || ' ST' FROM p WHERE k % 3 = 1
UNION ALL SELECT 'FR', n || ' ST' FROM p WHERE k % 3 = 1
UNION ALL SELECT w || ' AV', 'SHAKES ' || w FROM p WHERE k % 3 = 2""")
def rename_pairs(spark, sf_dir):
    """A printed list of 300 parts a page: former names, streets with their former names, and entries over two lines.

    Clauses end at a full stop with a blank, so the one of "fr." is a short last name, as in the rule."""
    w = F.concat(F.lit("Q"), F.translate(F.col("p_partkey").cast("string"), "0123456789", "ABCDEFGHIJ"))
    n = F.col("p_name")
    former = F.array(F.concat(F.lit("-"), n, F.lit(" St., "), w, F.lit(" Avenue. Vacated.")))
    current = F.array(F.concat(n, F.lit(" St., 300N fr. 2200 to 2799N, "), w, F.lit(" Place, "), w, F.lit("x Ct. Vacated.")))
    broken = F.array(F.concat(F.lit("-"), w, F.lit(" Av.,  ")), F.lit(""), F.concat(F.lit("  Shakes "), w, F.lit(".")))
    k = F.col("p_partkey")
    lines = table(spark, sf_dir, "part").select(F.floor(k / 300).alias("page"), k.alias("k"), F.posexplode(F.when(k % 3 == 0, former).when(k % 3 == 1, current).otherwise(broken)).alias("j", "line"))
    return D.rename_pairs(lines, ["page"], ["k", "j"], "line").select("old", "new")


@query("""
SELECT o_custkey AS volume, list_sort(list(DISTINCT o_orderpriority)) AS keys, len(list(DISTINCT o_orderpriority)) > 3 AS merged FROM orders GROUP BY 1""")
def key_origins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("volume")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("keys"))
    return o.select("volume", "keys", (F.size("keys") > 3).alias("merged"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE [p_size + 50.0, 200.0 - 30, p_size + 60.0, 200.0 - 20] END::DOUBLE[] AS box, CASE WHEN p_size % 5 = 0 THEN 0 ELSE 1 END AS good FROM part""")
def annotation_frames(spark, sf_dir):
    """Labels with a damaged box are dropped, the others turned with their image."""
    bad = F.col("p_size") % 5 == 0
    s = F.col("p_size").cast("double")
    box = F.when(bad, F.array(s, s)).otherwise(F.array(F.lit(20.0), s + 50, F.lit(30.0), s + 60))
    label = F.struct(F.lit("A").alias("name"), box.alias("bbox"), F.lit("vertical").alias("orientation"), F.array(F.lit(0.0), F.lit(1.0)).alias("direction"))
    good = G.good_labels(F.array(label, F.lit(None).cast("struct<name:string,bbox:array<double>,orientation:string,direction:array<double>>")))
    turned = G.turned_labels(good, F.lit(270), F.lit(200.0), F.lit(200.0))
    return table(spark, sf_dir, "part").select("p_partkey", F.try_element_at(turned, F.lit(1))["bbox"].alias("box"), F.size(turned).alias("good"))


@query("""SELECT l_orderkey, round(max(l_quantity * 2 + 1), 6) AS x, count(*) + 3 AS n FROM lineitem GROUP BY 1""")
def model_corners(spark, sf_dir):
    m = G.model(*[F.lit(v) for v in (1.0, 2.0, 0.0, 0.0, 0.0, -2.0)])
    li = table(spark, sf_dir, "lineitem")
    point = F.struct(F.col("l_quantity").alias("px"), F.lit(0.0).alias("py"), (F.col("l_quantity") * 2).alias("x"), F.lit(0.0).alias("y"), F.lit(False).alias("synthetic"))
    g = li.groupBy("l_orderkey").agg(F.collect_list(point).alias("p"))
    moved = G.shifted(G.with_model_corners(F.col("p"), m, F.lit(0.5), F.lit(0.5)), F.lit(1.0), F.lit(0.0))
    own = F.filter(moved, lambda p: ~p["synthetic"])
    return g.select("l_orderkey", F.round(F.array_max(F.transform(own, lambda p: p["x"])), 6).alias("x"), F.size(moved).cast("long").alias("n"))


@query()
def volume_bootstrap(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", (F.col("l_quantity") > 40).alias("hit"))
    out = K.bootstrap(li, "l_returnflag", "l_suppkey", "hit")
    return out.select("l_returnflag", *[F.round(c, 9).alias(c) for c in ("share", "low", "high")])


@query()
def reachable_cells(spark, sf_dir):
    volume = F.floor(F.col("l_orderkey") / 1500) * 10 + F.col("l_suppkey") % 10  # volumes stay as large in any table
    return K.reachable(table(spark, sf_dir, "lineitem").select(volume.alias("volume"), (F.col("l_orderkey") % 200).alias("a"), (F.col("l_partkey") % 200).alias("b"), (F.col("l_linenumber") == 7).alias("is_start")), "volume", "is_start")


@query()
def stitched_chains(spark, sf_dir):
    """Orders as the rows of books: a header now and then, pairs whose new numbers grow with small steps, misreads among them.

    Each 600 orders have books of their own, so that a book stays as large in any table."""
    k = F.col("o_orderkey")
    place = F.floor(k / 10) % 60  # of the row in its book
    head, label = k % 7 == 3, k % 11 == 5
    new = F.when(k % 13 == 0, place).otherwise(1000 + place * 8 + F.col("o_custkey") % 2)
    return stitched(
        table(spark, sf_dir, "orders").select(
            (F.floor(k / 600) * 10 + k % 10).alias("book"), F.floor(place / 20).cast("int").alias("page"), (F.floor(place / 5) % 4).cast("int").alias("strip"),
            (place % 5 * 30.0).alias("y"), k.alias("ord"), F.when(head, "header").when(label, "label").otherwise("pair").alias("kind"),
            F.when(head, F.concat(F.lit("Q"), (k % 3).cast("string"), F.when(k % 2 == 0, " Street").otherwise(" Street CONTINUED"))).alias("text"), (k % 4 == 0).alias("cont"),
            F.when(k % 9 == 0, "disagree").otherwise("agreed").alias("status"), new.cast("long").alias("new"), (F.floor("o_totalprice") % 50 + place * 5).cast("long").alias("old"), F.lit("").alias("old_suffix"),
        ), ["book"],
    )


@query("""
WITH b AS (SELECT c_nationkey AS volume, c_acctbal / 100 AS x0, (c_custkey % 60)::DOUBLE AS y0, c_acctbal / 100 + 20 AS x1, (c_custkey % 60)::DOUBLE + 15 AS y1 FROM customer),
f AS (SELECT volume, min(x0) AS lx, min(y0) AS ly, greatest(max(x1) - min(x0), 1e-12) / 64 AS sx, greatest(max(y1) - min(y0), 1e-12) / 64 AS sy FROM b GROUP BY 1),
m AS (SELECT volume, i, j, lx + (i + 0.5::DOUBLE) * sx AS mx, ly + (j + 0.5::DOUBLE) * sy AS my FROM f, range(0, 64) a(i), range(0, 64) c(j)),
n AS (SELECT m.volume, i, j, count(*) AS n FROM m JOIN b ON b.volume = m.volume AND mx >= x0 AND mx < x1 AND my >= y0 AND my < y1 GROUP BY ALL)
SELECT volume, count(*) / 4096.0::DOUBLE AS covered, count(*) FILTER (n > 1) / 4096.0::DOUBLE AS overlapped FROM n GROUP BY 1""")
def volume_coverage(spark, sf_dir):
    x, y = F.col("c_acctbal") / 100, (F.col("c_custkey") % 60).cast("double")
    return K.covered(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("volume"), x.alias("x0"), y.alias("y0"), (x + 20).alias("x1"), (y + 15).alias("y1")), "volume")


@query()
def fit_diagnosis(spark, sf_dir):
    from .sequence_queries import candidates

    gates = K.Gates(scale=(0.0669, 0.0671), rotation=(-2.0, 2.0))
    return K.fit_diagnosis(candidates(spark, sf_dir), ["sheet"], ["i", "j"], gates, (5100.0, 7000.0))


@query("""
WITH c AS (SELECT l_suppkey, l_partkey, min(l_quantity) AS d FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY d, 'P' || l_partkey) AS r FROM c)
SELECT l_suppkey, string_agg('P' || l_partkey || ' (' || printf('%.1f', d) || ' m)', ' / ' ORDER BY r) AS rivals FROM r WHERE r <= 4 GROUP BY 1""")
def rivals(spark, sf_dir):
    """The nearest candidates of a proposal as one text."""
    c = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("name")).agg(F.min("l_quantity").alias("distance"))
    return J.rivals(c, "l_suppkey")


@query("""
WITH k AS (SELECT DISTINCT p_brand AS brand, p_name AS name FROM part), n AS (SELECT brand, string_agg(name || CASE WHEN length(name) % 3 = 0 THEN 's' ELSE '' END, ', ') AS note FROM k GROUP BY 1)
SELECT k.brand, k.name FROM k JOIN n USING (brand) WHERE regexp_matches(n.note, '(^|[^A-Za-z0-9])' || k.name || '($|[^A-Za-z0-9])')""")
def superseded_keys(spark, sf_dir):
    """Keys that the note of their list names as a whole word."""
    k = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name")).distinct()
    said = F.concat("name", F.when(F.length("name") % 3 == 0, "s").otherwise(""))
    notes = k.groupBy("brand").agg(F.array_join(F.array_sort(F.collect_list(said)), ", ").alias("note"))  # a list's names
    return J.superseded(k.withColumnRenamed("name", "key"), notes, ["brand"]).withColumnRenamed("key", "name")
