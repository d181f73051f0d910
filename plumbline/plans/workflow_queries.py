"""Queries over records on their way: rescue, eras, backlog, advice, gates and priors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pages as P
from ..operators import joins as J
from ..operators import rescue as R
from ..operators import stages as T
from .registry import query, table


@query()
def rescue(spark, sf_dir):
    """Orders as sheets, their line items as candidates, most of which agree on one translation."""
    k = F.col("o_orderkey")
    status = F.when(k % 5 == 0, "OK").when(k % 11 == 0, T.REVOKED).otherwise(T.REJECTED)
    own = F.when(k % 2 == 0, 12.0 + k % 30)
    records = table(spark, sf_dir, "orders").select(F.floor(k / 200).alias("volume"), k.alias("page"), status.alias("status"), F.lit(0.067).alias("scale"), F.lit(0.0).alias("rotation"), own.alias("own_rotation"))
    px, py = F.col("l_quantity") * 100, (F.col("l_partkey") % 70) * 100.0
    street = lambda n: F.concat(F.when(F.col("l_partkey") % 9 == 0, "RR ").otherwise(""), F.lit("S"), (n % 4).cast("string"))
    turned = F.col("l_orderkey") % 3 == 0  # by the own rotation
    angle = F.radians(F.when(turned, 12.0 + F.col("l_orderkey") % 30).otherwise(0.0))
    c, s = F.cos(angle) * 0.067, F.sin(angle) * 0.067
    stray = F.when(F.col("l_partkey") % 4 == 0, 500.0).otherwise((F.col("l_partkey") % 3) * 1.0)
    li = table(spark, sf_dir, "lineitem")
    cands = li.select(
        F.floor(F.col("l_orderkey") / 200).alias("volume"), F.col("l_orderkey").alias("page"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("ord"), px.alias("px"), py.alias("py"),
        (1000 + c * px + s * py + stray).alias("x"), (2000 + s * px - c * py).alias("y"), street(F.col("l_suppkey")).alias("street_a"), street(F.col("l_suppkey") + 1 + F.col("l_linenumber") % 2).alias("street_b"),
    )
    out = R.rescue(records, cands.distinct(), "volume", "page", quadrants=True)
    return out.drop("volume").withColumns({c: F.round(c, 6) for c in ("dx", "dy", "turned")})


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, list_sort([l_suppkey % 5, (l_suppkey + 1 + l_partkey % 3) % 5]) AS s FROM lineitem),
a AS (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 'OK' ELSE 'OK (rescued)' END AS status FROM lineitem GROUP BY 1),
d AS (SELECT x.l_orderkey, bool_or(NOT list_has_any(x.s, y.s)) AS disjoint FROM l x JOIN l y USING (l_orderkey) GROUP BY 1)
SELECT l_orderkey, CASE WHEN status = 'OK (rescued)' AND NOT disjoint THEN 'REJECTED (rescue revoked: anchors share one street)' ELSE status END AS status FROM a JOIN d USING (l_orderkey)""")
def revoked_rescues(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pair = F.array((F.col("l_suppkey") % 5), ((F.col("l_suppkey") + 1 + F.col("l_partkey") % 3) % 5))
    r = li.groupBy("l_orderkey").agg(F.collect_set(F.array_sort(pair)).alias("anchors"))
    r = r.withColumn("status", F.when(F.col("l_orderkey") % 3 == 0, "OK").otherwise(T.RESCUED))
    return R.revoke_shared(r, "anchors").select("l_orderkey", "status")


@query("""
WITH v AS (SELECT c_custkey AS volume, CASE WHEN c_custkey % 7 = 0 THEN c_custkey % 2 = 0 END AS declared, c_custkey % 5 > 0 AS has_table, CASE WHEN c_custkey % 4 > 0 THEN 1998 END AS table_year, (SELECT max(year(o_orderdate)) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS y FROM customer),
r AS (SELECT *, CASE WHEN declared IS NOT NULL THEN NULL WHEN NOT has_table THEN 'no renumbering table' WHEN table_year IS NULL THEN 'no renumbering year' WHEN y IS NULL THEN 'no edition year' WHEN y = table_year THEN 'dated in the renumbering year' END AS refusal FROM v)
SELECT volume, CASE WHEN declared IS NOT NULL THEN declared WHEN refusal IS NULL THEN y > table_year END AS modern, refusal, CASE WHEN coalesce(declared, true) THEN 'modern' ELSE 'renumbered' END AS era FROM r""")
def era_proposal(spark, sf_dir):
    k = F.col("c_custkey")
    year = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.year("o_orderdate")).alias("y"))
    c = table(spark, sf_dir, "customer").select("c_custkey").join(year, "c_custkey", "left")
    declared = F.when(k % 7 == 0, k % 2 == 0)
    era = T.proposed_era(declared, k % 5 > 0, F.when(k % 4 > 0, 1998), F.col("y"))
    return c.select(k.alias("volume"), era.alias("e"), T.era_of(declared).alias("era")).select("volume", "e.*", "era")


_VOLUMES = """WITH v AS (SELECT c_custkey AS volume, c_custkey % 6 AS sheets, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 5 END AS results, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 3 = 0 END AS ours FROM customer)"""


@query(_VOLUMES + """, q AS (SELECT o_custkey AS volume, CASE o_orderkey % 3 WHEN 0 THEN 'queued' WHEN 1 THEN 'done' ELSE 'running' END AS status FROM orders WHERE o_orderstatus = 'P')
SELECT volume, CASE WHEN coalesce(results, 0) < sheets THEN 'place' ELSE 'serve' END AS track, coalesce(results > 1, false) AS runnable FROM v
WHERE sheets > 0 AND volume NOT IN (SELECT volume FROM q WHERE status <> 'done') AND (coalesce(results, 0) < sheets OR NOT coalesce(ours, false))""")
def backlog(spark, sf_dir):
    k = F.col("c_custkey")
    v = table(spark, sf_dir, "customer").select(k.alias("volume"), (k % 6).alias("sheets"), F.when(k % 4 > 0, k % 5).alias("results"), F.when(k % 7 > 0, k % 3 == 0).alias("ours"))
    status = F.when(F.col("o_orderkey") % 3 == 0, "queued").when(F.col("o_orderkey") % 3 == 1, "done").otherwise("running")
    q = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("volume"), status.alias("status"))
    return T.backlog(v, q, F.col("status").isin("queued", "running"), F.col("results") > 1)


@query("""
WITH q AS (SELECT 'V' || o_custkey AS volume, CASE WHEN o_orderkey % 2 = 0 THEN 'place' ELSE 'serve' END AS track, o_orderkey AS id FROM orders)
SELECT volume, track, id FROM q WHERE NOT (volume = 'V7') AND NOT (volume = 'V8' AND track = 'place')""")
def queue_remove(spark, sf_dir):
    q = table(spark, sf_dir, "orders").select(F.concat(F.lit("V"), F.col("o_custkey").cast("string")).alias("volume"), F.when(F.col("o_orderkey") % 2 == 0, "place").otherwise("serve").alias("track"), F.col("o_orderkey").alias("id"))
    return T.without_entries(T.without_entries(q, "V7"), "V8", "place")


@query("""
WITH s AS (SELECT l_suppkey AS volume, count(*) AS reads, avg((l_quantity > 15)::INT) AS rate, count(DISTINCT l_orderkey) AS pages, count(DISTINCT CASE WHEN l_quantity < 5 THEN l_orderkey END) AS empty FROM lineitem GROUP BY 1)
SELECT volume, list_filter([CASE WHEN rate < 0.8 AND reads >= 100 THEN round_even(rate * 100, 0)::BIGINT || '% of ' || reads || ' street reads match' END,
  CASE WHEN pages >= 10 AND empty / pages::DOUBLE >= 0.1 THEN empty || ' of ' || pages || ' pages have no candidates' END], lambda x: x IS NOT NULL) AS advice FROM s""")
def alias_gap(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("volume")).agg(
        F.count(F.lit(1)).alias("reads"), F.avg((F.col("l_quantity") > 15).cast("int")).alias("rate"), F.count_distinct("l_orderkey").alias("pages"),
        F.count_distinct(F.when(F.col("l_quantity") < 5, F.col("l_orderkey"))).alias("empty"),
    )
    return s.select("volume", T.alias_gap(F.col("rate"), F.col("reads"), F.col("empty"), F.col("pages")).alias("advice"))


@query("""
WITH r AS (SELECT o_orderkey AS page, CASE o_orderkey % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'REJECTED (rescue revoked: anchors share one street)' ELSE 'REJECTED (no valid RANSAC model)' END AS status FROM orders),
m AS (SELECT l_orderkey AS page, count(*) AS junctions FROM lineitem GROUP BY 1)
SELECT page, junctions FROM r JOIN m USING (page) WHERE status LIKE 'REJECTED (no%' AND junctions >= 4""")
def gated_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    r = table(spark, sf_dir, "orders").select(k.alias("page"), F.when(k % 4 == 0, "OK").when(k % 4 == 1, T.REVOKED).otherwise(T.REJECTED).alias("status"))
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.count(F.lit(1)).alias("junctions"))
    return T.gated(r, m, "page", 4)


@query("""SELECT DISTINCT 'xbd' || (c_custkey % 90) AS id FROM customer WHERE c_custkey % 3 = 0 AND (c_custkey % 90) IN (SELECT s_suppkey % 60 FROM supplier)""")
def lost_sheets(spark, sf_dir):
    k = F.col("c_custkey")
    ident = F.when(k % 3 == 0, F.concat(F.lit("xbd"), (k % 90).cast("string"))).otherwise((k % 90 + 1).cast("string"))
    images = table(spark, sf_dir, "customer").select(F.concat(F.lit("vol_p"), ident).alias("stem"))
    recorded = table(spark, sf_dir, "supplier").select(F.concat(F.lit("xbd"), (F.col("s_suppkey") % 60).cast("string")).alias("page"))
    return T.lost(images, recorded, "stem", P.page_from_slug(F.col("stem")))


@query("""
SELECT round(min(c_acctbal) - 0.01, 6) AS x0, round(min(c_custkey % 100) - 0.01, 6)::DOUBLE AS y0, round(max(c_acctbal) + 0.01, 6) AS x1, round(max(c_custkey % 100) + 0.01, 6)::DOUBLE AS y1
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey IN (1, 2)""")
def area_bounds(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    f = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.lower("n_name").alias("name"), F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 100).cast("double").alias("y"))
    w = n.filter("n_nationkey in (1, 2)").select(F.concat(F.lit(" "), "n_name").alias("name"))
    b = J.area_bounds(f, w)
    return b.select(*[F.round(c, 6).alias(c) for c in b.columns])


@query("""
WITH e AS (SELECT o_orderkey AS id, o_custkey AS page, 'Brand#' || (o_orderkey % 25 + 1) AS street, (o_orderkey % 4900)::INT + 50 AS value FROM orders),
s AS (SELECT p_partkey AS seg, p_brand AS street, p_size * 100 AS lo, p_size * 100 + 98 AS hi, (p_size * 10 + p_partkey % 7)::DOUBLE AS x0, (p_partkey % 300)::DOUBLE AS y0 FROM part),
h AS (SELECT id, page, seg, x0 + 50.0::DOUBLE * (value - lo) / (hi - lo) AS x, y0 AS y FROM e JOIN s USING (street) WHERE value BETWEEN lo AND hi AND value % 2 = 0),
n AS (SELECT *, count(*) OVER (PARTITION BY page, id) AS n FROM h),
c AS (SELECT page, coalesce(avg(x) FILTER (n = 1), avg(x)) AS cx, coalesce(avg(y) FILTER (n = 1), avg(y)) AS cy FROM n GROUP BY 1),
p AS (SELECT page, id, arg_min(struct_pack(x, y), struct_pack(d, seg)) AS b FROM (SELECT n.*, sqrt((x - cx) ** 2 + (y - cy) ** 2) AS d FROM n JOIN c USING (page)) GROUP BY 1, 2),
w AS (SELECT page, avg(b.x) AS x, avg(b.y) AS y, count(*) AS entries FROM p GROUP BY 1), f AS (SELECT DISTINCT a.page FROM p a JOIN p z USING (page) WHERE sqrt((a.b.x - z.b.x) ** 2 + (a.b.y - z.b.y) ** 2) > 250)
SELECT page, round(x, 6) AS x, round(y, 6) AS y, entries FROM w WHERE page NOT IN (SELECT page FROM f)""")
def index_priors(spark, sf_dir):
    text = lambda c: c.cast("string")
    h, k = F.col("p_size") * 100, F.col("p_partkey")
    x = (F.col("p_size") * 10 + k % 7).cast("double")
    s = table(spark, sf_dir, "part").select(
        k.alias("seg"), F.col("p_brand").alias("street_key"), text(h).alias("l_from"), text(h + 98).alias("l_to"), F.lit(None).cast("string").alias("r_from"), F.lit(None).cast("string").alias("r_to"),
        F.lit("E").alias("l_parity"), F.lit(None).cast("string").alias("r_parity"), x.alias("x0"), (k % 300).cast("double").alias("y0"), (x + 50).alias("x1"), (k % 300).cast("double").alias("y1"),
    )
    middle = F.col("o_orderkey") % 4900 + 50
    e = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("page"), F.concat(F.lit("Brand#"), text(F.col("o_orderkey") % 25 + 1)).alias("street_key"), (middle - 20).alias("first"), (middle + 21).alias("last"),
    )
    w = J.index_priors(e, s, None, radius=250.0)
    return w.select("page", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "entries")
