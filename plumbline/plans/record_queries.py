"""Queries over tolerant parsing, record transitions, upserts and index tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stages as S
from ..sources import documents as D
from .aggregate_queries import records
from .registry import query, table


@query("""SELECT event_id, (props::JSON->>'k')::INT AS k FROM events WHERE try_cast(props::JSON->>'k' AS INT) > 0""")
def json_tolerant(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", D.tolerant_int(F.col("props"), "$.k").alias("k"))
    return e.filter("k > 0")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN [event_id::INT, 7] WHEN 1 THEN [7] ELSE []::INT[] END AS numerals FROM events""")
def numerals_from_raw(spark, sf_dir):
    raw = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('{"address_numerals":[{"value":', event_id, ',"bbox":[0,0,1,1]},{"value":"7","bbox":[1,1,2,2]}]}')
      WHEN 1 THEN '{"address_numerals":[{"value":"x","bbox":[0,0,1,1]},{"value":7,"bbox":[0,0,1,1]},{"value":9,"bbox":[0]}, null]}' WHEN 2 THEN '{"address_numerals":"none"}' ELSE 'not json' END""")
    return table(spark, sf_dir, "events").select("event_id", F.transform(D.numerals_from_raw(raw), lambda n: n["value"]).alias("numerals"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 2 THEN NULL WHEN 0 THEN event_id::INT WHEN 1 THEN (event_id + 1)::INT ELSE (event_id + 2)::INT END AS k FROM events""")
def json_from_prose(spark, sf_dir):
    raw = F.expr("""CASE event_id % 5 WHEN 0 THEN concat('Here:\n```json\n{"k": ', event_id, '}\n```') WHEN 1 THEN concat('{"result": "{\\\\"k\\\\": ', event_id + 1, '}"}')
      WHEN 2 THEN 'nothing' WHEN 3 THEN concat('{"k": ', event_id + 2, '} rather than {"k": 0} or }') ELSE concat('So {"a": {"k": 1}, "result": {}, "k": ', event_id + 2, '} {') END""")
    return table(spark, sf_dir, "events").select("event_id", D.tolerant_int(D.json_from_prose(raw), "$.k").alias("k"))


@query("""
WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'OK' WHEN o_orderkey % 3 = 1 THEN 'REJECTED (no valid RANSAC model)' END AS status FROM orders WHERE o_orderkey % 2 = 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'OK (rescued)' ELSE 'REJECTED (no valid RANSAC model)' END AS status FROM orders WHERE o_orderkey % 5 <> 0)
SELECT o_orderkey, CASE WHEN n.status IS NULL OR (p.status LIKE 'OK%' AND n.status NOT LIKE 'OK%') THEN p.status ELSE n.status END AS status,
  NOT (n.status IS NULL OR (coalesce(p.status LIKE 'OK%', false) AND n.status NOT LIKE 'OK%')) AS took FROM p FULL JOIN n USING (o_orderkey)""")
def status_transition(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    p = o.filter("o_orderkey % 2 = 0").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'OK' WHEN o_orderkey % 3 = 1 THEN 'REJECTED (no valid RANSAC model)' END").alias("status"))
    n = o.filter("o_orderkey % 5 <> 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", S.RESCUED).otherwise(S.REJECTED).alias("status"))
    return S.transition(p, n, "o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'mine' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0""")
def upsert_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    disk = o.filter("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return S.upsert(disk, o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit("mine").alias("status")), ["o_orderkey"])


@query("""
WITH q AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 = 0), n AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 = 1)
SELECT * FROM q UNION ALL SELECT * FROM n WHERE o_custkey NOT IN (SELECT o_custkey FROM q WHERE o_orderstatus = 'O')""")
def queue_add(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return S.add_unless_live(o.filter("o_orderkey % 4 = 0"), o.filter("o_orderkey % 4 = 1"), "o_custkey", F.col("o_orderstatus") == "O")


@query("""
WITH s AS (SELECT o_orderkey, round((o_totalprice % 9) - 4, 3) AS tx, round((o_totalprice % 5) - 2, 3) AS ty, CASE WHEN o_orderkey % 2 = 0 THEN 1.5 ELSE 0 END AS ax FROM orders)
SELECT o_orderkey, round(CASE WHEN sqrt(tx * tx + ty * ty) >= 2 THEN tx - ax ELSE 0 END, 3) AS dx, round(CASE WHEN sqrt(tx * tx + ty * ty) >= 2 THEN ty ELSE 0 END, 3) AS dy FROM s WHERE abs(sqrt(tx * tx + ty * ty) - 2) > 0.001 AND sqrt((tx - ax) ** 2 + ty ** 2) > 0.02""")
def seam_shift(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    x, y = F.col("o_totalprice") % 9 - 4, F.col("o_totalprice") % 5 - 2
    ax = F.when(F.col("o_orderkey") % 2 == 0, 1.5)
    d = S.seam_shift(x, y, ax, F.lit(None).cast("double"))
    tx, ty = F.round(x, 3), F.round(y, 3)
    keep = (F.abs(F.hypot(tx, ty) - 2) > 0.001) & (F.hypot(tx - F.coalesce(ax, F.lit(0.0)), ty) > 0.02)
    return o.filter(keep).select("o_orderkey", F.round(d["dx"], 3).alias("dx"), F.round(d["dy"], 3).alias("dy"))


@query("""
SELECT l_suppkey, round(-quantile_disc(-l_extendedprice, 0.5) * 0.9, 4) AS scale_lo, round(-quantile_disc(-l_extendedprice, 0.5) * 1.1, 4) AS scale_hi, round(-quantile_disc(-l_quantity, 0.5) - 1.5, 4) AS rot_lo FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1""")
def derive_constraints(spark, sf_dir):
    """Windows about a volume's upper medians; pages off scale don't vote."""
    from ..operators.aggs import upper_median_of

    li = table(spark, sf_dir, "lineitem").filter("l_partkey % 10 <> 0")
    m = li.groupBy("l_suppkey").agg(upper_median_of("l_extendedprice").alias("s"), upper_median_of("l_quantity").alias("r"))
    w = S.windows(F.col("s"), F.col("r"))
    return m.select("l_suppkey", F.round(w["scale_lo"], 4).alias("scale_lo"), F.round(w["scale_hi"], 4).alias("scale_hi"), F.round(w["rot_lo"], 4).alias("rot_lo"))


@query("""
WITH r AS (SELECT o_custkey % 100 AS page, o_orderkey, o_orderstatus = 'F' AND o_totalprice > 300000 AS ok, o_totalprice FROM orders)
SELECT page, CASE WHEN bool_or(ok) THEN min(o_orderkey) FILTER (ok) ELSE max(o_orderkey) END AS tier, bool_or(ok) AS succeeded FROM r GROUP BY 1""")
def first_success(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("page"), F.col("o_orderkey").alias("tier"), "o_orderstatus", "o_totalprice")
    t = S.first_success(o, ["page"], "tier", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000))
    return t.select("page", "tier", "succeeded")


@query("""
WITH k AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0 UNION SELECT o_custkey FROM orders WHERE o_orderkey % 9 = 0)
SELECT k, (SELECT count(*) FROM orders WHERE o_custkey = k) AS n0, o.sheets, o.newest, c.seg FROM k LEFT JOIN (SELECT o_custkey, count(*) AS sheets, max(o_orderkey) AS newest FROM orders GROUP BY 1) o ON o.o_custkey = k LEFT JOIN (SELECT c_custkey, max(c_mktsegment) AS seg FROM customer GROUP BY 1) c ON c.c_custkey = k""")
def status_index(spark, sf_dir):
    o, c = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    keys = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k")).union(o.filter("o_orderkey % 9 = 0").select("o_custkey"))
    by = o.withColumnRenamed("o_custkey", "k")
    facts = {"sheets": (by, F.count(F.lit(1))), "newest": (by, F.max("o_orderkey")), "seg": (c.withColumnRenamed("c_custkey", "k"), F.max("c_mktsegment"))}
    return S.status_index(keys, facts, "k").withColumn("n0", F.coalesce("sheets", F.lit(0)))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'missing' WHEN o_orderkey % 7 > o_orderkey % 5 THEN 'stale' END AS why FROM orders""")
def serve_staleness(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.staleness(k % 7, F.when(k % 3 != 0, k % 5)).alias("why"))


@query("""SELECT o_orderkey AS page, o_totalprice / 20000 AS rmse_m FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0""")
def load_scores(spark, sf_dir):
    """Scores of records that have changed since drop out, by digest."""
    r = records(spark, sf_dir).select("page", S.digest("page", "status").alias("digest"), "rmse_m")
    changed = r.select("page", F.when(F.col("page") % 4 == 0, "old").otherwise(F.col("digest")).alias("digest"), "rmse_m").filter("rmse_m is not null")
    return S.current_scores(r.drop("rmse_m"), changed, "page")


@query("""
SELECT status, count(*) AS n, count(*) FILTER (status LIKE 'OK%') AS committed, any_value(CASE WHEN status LIKE 'OK (verified%' THEN 'OK (verified: address+junction)' END) AS spelt FROM (
  SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'OK (rescued, neighbor-corroborated)' WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'OK (rescued)'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'OK (verified: address+junction)' WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'OK (reviewer-verified)'
  WHEN o_orderstatus = 'F' THEN 'OK' WHEN o_orderstatus = 'O' THEN 'REJECTED (rescue revoked: anchors share one street)' ELSE 'REJECTED (no valid RANSAC model)' END AS status FROM orders) GROUP BY 1""")
def status_predicates(spark, sf_dir):
    spelt = S.status_verified(F.array(F.lit("address"), F.lit("junction")))
    r = records(spark, sf_dir)
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(S.is_committed(F.col("status"))).alias("committed"), F.max(F.when(F.col("status") == spelt, spelt)).alias("spelt"))


@query("""
SELECT doc_id % 50 AS page, max(doc_id) AS doc_id, arg_max(source, doc_id) AS source FROM documents GROUP BY 1""")
def last_page_wins(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).alias("page"), "doc_id", "source")
    return d.groupBy("page").agg(F.max("doc_id").alias("doc_id"), F.max_by("source", "doc_id").alias("source"))


@query("""
SELECT s_nationkey AS volume, to_json(list({'page': s_suppkey::VARCHAR, 'name': s_name} ORDER BY s_suppkey))::VARCHAR AS items, count(*) AS n FROM supplier GROUP BY 1""")
def annotation_page(spark, sf_dir):
    """One JSON document a volume, its items in natural page order."""
    return D.item_page(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("volume"), F.col("s_suppkey").cast("string").alias("page"), F.col("s_name").alias("name")), "volume")
