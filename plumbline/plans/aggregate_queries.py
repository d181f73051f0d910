"""Queries over ordered aggregates, votes, conflict rules, rollups and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.names import normalize
from ..operators import aggs as A
from ..operators import stages as S
from .registry import query, table


@query("SELECT l_suppkey, -quantile_disc(-l_extendedprice, 0.5) AS upper_median, quantile_disc(l_extendedprice, 0.9) AS p90, median(l_extendedprice) AS middle FROM lineitem GROUP BY 1")
def ordered_aggregates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        A.upper_median_of("l_extendedprice").alias("upper_median"), A.p90_of("l_extendedprice").alias("p90"), F.median("l_extendedprice").alias("middle")
    )


@query("SELECT l_returnflag, round(quantile_cont(l_quantity, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.975), 6) AS p975, round(sqrt(avg(l_tax * l_tax)), 8) AS rms FROM lineitem GROUP BY 1")
def interpolated_percentile(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.percentile("l_quantity", 0.25), 6).alias("p25"), F.round(F.percentile("l_extendedprice", 0.975), 6).alias("p975"), F.round(A.rms(F.col("l_tax")), 8).alias("rms")
    )


_STATUS = """CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'OK (rescued, neighbor-corroborated)' WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'OK (rescued)'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'OK (verified: address+junction)' WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'OK (reviewer-verified)'
  WHEN o_orderstatus = 'F' THEN 'OK' WHEN o_orderstatus = 'O' THEN 'REJECTED (rescue revoked: anchors share one street)' ELSE 'REJECTED (no valid RANSAC model)' END"""


def records(spark, sf_dir):
    """Orders as placement records: volume, page, status, residual, score, rotation."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 40).alias("volume"), F.col("o_orderkey").alias("page"), F.expr(_STATUS).alias("status"), (F.col("o_totalprice") / 50000).alias("residual_m"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") / 20000).alias("rmse_m"), ((F.col("o_orderkey") % 21) / 10.0).alias("rotation_deg"),
    )


@query(f"""
WITH r AS (SELECT o_custkey % 40 AS volume, {_STATUS} AS status, o_totalprice / 50000 AS res, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 20000 END AS rmse, (o_orderkey % 21) / 10.0::DOUBLE AS rot FROM orders),
x AS (SELECT *, status LIKE 'OK%' AND status <> 'OK (reviewer-verified)' AS ok FROM r)
SELECT volume, count(*) AS n_sheets, count(*) FILTER (status = 'OK') AS strict_accepted, count(*) FILTER (status = 'OK (rescued)') AS rescued, count(*) FILTER (status = 'OK (rescued, neighbor-corroborated)') AS corroborated,
  count(*) FILTER (status LIKE 'OK (verified%') AS verified, count(*) FILTER (status = 'OK (reviewer-verified)') AS reviewer_verified, count(*) FILTER (status LIKE 'REJECTED (rescue revoked%') AS revoked,
  count(*) FILTER (status LIKE 'REJECTED%') AS flagged, round(median(res) FILTER (ok), 4) AS median_residual_m, round(quantile_disc(res, 0.9) FILTER (ok), 4) AS p90_residual_m,
  round(median(rmse) FILTER (ok), 4) AS median_rmse_m, count(rmse) FILTER (ok) AS scored, count(*) FILTER (ok AND rmse IS NULL) AS unscored, count(*) FILTER (ok AND rmse > 15) AS over_gate,
  min(rot) FILTER (ok) AS rotation_min, max(rot) FILTER (ok) AS rotation_max FROM x GROUP BY 1""")
def report_funnel(spark, sf_dir):
    return S.build_report(records(spark, sf_dir))


@query("""
WITH c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal > 8000 THEN 'served' WHEN c_acctbal > 4000 THEN 'processed-unserved' WHEN c_acctbal > 0 THEN 'ready' ELSE 'no-scans' END AS state,
  CASE WHEN c_custkey % 11 = 0 THEN ['(footprint unknown)'] WHEN c_custkey % 2 = 0 THEN [c_mktsegment] ELSE [c_mktsegment, 'NATION_' || c_nationkey] END AS areas, c_custkey % 7 AS sheets FROM customer),
u AS (SELECT unnest(areas) AS area, state, sheets FROM c)
SELECT area, area = '(footprint unknown)' AS last, count(*) AS volumes, count(*) FILTER (state = 'served') AS served, count(*) FILTER (state = 'processed-unserved') AS processed_unserved, count(*) FILTER (state = 'ready') AS ready,
  count(*) FILTER (state = 'no-scans') AS no_scans, sum(sheets)::BIGINT AS sheets FROM u GROUP BY 1""")
def rollup_multi_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    state = S.coverage_state(F.col("c_acctbal") > 8000, F.col("c_acctbal") > 4000, F.col("c_acctbal") > 0)
    areas = F.when(F.col("c_custkey") % 11 == 0, F.array(F.lit(S.UNLOCATED))).when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment")).otherwise(F.array("c_mktsegment", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))))
    rows = c.select(areas.alias("areas"), state.alias("state"), (F.col("c_custkey") % 7).alias("sheets"))
    return S.rollup(rows, "areas", "area")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'served' WHEN o_orderstatus = 'F' THEN 'processed-unserved' WHEN o_orderpriority < '3' THEN 'ready' ELSE 'no-scans' END AS state FROM orders""")
def coverage_state(spark, sf_dir):
    s = S.coverage_state(F.col("o_totalprice") > 400000, F.col("o_orderstatus") == "F", F.col("o_orderpriority") < "3")
    return table(spark, sf_dir, "orders").select("o_orderkey", s.alias("state"))


@query("""
WITH k AS (SELECT DISTINCT upper(replace(p_name, ' ', '')) AS key FROM part WHERE p_size > 10), r AS (SELECT p_brand, upper(replace(p_name, ' ', '')) AS key FROM part)
SELECT p_brand, count(*) AS reads, count(*) FILTER (key IN (SELECT key FROM k)) AS matched, count(DISTINCT key) FILTER (key NOT IN (SELECT key FROM k)) AS unmatched_names FROM r GROUP BY 1""")
def name_match_rate(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = normalize(F.concat(F.regexp_replace("p_name", " ", ""), F.lit(" Ave.")))
    keys = p.filter("p_size > 10").select(key.alias("key")).distinct().withColumn("known", F.lit(True))
    r = p.select("p_brand", key.alias("key")).join(keys, "key", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return r.groupBy("p_brand").agg(F.count(F.lit(1)).alias("reads"), F.count_if("known").alias("matched"), F.count_distinct(F.when(~F.col("known"), F.col("key"))).alias("unmatched_names"))


@query("""SELECT l_orderkey, l_linenumber, min(l_suppkey) AS l_suppkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_suppkey) = 1""")
def dedupe_conflict(spark, sf_dir):
    return A.dedupe_conflict(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_suppkey", "l_partkey")


_READ = "SELECT DISTINCT event_id // 3000 * 20 + user_id % 20 AS sheet, event_type AS model, (event_id % 30)::INT AS value, floor(value)::INT AS lo, floor(value)::INT + 6 AS hi FROM events"


@query(f"""WITH r AS ({_READ}) SELECT a.sheet, a.model, a.value, a.lo, a.hi, count(DISTINCT b.model) AS agree FROM r a JOIN r b USING (sheet, value) WHERE a.lo < b.hi AND b.lo < a.hi GROUP BY ALL HAVING count(DISTINCT b.model) >= 2""")
def consensus_k_of_n(spark, sf_dir):
    return A.consensus(readings(table(spark, sf_dir, "events")), ["sheet", "value"], "model", "lo", "hi", 6)


def readings(e):
    """Events as readings. Each 3000 events have sheets of their own, so that a sheet stays as large in any table."""
    lo = F.floor("value").cast("int")
    sheet = F.floor(F.col("event_id") / 3000) * 20 + F.col("user_id") % 20
    return e.select(sheet.alias("sheet"), F.col("event_type").alias("model"), (F.col("event_id") % 30).cast("int").alias("value"), lo.alias("lo"), (lo + 6).alias("hi")).distinct()


@query()
def first_readings(spark, sf_dir):
    """The consensus with its greedy step: a reading that repeats an accepted one is passed over, in model order."""
    from ..operators.kernels import first_agreed

    return first_agreed(readings(table(spark, sf_dir, "events")), ["sheet"], least=2)


_TALLY = """SELECT user_id AS page, count(*) AS hints, count(*) FILTER (value > 10) AS votable, count(*) FILTER (value > 10 AND value < 60) AS inside, max(value) AS worst,
  count(DISTINCT event_type) AS models, count(*) FILTER (value <= 1) AS era_failures, count(*) FILTER (value <= 10 AND value > 1) AS unmatched FROM events GROUP BY 1"""


def tallies(spark, sf_dir):
    v = F.col("value")
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("page")).agg(
        F.count(F.lit(1)).alias("hints"), F.count_if(v > 10).alias("votable"), F.count_if((v > 10) & (v < 60)).alias("inside"), F.max(v).alias("worst"),
        F.count_distinct("event_type").alias("models"), F.count_if(v <= 1).alias("era_failures"), F.count_if((v <= 10) & (v > 1)).alias("unmatched"),
    )


@query(f"""WITH t AS ({_TALLY}) SELECT page, CASE WHEN votable >= 3 AND inside = 0 THEN false WHEN inside >= 3 AND 2 * inside > votable AND worst <= 200 THEN true END AS vote FROM t""")
def tri_state_vote(spark, sf_dir):
    t = tallies(spark, sf_dir)
    return t.select("page", A.tri_state_vote(F.col("votable"), F.col("inside"), F.col("worst"), 3, 2.0, 100.0).alias("vote"))


@query(f"""WITH t AS ({_TALLY}) SELECT page, CASE WHEN models < 2 THEN 'fewer_than_2_successful_distinct_model_readings' WHEN hints = 0 THEN 'no_cross_model_consensus_numeral' WHEN era_failures > 1 THEN 'no_usable_era_conversion'
  WHEN unmatched > 4 THEN 'no_matching_addressable_centerline_segment' WHEN votable < 8 THEN 'fewer_than_3_votable_numerals' WHEN worst > 150 THEN 'mixed_contradictory_evidence' ELSE 'enough_votable_insufficient_in_block_support' END AS reason FROM t""")
def abstention_class(spark, sf_dir):
    c = [F.col("models"), F.col("hints"), F.col("hints"), F.col("era_failures") - 1, F.col("unmatched") - 4, F.col("votable"), F.col("worst") > 150]
    return tallies(spark, sf_dir).select("page", A.abstention_class(*c, least=8).alias("reason"))


@query("""
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN NULL ELSE true END AS a, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false END AS j, CASE WHEN o_orderkey % 7 < 3 THEN true END AS c FROM orders)
SELECT o_orderkey, (coalesce(a, false)::INT + coalesce(j, false)::INT + coalesce(c, false)::INT) >= 2 AND j IS DISTINCT FROM false AS accept,
  list_sort(list_filter([CASE WHEN a THEN 'addresses' END, CASE WHEN j THEN 'junction' END, CASE WHEN c THEN 'corroboration' END], lambda x: x IS NOT NULL)) AS yes FROM v""")
def decide_channels(spark, sf_dir):
    k = F.col("o_orderkey")
    votes = F.create_map(F.lit("addresses"), F.when(k % 3 != 1, True), F.lit("junction"), F.when(k % 5 == 0, True).when(k % 5 == 1, False), F.lit("corroboration"), F.when(k % 7 < 3, True))
    d = A.decide(votes, 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", d["accept"].alias("accept"), d["yes"].alias("yes"))


@query("""
WITH n AS (SELECT DISTINCT o_custkey AS page, o_orderkey % 50 AS name FROM orders), c AS (SELECT DISTINCT s_suppkey % 50 AS name, (s_nationkey // 2)::BIGINT AS cx, (s_suppkey % 3)::BIGINT AS cy FROM supplier),
d AS (SELECT DISTINCT name, cx + i AS cx, cy + j AS cy FROM c, range(-1, 2) a(i), range(-1, 2) b(j)),
t AS (SELECT page, count(*) AS n_names FROM n GROUP BY 1), v AS (SELECT page, cx, cy, count(*) AS votes FROM n JOIN d USING (name) GROUP BY 1, 2, 3)
SELECT page, n_names, cx, cy, votes FROM v JOIN t USING (page) WHERE votes >= ceil(n_names * 0.6)""")
def cell_vote(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = o.select(F.col("o_custkey").alias("page"), (F.col("o_orderkey") % 50).alias("name")).distinct()
    c = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 50).alias("name"), F.struct(F.floor(F.col("s_nationkey") / 2).alias("cx"), (F.col("s_suppkey") % 3).alias("cy")).alias("c")).distinct()
    cells = c.select("name", F.explode(G.dilated(F.array("c"))).alias("c")).select("name", "c.cx", "c.cy")
    return A.cell_votes(n, cells, "page").select("page", "n_names", "cx", "cy", "votes")


@query("""
WITH c AS (SELECT l_suppkey AS volume, l_orderkey * 10 + l_linenumber AS page, l_extendedprice AS x, l_quantity AS y FROM lineitem),
m AS (SELECT volume, -quantile_disc(-x, 0.5) AS mx, -quantile_disc(-y, 0.5) AS my FROM c GROUP BY 1)
SELECT volume, count(*) AS pages, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM c JOIN m USING (volume) WHERE abs(x - mx) <= 10000 AND abs(y - my) <= 10000 GROUP BY 1""")
def outlier_bounds(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("volume"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("page"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))
    k = A.without_outliers(c, 10000.0)
    return k.groupBy("volume").agg(F.count(F.lit(1)).alias("pages"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


@query("""
WITH a AS (SELECT user_id % 25 AS sheet, round(value, 0)::DOUBLE % 180 AS a, count(*) AS k FROM events GROUP BY 1, 2),
p AS (SELECT x.sheet, x.a, y.k, abs(((y.a - x.a + 90) % 180 + 180) % 180 - 90) AS dev FROM a x JOIN a y USING (sheet)),
s AS (SELECT sheet, a, sum(k)::BIGINT AS n, round(sum(dev * k), 6) AS spread FROM p WHERE dev <= 5 GROUP BY 1, 2)
SELECT sheet, a AS angle, n, spread FROM s QUALIFY row_number() OVER (PARTITION BY sheet ORDER BY n DESC, spread, a) = 1""")
def densest_angle(spark, sf_dir):
    a = table(spark, sf_dir, "events").select((F.col("user_id") % 25).alias("sheet"), F.round("value", 0).alias("angle"))
    return A.densest_angle(a, "sheet", "angle", 5.0)


@query("""
WITH a AS (SELECT 'P' || p_partkey AS key, 'S' || (p_partkey % 150) AS value FROM part UNION ALL SELECT 'S5', 'P7' UNION ALL SELECT 'Q', 'S3'), i AS (SELECT 'S' || s_suppkey AS key FROM supplier)
SELECT 'unknown' AS kind, key FROM a WHERE value NOT IN (SELECT key FROM i) UNION ALL SELECT 'shadow', key FROM a WHERE key IN (SELECT key FROM i)
UNION ALL SELECT 'chain', key FROM a WHERE value IN (SELECT key FROM a) UNION ALL SELECT 'merge', key FROM a WHERE value IN (SELECT value FROM a GROUP BY 1 HAVING count(*) > 1)""")
def alias_violations(spark, sf_dir):
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    a = table(spark, sf_dir, "part").select(text("P", F.col("p_partkey")).alias("key"), text("S", F.col("p_partkey") % 150).alias("value"))
    a = a.union(spark.sql("VALUES ('S5', 'P7'), ('Q', 'S3')"))
    return A.violations(a, table(spark, sf_dir, "supplier").select(text("S", F.col("s_suppkey")).alias("key")))


@query("""
WITH e AS (SELECT p_partkey AS id, p_brand AS street, p_size * 40 AS old_lo, p_size * 40 + 60 AS old_hi, p_size * 40 + 3000 + (p_partkey % 3) * 3 AS new_lo FROM part)
SELECT id FROM e WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.street = e.street AND b.id <> e.id AND e.old_lo <= b.old_hi AND b.old_lo <= e.old_hi AND abs((e.new_lo - e.old_lo) - (b.new_lo - b.old_lo)) > 4)""")
def agreeing_ranges(spark, sf_dir):
    s = F.col("p_size") * 40
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("street"), s.alias("old_lo"), (s + 60).alias("old_hi"), (s + 3000 + F.col("p_partkey") % 3 * 3).alias("new_lo"))
    return A.agreeing_ranges(e, 100).select("id")


@query("""
WITH e AS (SELECT s_nationkey AS a, s_suppkey % 25 AS b FROM supplier), u AS (SELECT a AS node, b AS other FROM e WHERE a <> b UNION ALL SELECT b, a FROM e WHERE a <> b)
SELECT node, count(*) AS degree, count(DISTINCT other) AS others FROM u GROUP BY 1 HAVING count(*) >= 3 OR (count(*) = 2 AND count(DISTINCT other) = 2)""")
def node_degrees(spark, sf_dir):
    e = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("a"), (F.col("s_suppkey") % 25).alias("b")).filter("a <> b")
    u = e.select(F.col("a").alias("node"), F.col("b").alias("other")).union(e.select("b", "a"))
    d = u.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), F.count_distinct("other").alias("others"))
    return d.filter("degree >= 3 or (degree = 2 and others = 2)")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders)
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM o GROUP BY 1""")
def latest_record(spark, sf_dir):
    from ..operators.sequences import latest

    return latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query("""SELECT volume, count(*) AS tokens, count(DISTINCT key) AS keys, round(avg(x), 6) AS cx, min(x) AS x0, max(x) AS x1 FROM (SELECT l_suppkey % 10 AS volume, l_partkey % 97 AS key, l_extendedprice AS x FROM lineitem) GROUP BY 1""")
def sheet_bounds(spark, sf_dir):
    v = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).alias("volume"), (F.col("l_partkey") % 97).alias("key"), F.col("l_extendedprice").alias("x"))
    return v.groupBy("volume").agg(F.count(F.lit(1)).alias("tokens"), F.count_distinct("key").alias("keys"), F.round(F.avg("x"), 6).alias("cx"), F.min("x").alias("x0"), F.max("x").alias("x1"))
