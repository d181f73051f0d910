"""Queries over runs, islands, pieces, samples and sequential kernels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import kernels as K
from ..operators import sequences as S
from .registry import query, table


@query("""
WITH e AS (SELECT user_id, event_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 1 DAY AS b FROM events),
i AS (SELECT user_id, ts, sum(coalesce(b, false)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e)
SELECT user_id, island::BIGINT AS island, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM i GROUP BY 1, 2""")
def gap_islands(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    gap = F.col("ts") - S.lag("ts", ["user_id"], ["ts", "event_id"]) > F.expr("INTERVAL 1 DAY")
    i = S.islands(e, ["user_id"], ["ts", "event_id"], gap)
    return i.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("""
WITH t AS (SELECT l_orderkey AS page, l_extendedprice AS y, l_quantity AS x, l_linenumber AS o FROM lineitem), g AS (SELECT *, y - lag(y) OVER (PARTITION BY page ORDER BY y, x, o) > 9000 AS b FROM t),
i AS (SELECT *, sum(coalesce(b, false)::INT) OVER (PARTITION BY page ORDER BY y, x, o) AS r FROM g)
SELECT page, r::BIGINT AS line, count(*) AS tokens, list(x ORDER BY x) AS xs FROM i GROUP BY 1, 2""")
def cluster_rows(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x"), F.col("l_linenumber").alias("o"))
    order = ["y", "x", "o"]
    i = S.islands(t, ["page"], order, F.col("y") - S.lag("y", ["page"], order) > 9000)
    return i.groupBy("page", F.col("island").alias("line")).agg(F.count(F.lit(1)).alias("tokens"), F.array_sort(F.collect_list("x")).alias("xs"))


@query("""
WITH v AS (SELECT l_suppkey AS way, l_suppkey % 7 AS street, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS pos, l_partkey AS node FROM lineitem),
s AS (SELECT node FROM v GROUP BY 1 HAVING count(DISTINCT street) > 3), k AS (SELECT node FROM v GROUP BY 1 HAVING count(DISTINCT street) > 1),
c AS (SELECT v.*, (node IN (SELECT node FROM k) AND pos > 0 AND pos < max(pos) OVER (PARTITION BY way))::INT AS cut FROM v)
SELECT way, sum(cut)::BIGINT + 1 AS pieces, count(*) + sum(cut)::BIGINT AS vertices FROM c GROUP BY 1""")
def cut_ways(spark, sf_dir):
    from pyspark.sql.window import Window

    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    v = table(spark, sf_dir, "lineitem").withColumn("pos", F.row_number().over(w) - 1)
    v = v.select(F.col("l_suppkey").alias("way"), (F.col("l_suppkey") % 7).alias("street"), "pos", F.col("l_partkey").alias("node"))
    c = S.cut_at_shared(v)
    return c.groupBy("way").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.size("nodes")).alias("vertices"))


@query("""
WITH f AS (SELECT o_custkey AS way, o_orderkey AS pos, o_orderpriority < '3' AS kind FROM orders), g AS (SELECT *, kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY way ORDER BY pos) AS b FROM f),
i AS (SELECT *, sum(b::INT) OVER (PARTITION BY way ORDER BY pos) AS run FROM g)
SELECT way, run::BIGINT AS run, any_value(kind) AS kind, list(pos ORDER BY pos) AS members FROM i GROUP BY 1, 2""")
def rejoin_pieces(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("way"), F.col("o_orderkey").alias("pos"), (F.col("o_orderpriority") < "3").alias("kind"))
    i = S.islands(f, ["way"], ["pos"], ~F.col("kind").eqNullSafe(S.lag("kind", ["way"], ["pos"])))
    return i.groupBy("way", F.col("island").alias("run")).agg(F.first("kind").alias("kind"), F.array_sort(F.collect_list("pos")).alias("members"))


@query("""
WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IS NOT NULL)
SELECT lang, doc_id FROM r WHERE n <= 7 OR place IN (SELECT round_even(i * (n - 1) / 6.0::DOUBLE, 0)::BIGINT FROM range(0, 7) t(i))""")
def even_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("lang is not null").select("lang", "doc_id")
    return S.sample_evenly(d, ["lang"], ["doc_id"], 7).select("lang", "doc_id")


@query("""
WITH p AS (SELECT l_suppkey AS chain, l_partkey AS old, l_partkey + (l_partkey // 37) * 3 + l_partkey % 3 AS new, l_partkey * 100 + min(l_linenumber) AS o FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, new // 100 AS hundred FROM p), e AS (SELECT chain, hundred, min(old) AS o0, max(old) AS o1, arg_min(new, o) AS n0, arg_max(new, o) AS n1, count(*) AS n FROM c GROUP BY 1, 2)
SELECT chain, hundred, o0 AS old_first, o1 AS old_last, n0 AS new_first, n1 AS new_last, n, round(max(abs(n0 + (old - o0) * CASE WHEN o1 = o0 THEN 0 ELSE (n1 - n0) / (o1 - o0)::DOUBLE END - new)), 6) AS worst
FROM c JOIN e USING (chain, hundred) GROUP BY ALL""")
def compress_chain(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("chain"), F.col("l_partkey").alias("old")).agg(F.min("l_linenumber").alias("k"))
    new = F.col("old") + F.floor(F.col("old") / 37) * 3 + F.col("old") % 3
    p = p.select("chain", "old", new.alias("new"), (F.col("old") * 100 + F.col("k")).alias("o"))
    return S.compressed(p, ["chain"], "o", "old", "new").withColumn("worst", F.round("worst", 6))


@query("""
WITH r AS (SELECT user_id, event_id, CASE WHEN event_type <> 'click' THEN value END AS v FROM events),
n AS (SELECT *, lag(v IGNORE NULLS) OVER w AS before, lead(v IGNORE NULLS) OVER w AS after FROM r WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, sum(coalesce(v < before AND after < before, false)::INT) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS piece FROM n""")
def split_sustained(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "event_type")
    return S.split_sustained(e, ["user_id"], ["event_id"], "value", F.col("event_type") != "click").select("user_id", "event_id", "piece")


@query("""
WITH s AS (SELECT DISTINCT o_custkey % 20 AS volume, CASE WHEN o_orderkey % 7 = 0 THEN (o_orderkey % 300) || 'S' ELSE (o_orderkey % 300)::VARCHAR END AS page FROM orders)
SELECT volume, page FROM s WHERE page LIKE '%S' AND (volume, replace(page, 'S', '')) IN (SELECT volume, page FROM s)""")
def skeleton_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    page = F.concat((k % 300).cast("string"), F.when(k % 7 == 0, "S").otherwise(""))
    s = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("volume"), page.alias("page")).distinct()
    twin = s.filter("page rlike '^[0-9]+$'").select("volume", F.col("page").alias("twin"))
    return s.filter("page rlike '^[0-9]+S$'").withColumn("twin", F.regexp_replace("page", "S$", "")).join(twin, ["volume", "twin"], "left_semi").select("volume", "page")


@query("""
WITH l AS (SELECT turn, conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations), s AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS entry FROM l)
SELECT conv_id, entry::BIGINT AS entry, count(*) AS parts, string_agg(role, ' ' ORDER BY turn) AS line FROM s GROUP BY 1, 2""")
def joined_lines(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    i = S.islands(c, ["conv_id"], ["turn"], F.col("role") == "user")
    parts = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return i.groupBy("conv_id", F.col("island").alias("entry")).agg(F.count(F.lit(1)).alias("parts"), F.array_join(F.transform(parts, lambda p: p["role"]), " ").alias("line"))


@query("""SELECT c_mktsegment AS stratum, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256(c_custkey || ':42')) <= 25""")
def stratified_sample(spark, sf_dir):
    """A fixed count from each stratum, by a seeded digest; the limit is taken before the shuffle as well."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("c_mktsegment").orderBy(F.sha2(F.concat(F.col("c_custkey").cast("string"), F.lit(":42")), 256))
    c = table(spark, sf_dir, "customer").withColumn("r", F.row_number().over(w)).filter("r <= 25")
    return c.select(F.col("c_mktsegment").alias("stratum"), "c_custkey")


@query("""SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10""")
def top_unmatched(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand").limit(10)


def candidates(spark, sf_dir):
    """Line items as label crossings: most of an order's follow one model, the rest lie anywhere. Each 4000 orders have
    sheets of their own, so that a sheet stays as large in any table."""
    sheet = F.floor(F.col("l_orderkey") / 4000) * 60 + F.col("l_orderkey") % 60
    li = table(spark, sf_dir, "lineitem").select(sheet.alias("sheet"), "l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    li = li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "sheet")  # dealt once, and not merged into few: sheets are work, not bytes
    li = li.groupBy("sheet", "l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"), F.min("l_partkey").alias("p"))
    px, py = F.col("q") * 100 + F.col("l_linenumber"), (F.col("p") % 70) * 100.0
    off = F.when(F.col("p") % 3 == 0, (F.col("p") % 997) * 1.0).otherwise((F.col("p") % 5) * 1.0)
    return li.select("sheet", F.col("l_orderkey").alias("i"), F.col("l_linenumber").alias("j"), px.alias("px"), py.alias("py"), (0.067 * px + 1000 + off).alias("x"), (2000 - 0.067 * py - off).alias("y"))


@query()
def ransac_groups(spark, sf_dir):
    out = K.ransac_groups(candidates(spark, sf_dir), ["sheet"], ["i", "j"], 25.0)
    return out.select("sheet", "n", "inliers", *[F.round(c, 6).alias(c) for c in ("a0", "a1", "a2", "b0", "b1", "b2")])


@query()
def translation_cluster(spark, sf_dir):
    c = candidates(spark, sf_dir).select("sheet", "i", "j", (F.col("x") - 0.067 * F.col("px")).alias("dx"), (F.col("y") + 0.067 * F.col("py")).alias("dy"))
    return K.translation_groups(c, ["sheet"], ["i", "j"]).select("sheet", "n", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


def seam_uses(spark, sf_dir):
    """Parts as nodes on their suppliers' pages, in twenty volumes."""
    from .join_queries import node_uses

    return J.first_uses(node_uses(spark, sf_dir)).withColumn("volume", F.col("node") % 20)


@query()
def seam_solve(spark, sf_dir):
    t = K.shared_seam_solve(seam_uses(spark, sf_dir), "volume", extra=(0.0, 1.0))
    return t.select("volume", "page", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


@query()
def merge_reads(spark, sf_dir):
    r = table(spark, sf_dir, "events").filter("event_type in ('click', 'view')").select("user_id", F.when(F.col("event_type") == "click", "a").otherwise("b").alias("reader"), F.col("value").alias("y"))
    return K.merged_reads(r, ["user_id"], 1.0)


@query()
def sheet_hulls(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))
    return K.hulls(p, ["sheet"]).select("sheet", "corners", F.round("area", 4).alias("area"))


@query()
def split_overlaps(spark, sf_dir):
    """Parallelograms, some under several others."""
    k = F.col("s_suppkey")
    x, y, lean = (k % 7 * 10).cast("double"), (k % 3 * 6).cast("double"), (k % 4).cast("double")
    at = lambda i, j: F.struct((x + i + j / 20 * lean).alias("x"), (y + j).alias("y"))
    ring = F.array(at(0.0, 0.0), at(14.0, 0.0), at(14.0, 20.0), at(0.0, 20.0))
    masks = table(spark, sf_dir, "supplier").select(F.floor(k / 60).alias("volume"), k.alias("page"), ring.alias("ring"))
    return K.cut_overlaps(masks, "volume").withColumn("area", F.round("area", 4))


@query()
def verify_offsets(spark, sf_dir):
    volume = F.floor(F.col("l_orderkey") / 600) * 10 + F.col("l_suppkey") % 10  # volumes stay as large in any table
    li = table(spark, sf_dir, "lineitem").select(volume.alias("volume"), F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("x"), F.col("l_quantity").alias("y"))
    moved = li.select("volume", (F.col("x") + 3).alias("x"), (F.col("y") - 5).alias("y"))
    return K.verify_offsets(li, moved, "volume").select("volume", "dx", "dy", "score", F.round("separation", 6).alias("separation"), "supports")
