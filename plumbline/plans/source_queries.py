"""Queries over what readers and writers do: listings, documents, ways, records, and the shapes that they carry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import pages as P
from ..operators import joins as J
from ..sources import documents as D
from .registry import query, table


def _text(c):
    return c.cast("string")


def _real(c):
    return c.cast("double")


@query("""SELECT c_custkey, 'v' || c_nationkey || '_p' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE '' END AS slug, c_custkey || CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE '' END AS page FROM customer""")
def slug_round_trip(spark, sf_dir):
    page = F.concat(_text(F.col("c_custkey")), F.when(F.col("c_custkey") % 2 == 0, "a").otherwise(""))
    slug = P.slug_for_page(F.concat(F.lit("v"), _text(F.col("c_nationkey"))), page)
    return table(spark, sf_dir, "customer").select("c_custkey", slug.alias("slug"), P.page_from_slug(slug).alias("page"))


@query("""
SELECT p_partkey, p_size + 5.0::DOUBLE AS cx, p_size * 2.0::DOUBLE AS cy, CASE WHEN p_size % 3 = 0 THEN 0.6 WHEN p_size % 2 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS dx, CASE WHEN p_size % 3 = 0 THEN 0.8 WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS dy FROM part""")
def label_axis(spark, sf_dir):
    s = F.col("p_size")
    box = F.array(_real(s), _real(s), _real(s + 10), _real(s * 3))
    direction = F.when(s % 3 == 0, F.array(F.lit(3.0), F.lit(4.0))).when(s % 3 == 1, F.array(F.lit(0.0), F.lit(0.0)))
    a = G.label_axis(box, F.when(s % 2 == 0, "vertical").otherwise("horizontal"), direction)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("a")).select("p_partkey", "a.*")


@query("""
WITH q AS (SELECT p_partkey, p_size * 4.0::DOUBLE AS x, p_size * 8.0::DOUBLE AS y, p_partkey % 4 * 90 AS t FROM part)
SELECT p_partkey, CASE t WHEN 90 THEN 500 - y / 4 WHEN 180 THEN 400 - x / 4 WHEN 270 THEN y / 4 ELSE x / 4 END AS x, CASE t WHEN 90 THEN x / 4 WHEN 180 THEN 500 - y / 4 WHEN 270 THEN 400 - x / 4 ELSE y / 4 END AS y, 1600.0::DOUBLE AS corner_x, 2000.0::DOUBLE AS corner_y FROM q""")
def frames_small(spark, sf_dir):
    s = F.col("p_size")
    at = G.full_to_small(s * 4.0, s * 8.0, F.lit(0.25), F.col("p_partkey") % 4 * 90, F.lit(1600.0), F.lit(2000.0))
    corner = G.small_corners_full(F.lit(400.0), F.lit(500.0), F.lit(0.25))[2]
    return table(spark, sf_dir, "part").select("p_partkey", at["x"].alias("x"), at["y"].alias("y"), corner["x"].alias("corner_x"), corner["y"].alias("corner_y"))


@query("""
WITH q AS (SELECT s_suppkey, 0.05 + s_suppkey % 7 * 0.01 AS sc, (s_suppkey % 90)::DOUBLE AS r FROM supplier), m AS (SELECT *, cos(radians(r)) * sc AS c, sin(radians(r)) * sc AS s FROM q)
SELECT s_suppkey, round(c, 9) AS a1, round(s, 9) AS a2, round(100 + c * 10 + s * 20, 6) AS x, round(200 + s * 10 - c * 20, 6) AS y, round(sqrt((100 + c * 10 + s * 20 - 90) ** 2 + (200 + s * 10 - c * 20 - 190) ** 2), 6) AS off FROM m""")
def pinned_models(spark, sf_dir):
    """A pinned linear part with a translation, a mask's corner under it, and its distance to a window."""
    k = F.col("s_suppkey")
    line = G.pinned_linear(F.lit(0.05) + k % 7 * 0.01, _real(k % 90))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", line.alias("l"))
    m = G.model(F.lit(100.0), F.col("l.a1"), F.col("l.a2"), F.lit(200.0), F.col("l.b1"), F.col("l.b2"))
    corner = G.mask_polygon(m, F.array(*[F.lit(v) for v in (10.0, 20.0, 50.0, 60.0)]))[0]
    return s.select(
        "s_suppkey", F.round("l.a1", 9).alias("a1"), F.round("l.a2", 9).alias("a2"), F.round(corner["x"], 6).alias("x"), F.round(corner["y"], 6).alias("y"),
        F.round(F.hypot(corner["x"] - 90, corner["y"] - 190), 6).alias("off"),
    )


@query("""
WITH l AS (SELECT c_custkey % 200 AS name, c_acctbal / 1000 AS x0, (c_custkey % 40)::DOUBLE / 16 AS y0, c_acctbal / 1000 + 1 AS x1, (c_custkey % 40)::DOUBLE / 16 + 0.5 AS y1 FROM customer),
s AS (SELECT *, greatest(1, ceil(greatest(abs(x1 - x0), abs(y1 - y0)) / 0.125))::INT AS n FROM l),
c AS (SELECT DISTINCT name, floor((x0 + (x1 - x0) * i / n) / 0.25)::BIGINT AS cx, floor((y0 + (y1 - y0) * i / n) / 0.25)::BIGINT AS cy FROM s, range(0, 40) t(i) WHERE i <= n)
SELECT name, count(*) AS cells, min(cx) AS x0, max(cx) AS x1, min(cy) AS y0, max(cy) AS y1 FROM c GROUP BY 1""")
def name_cells(spark, sf_dir):
    x, y = F.col("c_acctbal") / 1000, _real(F.col("c_custkey") % 40) / 16
    cells = F.explode(G.cells_along(x, y, x + 1, y + 0.5, 0.25)).alias("c")
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 200).alias("name"), cells).distinct()
    return c.groupBy("name").agg(F.count(F.lit(1)).alias("cells"), F.min("c.cx").alias("x0"), F.max("c.cx").alias("x1"), F.min("c.cy").alias("y0"), F.max("c.cy").alias("y1"))


@query("""
WITH r AS (SELECT o_custkey AS way, o_orderkey AS i, (o_orderkey % 3)::DOUBLE AS x FROM orders), d AS (SELECT *, lag(x) OVER (PARTITION BY way ORDER BY i) AS b FROM r),
k AS (SELECT way, count(*) FILTER (x IS DISTINCT FROM b) AS n, bool_or(x BETWEEN 1.5 AND 3) AS inside FROM d GROUP BY 1)
SELECT way, CASE WHEN n >= 2 THEN n END AS points, inside FROM k""")
def line_runs(spark, sf_dir):
    """Parts of a line as one run without repeats, and whether a vertex lies in a padded box."""
    p = F.struct(F.col("o_orderkey").alias("i"), F.struct(_real(F.col("o_orderkey") % 3).alias("x"), F.lit(0.0).alias("y")).alias("p"))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("way")).agg(F.transform(F.array_sort(F.collect_list(p)), lambda s: s["p"]).alias("line"))
    n = F.floor(F.size("line") / 2).cast("int")
    parts = F.array(F.slice("line", F.lit(1), n), F.slice("line", n + 1, F.size("line")))
    inside = G.any_vertex_in(F.col("line"), F.array(*[F.lit(v) for v in (2.0, 0.0, 2.5, 0.0)]), 0.5)
    return o.select("way", F.size(G.line_coords(parts)).cast("long").alias("n"), inside.alias("inside")).select("way", F.when(F.col("n") > 0, F.col("n")).alias("points"), "inside")


@query("""
WITH c AS (SELECT c_custkey AS id, 'cached' AS v FROM customer WHERE c_custkey % 2 = 0), f AS (SELECT c_custkey AS id, 'new' AS v FROM customer WHERE c_custkey % 3 = 0)
SELECT id, v, id % 20 <= 10 AS covered FROM (SELECT * FROM f UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM f))""")
def merged_ways(spark, sf_dir):
    """Cached ways with fetched ones in their places, and whether the boxes fetched so far cover a way's own."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    ways = D.merged_ways(c.filter("id % 2 = 0").withColumn("v", F.lit("cached")), c.filter("id % 3 = 0").withColumn("v", F.lit("new")))
    fetched = D.checked_response(spark.sql("SELECT 'ok' AS remark, array(array(0, 0, 5, 9), array(0, 0, 12, 12)) AS boxes"))
    x = (F.col("id") % 20).cast("int")
    return ways.crossJoin(F.broadcast(fetched)).select("id", "v", D.covers(F.col("boxes"), F.array(x, x, x + 2, x + 2)).alias("covered"))  # one response


@query("""
SELECT 'V' || c_custkey AS volume, '/t/V' || c_custkey || '.pmtiles' AS path FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 > 0""")
def archive_listing(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.concat(F.lit("/t/V"), _text(k), F.when(k % 3 == 0, ".pmtiles").when(k % 3 == 1, "-overview.pmtiles").otherwise(".txt"))
    return D.archives(table(spark, sf_dir, "customer").select(name.alias("path"), (k % 5).alias("length")))


@query("""
WITH f AS (SELECT l_orderkey AS item, l_suppkey % 2 AS g, l_linenumber * 1000000 + l_partkey AS pos, l_orderkey || '/' || l_linenumber || '/' || l_partkey AS url, CASE WHEN l_partkey % 4 = 0 THEN 'text/xml' ELSE 'image/jpeg' END AS m, CASE WHEN l_partkey % 5 > 0 THEN l_quantity::INT % 5 END AS h FROM lineitem)
SELECT item, g AS "group", arg_max(url, (coalesce(h, 0), -pos)) AS url FROM f WHERE m = 'image/jpeg' GROUP BY 1, 2""")
def tallest_variants(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    url = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey")
    f = li.select(
        F.col("l_orderkey").alias("item"), (F.col("l_suppkey") % 2).alias("group"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("pos"), url.alias("url"),
        F.when(F.col("l_partkey") % 4 == 0, "text/xml").otherwise("image/jpeg").alias("mimetype"), F.when(F.col("l_partkey") % 5 > 0, F.col("l_quantity").cast("int") % 5).alias("height"),
    )
    return D.tallest_variants(f, "image/jpeg")


@query("""
SELECT 'f' || s_suppkey AS path, (s_suppkey * 1000 - 5000) / 1e7 AS west, -1 / 1e7 AS south, 1800000000 / 1e7 AS east, s_suppkey / 1e7 AS north FROM supplier WHERE s_suppkey % 3 > 0""")
def archive_bounds(spark, sf_dir):
    k = F.col("s_suppkey")

    def little(v):
        """Four bytes, the lowest first."""
        h = F.lpad(F.hex(F.pmod(v.cast("long"), F.lit(2**32))), 8, "0")
        return F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)])

    head = F.concat(F.when(k % 3 > 0, F.hex(F.lit("PMTiles"))).otherwise(F.hex(F.lit("nothing"))), F.lit("03"), F.repeat(F.lit("00"), F.lit(94)))
    content = F.unhex(F.concat(head, little(k * 1000 - 5000), little(F.lit(-1)), little(F.lit(1800000000)), little(k)))
    return D.archive_bounds(table(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), _text(k)).alias("path"), content.alias("content")))


@query("""
SELECT s_suppkey, 'Annotation' AS type, 'img' || s_suppkey AS id, (s_suppkey + 100)::BIGINT AS width, 2 AS points, [s_suppkey + 0.5::DOUBLE, 3.0] AS second FROM supplier""")
def georeference_documents(spark, sf_dir):
    """The JSON annotation of a sheet, read back."""
    k = F.col("s_suppkey")
    point = lambda x, y: F.struct(x.alias("px"), y.alias("py"), (x * 2).alias("lng"), (y * 2).alias("lat"))
    doc = D.georeference(F.array(point(F.lit(1.0), F.lit(2.0)), point(k + 0.5, F.lit(3.0))), F.concat(F.lit("img"), _text(k)), k + 100, k + 200)
    d = table(spark, sf_dir, "supplier").select("s_suppkey", doc.alias("d"))
    features = F.from_json(F.get_json_object("d", "$.body.features"), "array<struct<properties: struct<resourceCoords: array<double>>>>")
    return d.select("s_suppkey", F.get_json_object("d", "$.type").alias("type"), F.get_json_object("d", "$.target.id").alias("id"), F.get_json_object("d", "$.target.width").cast("long").alias("width"), F.size(features).alias("points"), features[1]["properties"]["resourceCoords"].alias("second"))


@query("""
SELECT c_custkey AS volume, CASE WHEN c_custkey % 4 < 2 THEN c_custkey::INT END AS reads, CASE WHEN c_custkey % 3 = 0 THEN 7 END AS matched FROM customer""")
def sidecar_counters(spark, sf_dir):
    k = F.col("c_custkey")
    reads = F.when(k % 4 < 2, _text(k)).when(k % 4 == 2, "many").otherwise("-4")
    return D.checked_sidecar(table(spark, sf_dir, "customer").select(k.alias("volume"), reads.alias("reads"), F.when(k % 3 == 0, "7").otherwise("7.5x").alias("matched")))


@query("""
WITH m AS (SELECT p_partkey AS ord, 'f' || p_partkey AS path, 'old' AS sha FROM part WHERE p_partkey % 3 > 0), w AS (SELECT 'f' || p_partkey AS path, 'new' AS sha FROM part WHERE p_partkey % 2 = 0)
SELECT m.ord, coalesce(m.path, w.path) AS path, coalesce(w.sha, m.sha) AS sha256 FROM m FULL JOIN w ON m.path = w.path""")
def updated_sums(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("ord"), F.concat(F.lit("f"), _text(k)).alias("path"))
    return D.updated_sums(p.filter("ord % 3 > 0").withColumn("sha256", F.lit("old")), p.filter("ord % 2 = 0").select("path", F.lit("new").alias("sha256")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN 'V' || o_orderkey END AS volume, CASE WHEN o_orderkey % 4 = 1 THEN 'serve' ELSE 'place' END AS track, 'queued' AS status, o_orderkey % 4 = 3 AS quarantined FROM orders""")
def queue_lines(spark, sf_dir):
    k = F.col("o_orderkey")
    line = F.when(k % 4 == 3, F.concat(F.lit("broken "), _text(k))).otherwise(F.concat(F.lit('{"volume": "V'), _text(k), F.lit('"'), F.when(k % 4 == 1, ', "track": "serve"').otherwise(""), F.lit(', "unknown": 1}')))
    o = table(spark, sf_dir, "orders").select(k, line.alias("value"))
    q = D.read_queue(o.select("value"))
    # each line is told apart by its volume or, if it is broken, only counted
    good = o.join(q.filter("not quarantined"), F.get_json_object("value", "$.volume") == F.col("volume")).select("o_orderkey", "volume", "track", "status", "quarantined")
    bad = o.filter("o_orderkey % 4 = 3").join(q.filter("quarantined").select("track", "status", "quarantined").distinct())
    return good.unionByName(bad.select("o_orderkey", F.lit(None).cast("string").alias("volume"), "track", "status", "quarantined"))


@query("""
SELECT p_partkey AS id FROM part WHERE p_partkey % 5 <> 1 AND p_partkey % 7 <> 2 AND p_size % 4 > 1 AND p_partkey % 3 <> 1""")
def usable_ways(spark, sf_dir):
    """Parts as ways: some are footways, areas, too short, or named by a type alone; many have no kind."""
    k, s = F.col("p_partkey"), F.col("p_size")
    tags = F.map_filter(
        F.create_map(
            F.lit("name"), F.when(k % 3 == 1, "").otherwise(F.concat("p_name", F.lit(" Street"))), F.lit("highway"), F.when(k % 5 == 1, "footway").when(k % 5 == 2, "residential"),
            F.lit("area"), F.when(k % 7 == 2, "yes"),
        ), lambda _, v: v.isNotNull(),
    )
    return D.usable_ways(table(spark, sf_dir, "part").select(F.lit("way").alias("type"), k.alias("id"), tags.alias("tags"), F.sequence(F.lit(1), s % 4 + F.when(s % 4 == 0, 1).otherwise(0)).alias("geometry"))).select("id")


@query("""
WITH l AS (SELECT o_custkey % 3 AS rank, o_orderkey AS ord, CASE WHEN o_orderkey % 6 = 0 THEN 'v_ptitl' ELSE 'v_p' || (o_orderkey % 500) || CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'a' END END AS slug FROM orders),
p AS (SELECT rank, ord, regexp_extract(slug, '_p(\\d+[Aa])$', 1) AS page FROM l WHERE slug <> 'v_ptitl'),
f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY rank, page ORDER BY ord DESC) = 1)
SELECT rank, page, ord FROM f QUALIFY row_number() OVER (PARTITION BY lower(page) ORDER BY rank, page) = 1""")
def ground_truth(spark, sf_dir):
    k = F.col("o_orderkey")
    slug = F.when(k % 6 == 0, "v_ptitl").otherwise(F.concat(F.lit("v_p"), _text(k % 500), F.when(k % 2 == 0, "A").otherwise("a")))
    return D.ground_truth(table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).alias("rank"), k.alias("ord"), slug.alias("slug"))).select("rank", "page", "ord")


@query("""SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def required_counterparts(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return J.required(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), n, "c_nationkey").select("c_custkey", "n_name")



def _catalog(spark, sf_dir):
    """Customers as catalogue items: with and without dates, volumes, subjects and resources."""
    k = F.col("c_custkey")
    said = F.when(k % 4 == 0, F.concat(F.lit("Vol. "), _text(k), F.lit("., x"))).when(k % 4 == 1, F.concat(F.lit("1927. Scale 1:600. "), F.col("c_mktsegment"))).when(k % 4 == 2, "Scale 1:600. Stockyards")
    resource = lambda f, u: F.struct(f.alias("files"), u.alias("url"))
    no = F.lit(None).cast("string")
    resources = F.when(k % 3 > 0, F.array(resource(F.lit("many"), no), resource(_text(k % 9), F.concat(F.lit("u"), _text(k))), resource(F.lit("77"), F.lit("v"))))
    return table(spark, sf_dir, "customer").select(
        F.when(k % 11 > 0, F.concat(F.lit("http://h/item/i"), _text(k), F.lit("/"))).alias("id"), F.when(k % 2 == 0, "t").alias("title"), F.when(k % 5 > 0, F.concat(_text(1900 + k % 60), F.lit("-11"))).alias("date"),
        F.when(k % 7 > 0, k % 7 == 1).alias("digitized"), F.when(said.isNotNull(), F.array(said)).alias("description"), F.struct(F.when(k % 6 > 2, "Made in 1927").alias("created_published")).alias("item"), resources.alias("resources"),
    )


@query("""
SELECT CASE WHEN c_custkey % 11 > 0 THEN 'i' || c_custkey ELSE '' END AS item_id, CASE WHEN c_custkey % 2 = 0 THEN 't' ELSE '' END AS title, CASE WHEN c_custkey % 5 > 0 THEN (1900 + c_custkey % 60) || '-11' ELSE '' END AS date, c_custkey % 7 = 1 AS digitized,
  CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 9)::INT END AS sheet_count, CASE WHEN c_custkey % 3 > 0 THEN ['u' || c_custkey, 'v'] ELSE []::VARCHAR[] END AS urls FROM customer""")
def volume_records(spark, sf_dir):
    return D.volume_records(_catalog(spark, sf_dir))


@query("""
WITH c AS (SELECT 'i' || c_custkey AS item_id, c_custkey % 4 AS k, c_custkey::VARCHAR AS v, c_mktsegment AS seg, CASE WHEN c_custkey % 5 > 0 THEN 1900 + c_custkey % 60 END AS d, c_custkey % 6 > 2 AS made FROM customer WHERE c_custkey % 11 > 0),
y AS (SELECT *, CASE WHEN k = 1 AND d IS NOT NULL AND d <> 1927 AND made THEN 'description-conflict' WHEN k = 1 AND d IS NULL THEN 'description' ELSE 'date' END AS year_source FROM c),
t AS (SELECT *, CASE WHEN year_source = 'date' THEN d ELSE 1927 END AS year FROM y)
SELECT item_id, 'Town | ' || year || ' | ' || CASE k WHEN 0 THEN 'Vol. ' || v WHEN 1 THEN seg WHEN 2 THEN 'Stockyards' ELSE 'Vol. ?' END AS title, year::INT AS year, year_source, CASE WHEN k = 0 THEN v END AS volume_number, CASE k WHEN 1 THEN seg WHEN 2 THEN 'Stockyards' END AS subject FROM t WHERE year IS NOT NULL""")
def catalog_titles(spark, sf_dir):
    return D.catalog_titles(_catalog(spark, sf_dir), "Town", [r"\d{4}\. ", r"Scale 1:\d+\. "])


@query("""
WITH l AS (SELECT DISTINCT l_orderkey AS page, 'Q' || (l_suppkey % 9 + 11) || 'X' AS s FROM lineitem), n AS (SELECT l_orderkey AS page, 'Q' || (l_partkey % 3 + 11) || 'X AVE' AS s, list(l_quantity::INT ORDER BY l_linenumber, l_partkey, l_quantity) AS v FROM lineitem WHERE l_linenumber % 3 > 0 GROUP BY 1, 2),
a AS (SELECT page, list_sort(list(s)) AS keys, list_sort(list(s || ' AVE')) AS raws FROM l GROUP BY 1), m AS (SELECT page, list(s || '=' || array_to_string(v, ',') ORDER BY s) AS numerals FROM n GROUP BY 1)
SELECT page, keys, raws, coalesce(numerals, []::VARCHAR[]) AS numerals FROM a LEFT JOIN m USING (page)""")
def sheet_reads(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    name = lambda n: F.concat(F.lit("Q"), _text(n + 11), F.lit("x Ave."))
    value = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity").cast("int"))
    item = F.struct("l_linenumber", "l_partkey", "l_quantity", F.struct(name(F.col("l_partkey") % 3).alias("street"), value.alias("value")).alias("n"))
    p = li.groupBy(F.col("l_orderkey").alias("page")).agg(F.collect_list(name(F.col("l_suppkey") % 9)).alias("streets"), F.transform(F.array_sort(F.collect_list(item)), lambda i: i["n"]).alias("numerals"))
    r = D.sheet_reads(p)
    told = F.transform(F.array_sort(F.map_keys("numerals")), lambda s: F.concat(s, F.lit("="), F.array_join(F.element_at("numerals", s).cast("array<string>"), ",")))
    return r.select("page", "keys", "raws", told.alias("numerals"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS review FROM orders""")
def reviewer_values(spark, sf_dir):
    from ..operators import stages as T

    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, F.col("o_orderpriority")).alias("reviewer_review"), F.when(k % 3 < 2, F.col("o_orderstatus")).alias("owner_review"))
    return o.select("o_orderkey", T.reviewer_value("review").alias("review"))
