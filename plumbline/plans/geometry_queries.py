"""Queries over models, frames, boxes and angles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators.aggs import fit_affine
from .registry import query, table

#: Control points of two models for each supplier: pixels from quantity and discount, world from a tilted plane and noise.
_POINTS = """SELECT l_suppkey AS page, CASE l_linestatus WHEN 'O' THEN 'human' ELSE 'machine' END AS model,
  l_quantity * 100 AS px, l_discount * 40000 + l_linenumber * 37 AS py,
  0.067::DOUBLE * l_quantity * 100 + 0.002::DOUBLE * (l_discount * 40000 + l_linenumber * 37) + l_tax * 40 AS x,
  0.001::DOUBLE * l_quantity * 100 - 0.066::DOUBLE * (l_discount * 40000 + l_linenumber * 37) + l_tax * 30 + l_linenumber AS y FROM lineitem"""

_FIT = f"""
p AS ({_POINTS}),
m AS (SELECT page, model, avg(px) AS mu, avg(py) AS mv, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM p GROUP BY 1, 2),
s AS (SELECT page, model, n, mu, mv, mx, my, sum((px-mu)*(px-mu)) AS uu, sum((px-mu)*(py-mv)) AS uv, sum((py-mv)*(py-mv)) AS vv,
  sum((px-mu)*(x-mx)) AS ux, sum((py-mv)*(x-mx)) AS vx, sum((px-mu)*(y-my)) AS uy, sum((py-mv)*(y-my)) AS vy
  FROM p JOIN m USING (page, model) GROUP BY 1, 2, 3, 4, 5, 6, 7),
l AS (SELECT *, (ux*vv-vx*uv)/(uu*vv-uv*uv) AS a1, (vx*uu-ux*uv)/(uu*vv-uv*uv) AS a2, (uy*vv-vy*uv)/(uu*vv-uv*uv) AS b1, (vy*uu-uy*uv)/(uu*vv-uv*uv) AS b2 FROM s
  WHERE n >= 3 AND uu*vv-uv*uv > 1e-9*uu*vv),
f AS (SELECT page, model, n, mx-a1*mu-a2*mv AS a0, a1, a2, my-b1*mu-b2*mv AS b0, b1, b2 FROM l)"""

_GRID = f"""{_FIT},
g AS (SELECT (5900 * (i + 0.5) / 5)::DOUBLE AS gx, (7300 * (j + 0.5) / 5)::DOUBLE AS gy FROM range(5) a(i), range(5) b(j)),
r AS (SELECT h.page, sqrt(avg(((h.a0-k.a0)+(h.a1-k.a1)*gx+(h.a2-k.a2)*gy)**2 + ((h.b0-k.b0)+(h.b1-k.b1)*gx+(h.b2-k.b2)*gy)**2)) AS rmse
  FROM f h JOIN f k ON h.page = k.page AND h.model = 'human' AND k.model = 'machine', g GROUP BY 1)"""


def control_points(spark, sf_dir):
    py = F.col("l_discount") * 40000 + F.col("l_linenumber") * 37
    p = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("page"), F.when(F.col("l_linestatus") == "O", "human").otherwise("machine").alias("model"),
        (F.col("l_quantity") * 100).alias("px"), py.alias("py"), "l_tax", "l_linenumber",
    )
    x = 0.067 * F.col("px") + 0.002 * F.col("py") + F.col("l_tax") * 40
    y = 0.001 * F.col("px") - 0.066 * F.col("py") + F.col("l_tax") * 30 + F.col("l_linenumber")
    return p.select("page", "model", "px", "py", x.alias("x"), y.alias("y"))


def fits(spark, sf_dir):
    return fit_affine(control_points(spark, sf_dir), ["page", "model"]).filter("m is not null")


def scores(spark, sf_dir):
    """(page, rmse): the machine's model against the human one, over the frame's grid."""
    f = fits(spark, sf_dir)
    by = f.groupBy("page").agg(F.max(F.when(F.col("model") == "human", F.col("m"))).alias("a"), F.max(F.when(F.col("model") == "machine", F.col("m"))).alias("b"))
    both = by.filter("a is not null and b is not null")
    return both.select("page", G.grid_rmse_m(F.col("a"), F.col("b"), F.lit(5900.0), F.lit(7300.0)).alias("rmse"))


@query(f"WITH {_FIT} SELECT page, model, n, round(a0, 4) AS a0, round(a1, 8) AS a1, round(a2, 8) AS a2, round(b0, 4) AS b0, round(b1, 8) AS b1, round(b2, 8) AS b2 FROM f")
def affine_fit(spark, sf_dir):
    d = {"a0": 4, "a1": 8, "a2": 8, "b0": 4, "b1": 8, "b2": 8}
    return fits(spark, sf_dir).select("page", "model", "n", *[F.round(F.col(f"m.{c}"), k).alias(c) for c, k in d.items()])


@query(f"""WITH {_GRID} SELECT page, round(rmse, 4) AS rmse_m, rmse > 15 AS over_gate FROM r""")
def score_grid_rmse(spark, sf_dir):
    return scores(spark, sf_dir).select("page", F.round("rmse", 4).alias("rmse_m"), (F.col("rmse") > G.GATE_M).alias("over_gate"))


@query(f"""WITH {_GRID} SELECT count(*) AS scored, round(median(rmse), 4) AS median_m, count(*) FILTER (rmse > 15) AS over_gate, round(max(rmse), 4) AS worst_m FROM r""")
def score_volume(spark, sf_dir):
    s = scores(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("scored"), F.round(F.median("rmse"), 4).alias("median_m"), F.count_if(F.col("rmse") > G.GATE_M).alias("over_gate"), F.round(F.max("rmse"), 4).alias("worst_m"))


@query(f"""WITH {_FIT} SELECT p.page, p.model, round(sqrt(avg((a0+a1*px+a2*py-x)**2+(b0+b1*px+b2*py-y)**2)), 4) AS rms_m,
  round(max(sqrt((a0+a1*px+a2*py-x)**2+(b0+b1*px+b2*py-y)**2)), 4) AS worst_m FROM p JOIN f USING (page, model) GROUP BY 1, 2""")
def affine_residuals(spark, sf_dir):
    p = control_points(spark, sf_dir).join(fits(spark, sf_dir).select("page", "model", "m"), ["page", "model"])
    r = p.select("page", "model", G.residual_m(F.col("m"), F.col("px"), F.col("py"), F.col("x"), F.col("y")).alias("r"))
    from ..operators.aggs import rms

    return r.groupBy("page", "model").agg(F.round(rms(F.col("r")), 4).alias("rms_m"), F.round(F.max("r"), 4).alias("worst_m"))


@query(f"""WITH {_FIT} SELECT page, model, round(sqrt(a1*a1+b1*b1), 6) AS sx, round(sqrt(a2*a2+b2*b2), 6) AS sy, round(degrees(atan2(b1, a1)), 4) AS rotation,
  a1*b2-a2*b1 < 0 AS upright, round(b2/(a1*b2-a2*b1), 4) AS inverse_a1,
  sqrt(a1*a1+b1*b1)/sqrt(a2*a2+b2*b2) > 0.5 AND sqrt(a1*a1+b1*b1)/sqrt(a2*a2+b2*b2) < 2 AS aspect,
  sqrt(a1*a1+b1*b1) > 0.06 AND sqrt(a1*a1+b1*b1) < 0.07 AND sqrt(a2*a2+b2*b2) > 0.06 AND sqrt(a2*a2+b2*b2) < 0.07 AS scale,
  abs(((degrees(atan2(b1, a1)) - 1 + 45) % 90 + 90) % 90 - 45) <= 1 AS turned FROM f""")
def model_gates(spark, sf_dir):
    m = F.col("m")
    s = fits(spark, sf_dir).withColumn("s", G.scales(m)).withColumn("rot", G.rotation_deg(m))
    sx, sy = F.col("s.sx"), F.col("s.sy")
    return s.select(
        "page", "model", F.round(sx, 6).alias("sx"), F.round(sy, 6).alias("sy"), F.round("rot", 4).alias("rotation"), (G.determinant(m) < 0).alias("upright"),
        F.round(G.invert_affine(m)["a1"], 4).alias("inverse_a1"), G.aspect_ok(sx, sy).alias("aspect"),
        G.scale_ok(sx, sy, F.lit(0.06), F.lit(0.07)).alias("scale"), G.rotation_ok(F.col("rot"), F.lit(0.0), F.lit(2.0), True).alias("turned"),
    )


@query("SELECT event_id, round(((value * 7 + 45) % 90 + 90) % 90 - 45, 6) AS folded FROM events")
def fold_quadrant(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(G.fold_quadrant_deg(F.col("value") * 7), 6).alias("folded"))


@query("""
WITH b AS (SELECT p_partkey, p_size AS x0, p_size * 2 AS y0, p_size + 30 AS x1, p_size * 2 + 10 AS y1, (p_partkey % 4) * 90 AS d FROM part)
SELECT p_partkey, CASE d WHEN 0 THEN [x0, y0, x1, y1] WHEN 90 THEN [200 - y1, x0, 200 - y0, x1] WHEN 180 THEN [100 - x1, 200 - y1, 100 - x0, 200 - y0] ELSE [y0, 100 - x1, y1, 100 - x0] END AS box,
  CASE WHEN d % 180 = 90 THEN 'vertical' ELSE 'horizontal' END AS orientation, CASE d WHEN 0 THEN 1 WHEN 90 THEN 0 WHEN 180 THEN -1 ELSE 0 END AS dx FROM b""")
def quarter_turn_box(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("d", (F.col("p_partkey") % 4 * 90).cast("int"))
    s = F.col("p_size")
    box = G.rotate_box(F.array(s, s * 2, s + 30, s * 2 + 10), F.col("d"), F.lit(100), F.lit(200))
    return p.select("p_partkey", box.alias("box"), G.turned_orientation(F.lit("horizontal"), F.col("d")).alias("orientation"), G.rotate_direction_cw(F.lit(1), F.lit(0), F.col("d"))["x"].alias("dx"))


@query("""
WITH p AS (SELECT c_custkey, -87.9 + (c_custkey % 500) / 1000.0::DOUBLE AS lng, 41.6 + c_nationkey / 50.0::DOUBLE AS lat FROM customer)
SELECT c_custkey, round(6378137.0::DOUBLE * radians(lng), 3) AS x, round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS y,
  round(lat, 6) AS back, round(cos(radians(lat)), 6) AS scale, floor(lng / 0.01::DOUBLE)::BIGINT AS cx FROM p""")
def mercator_xy(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select("c_custkey", (F.lit(-87.9) + (F.col("c_custkey") % 500) / 1000.0).alias("lng"), (F.lit(41.6) + F.col("c_nationkey") / 50.0).alias("lat"))
    y = G.mercator_y(F.col("lat"))
    return p.select(
        "c_custkey", F.round(G.mercator_x(F.col("lng")), 3).alias("x"), F.round(y, 3).alias("y"), F.round(G.mercator_lat_deg(y), 6).alias("back"),
        F.round(G.mercator_scale(y), 6).alias("scale"), G.cell_of(F.col("lng")).alias("cx"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 100 END AS first, CASE WHEN p_size % 5 = 0 THEN 'none' WHEN p_size % 7 = 0 THEN 'r' ELSE 'both' END AS sides FROM part""")
def address_range_sides(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    left = F.expr("CASE WHEN p_size % 7 = 0 THEN ' ' ELSE concat(' ', p_size * 100, '.7') END")
    m = G.range_sides(left, F.lit("10"), F.lit("2"), F.lit("98"))
    m = F.when(F.col("p_size") % 5 == 0, G.range_sides(F.lit("inf"), F.lit("-3"), F.lit(""), F.lit("x"))).otherwise(m)
    first = G.parse_house_number(left)
    sides = F.when(F.size(F.map_keys(m)) == 0, "none").when(F.size(F.map_keys(m)) == 2, "both").otherwise(F.map_keys(m)[0])
    return p.select("p_partkey", first.alias("first"), sides.alias("sides"))


@query("""
SELECT p_partkey, (2 * (1 + p_size) + 3)::DOUBLE AS a0, round(2.0::DOUBLE * cos(radians(p_size)), 6) AS a1, round(2.0::DOUBLE * sin(radians(p_size)), 6) AS b1 FROM part""")
def compose_ops(spark, sf_dir):
    op = lambda t, **k: F.struct(F.lit(t).alias("type"), *[(k[n] if n in k else F.lit(0.0)).cast("double").alias(n) for n in ("dx_m", "dy_m", "factor", "deg")], k.get("center", F.array(F.lit(0.0), F.lit(0.0))).alias("center"))
    s = F.col("p_size").cast("double")
    at = F.array(1 + s, F.lit(0.0))
    ops = F.array(op("rotate", deg=s, center=at), op("scale", factor=F.lit(2.0)), op("translate", dx_m=F.lit(3.0)))
    zero, one = F.lit(0.0), F.lit(1.0)
    m = G.compose_ops(G.model(1 + s, one, zero, zero, zero, F.lit(-1.0)), ops)
    return table(spark, sf_dir, "part").select("p_partkey", *[F.round(m[c], 6).alias(c) for c in ("a0", "a1", "b1")])


@query("""
SELECT p_partkey, CASE WHEN p_size > 30 THEN NULL WHEN p_size = 0 OR p_size <= 0 THEN 20.0 ELSE round(CASE WHEN p_size + 10 <= 20 THEN 10.0 ELSE
  CASE WHEN (p_size * p_size + 400.0 - 100.0) / (2 * p_size) >= p_size THEN 10.0 ELSE sqrt(400.0 - ((p_size * p_size + 300.0) / (2.0 * p_size)) ** 2) END END, 6) END::DOUBLE AS r FROM part""")
def fuse_windows(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    z = F.lit(0.0)
    w = G.fuse_windows(z, z, F.lit(20.0), F.col("p_size").cast("double"), z, F.lit(10.0))
    return p.select("p_partkey", F.round(w["r"], 6).alias("r"))


@query("""
SELECT p_partkey, p_size < 25 AND p_size + 5 > 5 AS open_overlap, [round_even(p_size * 0.1::DOUBLE, 0)::BIGINT, round_even(p_size * 0.9::DOUBLE, 0)::BIGINT] AS xs,
  p_size % 3 <> 0 AS usable, p_size + 5 < 10 OR p_size > 35 AS apart FROM part""")
def box_predicates(spark, sf_dir):
    s = F.col("p_size")
    own = F.array(s, s, s + 5, s + 5)
    ring = G.inset_box(s, s, 0.1)
    d = F.when(s % 3 == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(F.lit(3.0), s.cast("double")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", G.boxes_overlap(own, F.array(*[F.lit(v) for v in (5, 5, 25, 25)])).alias("open_overlap"), F.array(ring[0]["x"], ring[1]["x"]).alias("xs"),
        G.usable_direction(d).isNotNull().alias("usable"), G.box_disjoint(own, F.array(*[F.lit(v) for v in (10, 10, 35, 35)])).alias("apart"),
    )
