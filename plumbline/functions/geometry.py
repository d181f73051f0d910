"""Affine models, coordinate frames, boxes, angles and address grids as Column expressions.

A model is struct(a0, a1, a2, b0, b1, b2): X = a0 + a1 px + a2 py, Y = b0 + b1 px + b2 py. Boxes are array(x0, y0, x1, y1).
Column names end in _3857m or _groundm where both kinds of metres occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

#: Fixed value: the sphere of Web Mercator.
RADIUS = 6378137.0
#: The largest ratio of a model's scales, and the gate of a score.
ASPECT_MAX, GATE_M = 2.0, 15.0
_FIELDS = ("a0", "a1", "a2", "b0", "b1", "b2")


def model(*parameters: Column) -> Column:
    return F.struct(*[p.cast("double").alias(n) for p, n in zip(parameters, _FIELDS, strict=True)])


def apply_affine(m: Column, px: Column, py: Column) -> Column:
    return F.struct((m["a0"] + m["a1"] * px + m["a2"] * py).alias("x"), (m["b0"] + m["b1"] * px + m["b2"] * py).alias("y"))


def determinant(m: Column) -> Column:
    """Negative for an upright scan, whose rows run down."""
    return m["a1"] * m["b2"] - m["a2"] * m["b1"]


def invert_affine(m: Column) -> Column:
    """The model from world to pixels; null where there is none."""
    d = F.nullif(determinant(m), F.lit(0.0))
    return model(
        (m["a2"] * m["b0"] - m["a0"] * m["b2"]) / d, m["b2"] / d, -m["a2"] / d,
        (m["a0"] * m["b1"] - m["a1"] * m["b0"]) / d, -m["b1"] / d, m["a1"] / d,
    )


def scales(m: Column) -> Column:
    return F.struct(F.hypot(m["a1"], m["b1"]).alias("sx"), F.hypot(m["a2"], m["b2"]).alias("sy"))


def rotation_deg(m: Column) -> Column:
    return F.degrees(F.atan2(m["b1"], m["a1"]))


def residual_m(m: Column, px: Column, py: Column, x: Column, y: Column) -> Column:
    return let(apply_affine(m, px, py), lambda p: F.hypot(p["x"] - x, p["y"] - y))


def grid_rmse_m(a: Column, b: Column, width: Column, height: Column, n: int = 5, lat: Column | None = None) -> Column:
    """Root mean square distance of two models over n x n points of the frame; in ground metres where lat is given.

    The difference of two affine models is affine, so the mean square over the grid has a closed form.
    """
    spread = sum(((i + 0.5) / n - 0.5) ** 2 for i in range(n)) / n

    def axis(c0: str, c1: str, c2: str) -> Column:
        d0, d1, d2 = a[c0] - b[c0], (a[c1] - b[c1]) * width, (a[c2] - b[c2]) * height
        centre = d0 + d1 / 2 + d2 / 2
        return centre * centre + (d1 * d1 + d2 * d2) * spread

    rms = F.sqrt(axis("a0", "a1", "a2") + axis("b0", "b1", "b2"))
    return rms if lat is None else rms * F.cos(F.radians(lat))


def mercator_x(lng: Column) -> Column:
    return F.radians(lng) * RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * RADIUS


def mercator_lat_deg(y: Column) -> Column:
    return F.degrees(F.atan(F.sinh(y / RADIUS)))


def mercator_scale(y: Column) -> Column:
    """Ground metres of a projected metre at a northing."""
    return F.cos(F.atan(F.sinh(y / RADIUS)))


def fold_quadrant_deg(angle: Column) -> Column:
    """An angle modulo quarter turns, in [-45, 45)."""
    return F.pmod(angle + 45.0, F.lit(90.0)) - 45.0


def rotation_ok(angle: Column, lo: Column, hi: Column, fold: bool) -> Column:
    """Inclusive at both ends."""
    if fold:
        return F.abs(fold_quadrant_deg(angle - (lo + hi) / 2)) <= (hi - lo) / 2
    return angle.between(lo, hi)


def scale_ok(sx: Column, sy: Column, lo: Column, hi: Column) -> Column:
    """Strict at both ends, for both axes."""
    return (sx > lo) & (sx < hi) & (sy > lo) & (sy < hi)


def aspect_ok(sx: Column, sy: Column) -> Column:
    ratio = sx / F.nullif(sy, F.lit(0.0))
    return (ratio > 1 / ASPECT_MAX) & (ratio < ASPECT_MAX)


def usable_direction(direction: Column) -> Column:
    """A unit vector of two finite numbers, else null."""

    def unit(n: Column) -> Column:
        return F.when(n > 0, F.transform(direction, lambda v: v / n))

    ok = (F.size(direction) == 2) & F.forall(direction, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(ok, let(F.hypot(F.try_element_at(direction, F.lit(1)), F.try_element_at(direction, F.lit(2))), unit))


def label_axis(box: Column, orientation: Column, direction: Column) -> Column:
    """struct(cx, cy, dx, dy): the line on which a label lies; without a direction along its longer side as read."""
    along = F.when(orientation == "vertical", F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0)))
    d = F.coalesce(usable_direction(direction), along)
    return let(d, lambda v: F.struct(((box[0] + box[2]) / 2).alias("cx"), ((box[1] + box[3]) / 2).alias("cy"), v[0].alias("dx"), v[1].alias("dy")))


def rotate_point_cw(x: Column, y: Column, turn: Column, width: Column, height: Column) -> Column:
    """A pixel after the frame was turned clockwise by 0, 90, 180 or 270 degrees."""
    new_x = F.when(turn == 90, height - y).when(turn == 180, width - x).when(turn == 270, y).otherwise(x)
    new_y = F.when(turn == 90, x).when(turn == 180, height - y).when(turn == 270, width - x).otherwise(y)
    return F.struct(new_x.alias("x"), new_y.alias("y"))


def rotate_box(box: Column, turn: Column, width: Column, height: Column) -> Column:
    def corners(p: Column, q: Column) -> Column:
        return F.array(F.least(p["x"], q["x"]), F.least(p["y"], q["y"]), F.greatest(p["x"], q["x"]), F.greatest(p["y"], q["y"]))

    return let(rotate_point_cw(box[0], box[1], turn, width, height), lambda p: let(rotate_point_cw(box[2], box[3], turn, width, height), lambda q: corners(p, q)))


def rotate_direction_cw(dx: Column, dy: Column, turn: Column) -> Column:
    new_x = F.when(turn == 90, -dy).when(turn == 180, -dx).when(turn == 270, dy).otherwise(dx)
    new_y = F.when(turn == 90, dx).when(turn == 180, -dy).when(turn == 270, -dx).otherwise(dy)
    return F.struct(new_x.alias("x"), new_y.alias("y"))


def turned_orientation(orientation: Column, turn: Column) -> Column:
    flipped = F.when(orientation == "horizontal", "vertical").when(orientation == "vertical", "horizontal").otherwise(orientation)
    return F.when((turn % 180) == 90, flipped).otherwise(orientation)


def full_to_small(x: Column, y: Column, scale: Column, turn: Column, full_w: Column, full_h: Column) -> Column:
    """A full-size pixel in the upright small image."""
    return rotate_point_cw(x * scale, y * scale, turn, full_w * scale, full_h * scale)


def pinned_linear(scale: Column, rotation: Column) -> Column:
    """The linear part of a model with a given scale and rotation, rows running down."""
    c, s = F.cos(F.radians(rotation)) * scale, F.sin(F.radians(rotation)) * scale
    return F.struct(c.alias("a1"), s.alias("a2"), s.alias("b1"), (-c).alias("b2"))


def cell_of(v: Column, size: float = 0.01) -> Column:
    return F.floor(v / size)


def cells_along(x0: Column, y0: Column, x1: Column, y1: Column, size: float = 0.01) -> Column:
    """The cells that a segment passes, sampled at half a cell."""
    steps = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(x1 - x0), F.abs(y1 - y0)) / (size / 2)).cast("int"))
    at = lambda a, b, i: cell_of(a + (b - a) * i / steps, size)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), steps), lambda i: F.struct(at(x0, x1, i).alias("cx"), at(y0, y1, i).alias("cy"))))


def dilated(cells: Column) -> Column:
    """Cells with their eight neighbours."""
    steps = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return F.array_distinct(F.flatten(F.transform(cells, lambda c: F.transform(steps, lambda s: F.struct((c["cx"] + s["i"]).alias("cx"), (c["cy"] + s["j"]).alias("cy"))))))


def parse_house_number(raw: Column) -> Column:
    """A positive whole number, truncated; anything else, infinities included, is null."""
    n = F.trim(raw.cast("string")).try_cast("double")
    return F.when((n >= 1) & (n < 2147483648.0), F.floor(n).cast("int"))


def range_sides(l_from: Column, l_to: Column, r_from: Column, r_to: Column) -> Column:
    """Map of side -> struct(first, last); a side without one of its ends is missing."""
    side = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("first"), b.alias("last")))
    parsed = [parse_house_number(c) for c in (l_from, l_to, r_from, r_to)]
    return F.map_filter(F.create_map(F.lit("l"), side(*parsed[:2]), F.lit("r"), side(*parsed[2:])), lambda _, v: v.isNotNull())


def line_coords(parts: Column) -> Column:
    """All parts as one run of points without repeats in a row; null under two points."""
    flat = F.flatten(parts)
    kept = F.filter(flat, lambda p, i: (i == 0) | (p != F.try_element_at(flat, F.greatest(i, F.lit(1)))))
    return let(kept, lambda k: F.when(F.size(k) >= 2, k))


def boxes_overlap(a: Column, b: Column) -> Column:
    """Open boxes: touching ones don't overlap."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def box_of(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def box_disjoint(a: Column, b: Column) -> Column:
    return (a[2] < b[0]) | (a[0] > b[2]) | (a[3] < b[1]) | (a[1] > b[3])


def any_vertex_in(points: Column, box: Column, margin: float) -> Column:
    return F.exists(points, lambda p: p["x"].between(box[0] - margin, box[2] + margin) & p["y"].between(box[1] - margin, box[3] + margin))


def fuse_windows(ax: Column, ay: Column, ar: Column, bx: Column, by: Column, br: Column) -> Column:
    """struct(x, y, r): the smallest disc that holds the meeting of two discs; null where they don't meet."""

    def fused(d: Column) -> Column:
        # the lens lies along the line of centres; its half chord is the disc's radius unless one disc is small enough
        t = (d * d + ar * ar - br * br) / (2 * F.nullif(d, F.lit(0.0)))
        chord = F.sqrt(F.greatest(ar * ar - t * t, F.lit(0.0)))
        inner_a, inner_b = (t >= d) | (d + br <= ar), (t <= 0) | (d + ar <= br)
        at = lambda p, q: p + (q - p) * t / d
        small_b = F.struct(bx.alias("x"), by.alias("y"), br.alias("r"))
        small_a = F.struct(ax.alias("x"), ay.alias("y"), ar.alias("r"))
        lens = F.struct(at(ax, bx).alias("x"), at(ay, by).alias("y"), chord.alias("r"))
        whole = F.when((d == 0) & (ar <= br), small_a).when(d == 0, small_b)
        return F.when(d <= ar + br, F.coalesce(whole, F.when(inner_a, small_b).when(inner_b, small_a).otherwise(lens)))

    return let(F.hypot(bx - ax, by - ay), fused)


def linear_op(op: Column) -> Column:
    """struct(l11, l12, l21, l22, ox, oy) of one edit: translate, scale or rotate about a centre."""
    cx, cy = F.try_element_at(op["center"], F.lit(1)), F.try_element_at(op["center"], F.lit(2))
    c, s = F.cos(F.radians(op["deg"])), F.sin(F.radians(op["deg"]))
    one, zero = F.lit(1.0), F.lit(0.0)
    l11 = F.when(op["type"] == "scale", op["factor"]).when(op["type"] == "rotate", c).otherwise(one)
    l12 = F.when(op["type"] == "rotate", -s).otherwise(zero)
    l21 = F.when(op["type"] == "rotate", s).otherwise(zero)
    ox = F.when(op["type"] == "translate", op["dx_m"]).otherwise(cx - l11 * cx - l12 * cy)
    oy = F.when(op["type"] == "translate", op["dy_m"]).otherwise(cy - l21 * cx - l11 * cy)
    return F.struct(l11.alias("l11"), l12.alias("l12"), l21.alias("l21"), l11.alias("l22"), ox.alias("ox"), oy.alias("oy"))


def compose_ops(m: Column, ops: Column) -> Column:
    """The model after all edits, in order."""

    def step(acc: Column, raw: Column) -> Column:
        def moved(o: Column) -> Column:
            x = lambda f, g, shift: o["l11"] * acc[f] + o["l12"] * acc[g] + shift
            y = lambda f, g, shift: o["l21"] * acc[f] + o["l22"] * acc[g] + shift
            zero = F.lit(0.0)
            return model(x("a0", "b0", o["ox"]), x("a1", "b1", zero), x("a2", "b2", zero), y("a0", "b0", o["oy"]), y("a1", "b1", zero), y("a2", "b2", zero))

        return let(linear_op(raw), moved)

    return F.aggregate(ops, m, step)


def inset_box(width: Column, height: Column, inset: float) -> Column:
    """The frame's corners, moved inwards by a share of its sides."""
    x0, y0, x1, y1 = F.bround(width * inset), F.bround(height * inset), F.bround(width * (1 - inset)), F.bround(height * (1 - inset))
    corner = lambda x, y: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))


def segment_point_distance(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """struct(distance, fraction) of the nearest point of a segment."""
    dx, dy = x1 - x0, y1 - y0
    raw = ((px - x0) * dx + (py - y0) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(raw, F.lit(0.0))))
    return let(t, lambda f: F.struct(F.hypot(px - (x0 + dx * f), py - (y0 + dy * f)).alias("distance"), f.alias("fraction")))


def segment_crossing(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """struct(x, y) where two segments cross, ends included; null for parallel ones."""
    rx, ry, sx, sy = ax1 - ax0, ay1 - ay0, bx1 - bx0, by1 - by0
    den = F.nullif(rx * sy - ry * sx, F.lit(0.0))
    t = ((bx0 - ax0) * sy - (by0 - ay0) * sx) / den
    u = ((bx0 - ax0) * ry - (by0 - ay0) * rx) / den
    return F.when(t.between(0.0, 1.0) & u.between(0.0, 1.0), F.struct((ax0 + t * rx).alias("x"), (ay0 + t * ry).alias("y")))


def collinear_overlap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Whether two segments share more than a point of one line."""
    rx, ry = ax1 - ax0, ay1 - ay0
    flat = (rx * (by1 - by0) - ry * (bx1 - bx0) == 0) & (rx * (by0 - ay0) - ry * (bx0 - ax0) == 0)
    n = F.nullif(rx * rx + ry * ry, F.lit(0.0))
    t0, t1 = ((bx0 - ax0) * rx + (by0 - ay0) * ry) / n, ((bx1 - ax0) * rx + (by1 - ay0) * ry) / n
    return flat & (F.least(F.greatest(t0, t1), F.lit(1.0)) > F.greatest(F.least(t0, t1), F.lit(0.0)))


def spend(sheets: Column, unread: Column, tiers: Column, gated: float = 0.41, attempts: int = 2, tier_attempts: int = 2) -> Column:
    """struct(low, gated, ceiling): calls that reading the rest takes, cleanly once, or retried and through every tier."""
    pool = F.when(tiers > 0, F.ceil(sheets * gated)).otherwise(0).cast("long")
    return F.struct(unread.cast("long").alias("low"), pool.alias("gated"), (unread * attempts + pool * tiers * tier_attempts).cast("long").alias("ceiling"))


# Metres of a degree of latitude and of a mile.
METRES_A_DEGREE, METRES_A_MILE = 111_132.0, 1609.344


def grid_numbers(lon: Column, lat: Column, lon0: float, lat0: float, units: float) -> Column:
    """struct(ew, ns): signed house numbers of a place on a grid of `units` numbers a mile about its origin."""
    from math import cos, radians

    ew = (lon - lon0) * (METRES_A_DEGREE * cos(radians(lat0))) / METRES_A_MILE * units
    return F.struct(ew.alias("ew"), ((lat - lat0) * METRES_A_DEGREE / METRES_A_MILE * units).alias("ns"))


def street_span(box: Column, lon0: float, lat0: float, units: float, ratio: float = 1.5) -> Column:
    """struct(axis, along_lo, along_hi, cross_lo, cross_hi) of a street's box; null where neither side is clearly longer."""

    def spanned(a: Column, b: Column) -> Column:
        ew, ns = F.abs(b["ew"] - a["ew"]), F.abs(b["ns"] - a["ns"])
        span = lambda axis, u, v: F.struct(F.lit(axis).alias("axis"), a[u].alias("along_lo"), b[u].alias("along_hi"), a[v].alias("cross_lo"), b[v].alias("cross_hi"))
        tiny = F.lit(1e-9)
        return F.when(ns >= ratio * F.greatest(ew, tiny), span("ns", "ns", "ew")).when(ew >= ratio * F.greatest(ns, tiny), span("ew", "ew", "ns"))

    return let(grid_numbers(box[0], box[1], lon0, lat0, units), lambda a: let(grid_numbers(box[2], box[3], lon0, lat0, units), lambda b: spanned(a, b)))


def along_covers(span: Column, number: Column, pad: float = 0.0) -> Column:
    return number.between(span["along_lo"] - pad, span["along_hi"] + pad)


def along_overlaps(span: Column, lo: Column, hi: Column, pad: float = 0.0) -> Column:
    return (F.least(lo, hi) - pad <= span["along_hi"]) & (F.greatest(lo, hi) + pad >= span["along_lo"])


def principal_bearing(points: Column, scatter: float = 0.5) -> Column:
    """Degrees in [0, 180) of a line's course, by length; null where its pieces point all over (or it has no length)."""

    def folded(segments: Column) -> Column:
        total = F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + s["n"])
        c = F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + s["n"] * F.cos(2 * s["t"]))
        d = F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + s["n"] * F.sin(2 * s["t"]))
        return F.when(F.hypot(c, d) >= scatter * F.nullif(total, F.lit(0.0)), F.pmod(F.degrees(F.atan2(d, c)) / 2, F.lit(180.0)))

    def segment(p: Column, q: Column) -> Column:
        return F.struct(F.hypot(q["x"] - p["x"], q["y"] - p["y"]).alias("n"), F.atan2(q["y"] - p["y"], q["x"] - p["x"]).alias("t"))

    heads = F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0)))
    return let(F.zip_with(heads, F.slice(points, 2, F.greatest(F.size(points), F.lit(1))), segment), folded)


def small_corners_full(width: Column, height: Column, scale: Column) -> Column:
    """The small image's corners as full-size pixels."""
    corner = lambda x, y: F.struct((x / scale).alias("x"), (y / scale).alias("y"))
    zero = F.lit(0.0)
    return F.array(corner(zero, zero), corner(width, zero), corner(width, height), corner(zero, height))


def mask_polygon(m: Column, box: Column) -> Column:
    """A pixel rectangle's corners in the world."""
    return F.array(*[apply_affine(m, box[i], box[j]) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3))])


def good_labels(streets: Column) -> Column:
    """Label items with a name and a box of four numbers."""
    return F.filter(streets, lambda s: s.isNotNull() & s["name"].isNotNull() & (F.size(s["bbox"]) == 4) & F.forall(s["bbox"], lambda v: v.isNotNull()))


def turned_labels(streets: Column, turn: Column, width: Column, height: Column) -> Column:
    """Labels of an image after a clockwise turn: boxes, orientations and directions."""

    def turned(s: Column) -> Column:
        d = rotate_direction_cw(F.try_element_at(s["direction"], F.lit(1)), F.try_element_at(s["direction"], F.lit(2)), turn)
        return F.struct(s["name"].alias("name"), rotate_box(s["bbox"], turn, width, height).alias("bbox"), turned_orientation(s["orientation"], turn).alias("orientation"), F.when(F.size(s["direction"]) == 2, F.array(d["x"], d["y"])).alias("direction"))

    return F.transform(streets, turned)


def with_model_corners(points: Column, m: Column, width: Column, height: Column) -> Column:
    """Control points with three more that the model makes, marked as synthetic."""
    corner = lambda x, y: let(apply_affine(m, x, y), lambda p: F.struct(x.alias("px"), y.alias("py"), p["x"].alias("x"), p["y"].alias("y"), F.lit(True).alias("synthetic")))
    zero = F.lit(0.0)
    return F.concat(points, F.array(corner(zero, zero), corner(width, zero), corner(zero, height)))


def shifted(points: Column, dx: Column, dy: Column) -> Column:
    return F.transform(points, lambda p: F.struct(p["px"].alias("px"), p["py"].alias("py"), (p["x"] + dx).alias("x"), (p["y"] + dy).alias("y"), p["synthetic"].alias("synthetic")))


def _beside(x: np.ndarray, y: np.ndarray, of: np.ndarray, edge: np.ndarray, above: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of rings on one side of their edge across x: corners there, and cuts where a side crosses.

    Corners lie ring after ring; of: each corner's ring.
    """
    if not len(of):
        return x, y, of
    first = np.r_[True, of[1:] != of[:-1]]
    begin = np.flatnonzero(first)
    q = np.arange(1, len(of) + 1)
    q[np.r_[begin[1:], len(of)] - 1] = begin
    e = edge[of]
    inside = x >= e if above else x <= e
    cuts = inside != inside[q]
    with np.errstate(divide="ignore", invalid="ignore"):
        v = y + (y[q] - y) * (e - x) / (x[q] - x)
    kept = np.stack([inside, cuts], 1).ravel()
    both = lambda a, b: np.stack([a, b], 1).ravel()[kept]
    return both(x, e), both(y, v), both(of, of)


def _areas_in_boxes(ring: pa.Array, box: pa.Array) -> pa.Array:
    valid = np.logical_and(*[a.is_valid().to_numpy(zero_copy_only=False) for a in (ring, box)])
    n = np.where(valid, ring.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(int)
    where = np.flatnonzero(valid)
    corners = ring.take(pa.array(where)).flatten()
    x, y = (corners.field(c).to_numpy(zero_copy_only=False).astype(float) for c in (corners.type.field(0).name, corners.type.field(1).name))
    b = np.full((len(ring), 4), np.nan)
    b[where] = box.take(pa.array(where)).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
    of = np.repeat(np.arange(len(ring)), n)
    x, y, of = _beside(x, y, of, b[:, 0], True)
    x, y, of = _beside(x, y, of, b[:, 2], False)
    y, x, of = _beside(y, x, of, b[:, 1], True)
    y, x, of = _beside(y, x, of, b[:, 3], False)
    left = np.bincount(of, minlength=len(ring))
    q = np.arange(1, len(of) + 1)
    last = np.cumsum(left)[left > 0]
    q[last - 1] = last - left[left > 0]
    x, y = x - b[of, 0], y - b[of, 1]
    area = np.abs(np.bincount(of, x * y[q] - x[q] * y, len(ring))) / 2
    return pa.array(area, mask=left == 0)


def area_in_box(ring: Column, box: Column) -> Column:
    """The area of a simple ring (array<struct(x, y)>) within a box; null where they don't meet. Rings are clipped a batch at
    once, as arrays."""
    # not taken into filters, where it would be computed again
    f = F.arrow_udf(_areas_in_boxes, "double").asNondeterministic()
    point = lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))
    return f(F.transform(ring, point), F.transform(box, lambda v: v.cast("double")))
