"""Aggregates: ordered ones, least squares, votes, consensus, conflict rules and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G



def upper_median_of(column: str) -> Column:
    return F.expr(f"-percentile_disc(0.5) WITHIN GROUP (ORDER BY -`{column}`)")


def p90_of(column: str) -> Column:
    """The nearest rank: the value at place ceil(0.9 n)."""
    return F.expr(f"percentile_disc(0.9) WITHIN GROUP (ORDER BY `{column}`)")


def rms(x: Column) -> Column:
    return F.coalesce(F.sqrt(F.avg(x * x)), F.lit(0.0))


def fit_affine(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, m): the least-squares model of each group's points (px, py, x, y); null under three or on one line.

    Two passes: means, then sums of centred products, so that large coordinates cost no digits. Both aggregate before they
    shuffle, so a large group is no burden.
    """
    mean = points.groupBy(*keys).agg(*[F.avg(c).alias(f"m_{c}") for c in ("px", "py", "x", "y")], F.count(F.lit(1)).alias("n"))
    c = points.join(mean, keys)
    d = {v: F.col(v) - F.col(f"m_{v}") for v in ("px", "py", "x", "y")}
    sums = {"uu": d["px"] * d["px"], "uv": d["px"] * d["py"], "vv": d["py"] * d["py"], "ux": d["px"] * d["x"], "vx": d["py"] * d["x"], "uy": d["px"] * d["y"], "vy": d["py"] * d["y"]}
    s = c.groupBy(*keys, "n", "m_px", "m_py", "m_x", "m_y").agg(*[F.sum(e).alias(k) for k, e in sums.items()])
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    ok = (F.col("n") >= 3) & (det > 1e-9 * F.col("uu") * F.col("vv"))
    safe = F.when(ok, det)
    line = lambda t: ((F.col(f"u{t}") * F.col("vv") - F.col(f"v{t}") * F.col("uv")) / safe, (F.col(f"v{t}") * F.col("uu") - F.col(f"u{t}") * F.col("uv")) / safe)
    (a1, a2), (b1, b2) = line("x"), line("y")
    s = s.select(*keys, "n", "m_px", "m_py", "m_x", "m_y", a1.alias("a1"), a2.alias("a2"), b1.alias("b1"), b2.alias("b2"))
    at = lambda t, p, q: F.col(f"m_{t}") - F.col(p) * F.col("m_px") - F.col(q) * F.col("m_py")
    m = G.model(at("x", "a1", "a2"), F.col("a1"), F.col("a2"), at("y", "b1", "b2"), F.col("b1"), F.col("b2"))
    return s.select(*keys, "n", F.when(F.col("a1").isNotNull(), m).alias("m"))


def dedupe_conflict(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One row for each key that has one value only, the first by order; keys with several values go."""
    agg = rows.groupBy(*keys).agg(F.min(value).alias("lo_"), F.max(value).alias("hi_"), F.min(order).alias(order))
    return agg.filter("lo_ <=> hi_").select(*keys, F.col("lo_").alias(value), order)


def consensus(readings: DataFrame, keys: list[str], model: str, lo: str, hi: str, width: int, least: int = 2) -> DataFrame:
    """Readings that meet readings of the same key by at least `least` models in all, their open intervals overlapping.

    Adds `agree`. Intervals meet in cells of `width`, each pair in the cell where the later one begins. Later readings that
    repeat one are not taken out here; `first_readings` does that group by group.
    """
    cells = readings.withColumn("cell_", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    b = cells.select(*keys, "cell_", F.col(model).alias("model_b"), F.col(lo).alias("lo_b"), F.col(hi).alias("hi_b"))
    met = cells.join(b, [*keys, "cell_"]).filter((F.col(lo) < F.col("hi_b")) & (F.col("lo_b") < F.col(hi)))
    met = met.filter(F.floor(F.greatest(F.col(lo), "lo_b") / width) == F.col("cell_"))
    agree = met.groupBy(*keys, model, lo, hi).agg(F.count_distinct("model_b").alias("agree"))
    return agree.filter(F.col("agree") >= least)


def tri_state_vote(votable: Column, inside: Column, worst: Column, least: int = 3, band: float = 2.0, tolerance: float = 75.0) -> Column:
    """True, false or null (abstains): false where enough numerals vote and none lies in its block; true for a majority
    of enough that do, unless one is far off."""
    no = (votable >= least) & (inside == 0)
    yes = (inside >= least) & (2 * inside > votable) & (F.coalesce(worst, F.lit(0.0)) <= band * tolerance)
    return F.when(no, False).when(yes, True)


# Why a vote abstains, in the order in which it would have needed each.
ABSTENTIONS = (
    "fewer_than_2_successful_distinct_model_readings", "no_cross_model_consensus_numeral", "consensus_numerals_without_street_hint",
    "no_usable_era_conversion", "no_matching_addressable_centerline_segment", "fewer_than_3_votable_numerals",
    "mixed_contradictory_evidence", "enough_votable_insufficient_in_block_support",
)


def abstention_class(models: Column, numerals: Column, hints: Column, era_failures: Column, unmatched: Column, votable: Column, mixed: Column, least: int = 3) -> Column:
    """The first reason that holds."""
    tests = [models < 2, numerals == 0, hints == 0, era_failures > 0, unmatched > 0, votable < least, F.coalesce(mixed, F.lit(False))]
    return F.coalesce(*[F.when(t, F.lit(name)) for t, name in zip(tests, ABSTENTIONS, strict=False)], F.lit(ABSTENTIONS[-1]))


def decide(votes: Column, least: int = 2) -> Column:
    """struct(accept, yes, refuted) of a map of tri-state votes."""
    yes = F.map_keys(F.map_filter(votes, lambda _, v: v.eqNullSafe(True)))
    no = F.map_keys(F.map_filter(votes, lambda _, v: v.eqNullSafe(False)))
    return F.struct(((F.size(yes) >= least) & (F.size(no) == 0)).alias("accept"), F.array_sort(yes).alias("yes"), F.array_sort(no).alias("refuted"))


def corroborated(hits: DataFrame, keys: list[str], node: str, distance: str, tol: float = 8.0, least: int = 2, near: float = 2.0) -> DataFrame:
    """(keys, corroborated, near): whether enough distinct nodes agree within tol; or the best does and the k-th nearly."""
    best = hits.groupBy(*keys, node).agg(F.min(distance).alias("d"))
    # of the nodes only the `least` best ones matter, and ranks are limited before the shuffle; counting needs no list
    counts = best.groupBy(*keys).agg(F.count_if(F.col("d") <= tol).alias("good"), F.min("d").alias("first_"))
    w = Window.partitionBy(*keys).orderBy("d", node)
    kth = best.withColumn("r_", F.row_number().over(w)).filter(F.col("r_") <= least).filter(F.col("r_") == least).select(*keys, F.col("d").alias("kth_"))
    agg = counts.join(kth, keys, "left")
    return agg.select(*keys, (F.col("good") >= least).alias("corroborated"), F.coalesce((F.col("first_") <= tol) & (F.col("kth_") <= near * tol), F.lit(False)).alias("near"))


def cell_votes(names: DataFrame, cells: DataFrame, group: str, share: float = 0.6) -> DataFrame:
    """(group, n_names, cx, cy, votes): cells where at least ceil(share * names) distinct names of a group meet.

    names: (group, name); cells: (name, cx, cy), each name's cells with their neighbours.
    """
    names = names.distinct()
    total = names.groupBy(group).agg(F.count(F.lit(1)).alias("n_names"))
    votes = names.join(cells.distinct(), "name").groupBy(group, "cx", "cy").agg(F.count(F.lit(1)).alias("votes"))
    return votes.join(total, group).filter(F.col("votes") >= F.ceil(F.col("n_names") * share))


def without_outliers(centres: DataFrame, limit: float) -> DataFrame:
    """(volume, page, x, y) whose centre is within limit of the volume's upper-median centre, on both axes."""
    mid = centres.groupBy("volume").agg(upper_median_of("x").alias("mx"), upper_median_of("y").alias("my"))
    return centres.join(mid, "volume").filter((F.abs(F.col("x") - F.col("mx")) <= limit) & (F.abs(F.col("y") - F.col("my")) <= limit)).drop("mx", "my")


def densest_angle(angles: DataFrame, group: str, angle: str, tol: float, modulus: float = 180.0) -> DataFrame:
    """(group, angle, n, spread): the angle that most angles of its group lie near, modulo `modulus`.

    Ties go to the least sum of deviations, then to the smaller angle. Angles are counted by value first, so that repeats
    cost nothing, and laid out once more on either side of the circle; running sums up to an angle less tol, to itself and
    to it plus tol then give count and deviations, so that no two angles are compared.
    """
    c = angles.groupBy(group, F.pmod(F.col(angle), F.lit(modulus)).alias("a")).agg(F.count(F.lit(1)).alias("k"))
    turns = F.array(F.lit(-modulus), F.lit(0.0), F.lit(modulus))
    at = lambda x, kind, k: F.struct(x.alias("x"), F.lit(kind).alias("kind"), k.alias("k"))
    a = F.col("a")
    # at equal places: where a span begins, the angles, where it is halved, where it ends
    marks = F.array(at(a - tol, 0, F.lit(0).cast("long")), at(a, 2, F.lit(0).cast("long")), at(a + tol, 3, F.lit(0).cast("long")))
    events = c.select(group, "a", F.explode(F.concat(marks, F.transform(turns, lambda t: at(a + t, 1, F.col("k"))))).alias("e")).select(group, "a", "e.*")
    w = Window.partitionBy(group).orderBy("x", "kind").rowsBetween(Window.unboundedPreceding, 0)
    run = events.withColumns({"n_": F.sum("k").over(w), "s_": F.sum(F.col("k") * F.col("x")).over(w)}).filter("kind <> 1")
    s = run.groupBy(group, "a").pivot("kind", [0, 2, 3]).agg(F.first("n_").alias("n"), F.first("s_").alias("s"))
    below, above = F.col("2_n") - F.col("0_n"), F.col("3_n") - F.col("2_n")
    spread = a * below - (F.col("2_s") - F.col("0_s")) + F.col("3_s") - F.col("2_s") - a * above
    best = s.withColumns({"n": below + above, "spread": F.round(spread, 6) + 0.0})
    best = best.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("o"), "spread", "a")).alias("b"))
    return best.select(group, F.col("b.a").alias("angle"), (-F.col("b.o")).alias("n"), F.col("b.spread").alias("spread"))


def violations(aliases: DataFrame, index: DataFrame) -> DataFrame:
    """(kind, key): aliases (key, value) that break a rule against index (key): unknown targets, shadowed names, chains."""
    t = aliases.join(index.select(F.col("key").alias("value")).distinct(), "value", "left_anti").select(F.lit("unknown").alias("kind"), "key")
    shadow = aliases.join(index.select("key").distinct(), "key", "left_semi").select(F.lit("shadow").alias("kind"), "key")
    chain = aliases.join(aliases.select(F.col("key").alias("value")).distinct(), "value", "left_semi").select(F.lit("chain").alias("kind"), "key")
    merge = aliases.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    merge = aliases.join(merge, "value", "left_semi").select(F.lit("merge").alias("kind"), "key")
    return t.union(shadow).union(chain).union(merge)


def agreeing_ranges(entries: DataFrame, width: int, apart: int = 4) -> DataFrame:
    """entries (id, street, old_lo, old_hi, new_lo) that no overlapping one of their street contradicts by more than apart.

    Both sides of a contradiction go. Ranges meet in cells of `width` numbers, each counted once, with the least and the most
    that its entries are moved by, however many they are.
    """
    cells = entries.withColumn("by", F.col("new_lo") - F.col("old_lo")).withColumn("cell", F.explode(F.sequence(F.floor(F.col("old_lo") / width), F.floor(F.col("old_hi") / width))))
    at = ["street", "cell", "old_lo", "old_hi"]
    ranges = cells.groupBy(*at).agg(F.min("by").alias("least"), F.max("by").alias("most"))
    other = ranges.select("street", "cell", *[F.col(c).alias(f"b_{c}") for c in ("old_lo", "old_hi", "least", "most")])
    met = ranges.select(*at).join(other, ["street", "cell"]).filter("old_lo <= b_old_hi and b_old_lo <= old_hi")
    met = met.groupBy(*at).agg(F.min("b_least").alias("least"), F.max("b_most").alias("most"))
    bad = cells.join(met, at).filter((F.col("by") - F.col("least") > apart) | (F.col("most") - F.col("by") > apart))
    # an entry doesn't contradict itself: rows with one id are compared with those of others
    twice = entries.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    b = cells.select("street", "cell", *[F.col(c).alias(f"b_{c}") for c in ("id", "old_lo", "old_hi", "by")])
    checked = bad.join(twice, "id").join(b, ["street", "cell"]).filter("id <> b_id and old_lo <= b_old_hi and b_old_lo <= old_hi").filter(F.abs(F.col("by") - F.col("b_by")) > apart)
    gone = bad.join(twice, "id", "left_anti").select("id").union(checked.select("id")).distinct()
    return entries.join(gone, "id", "left_anti")


def circular_mean(rows: DataFrame, group: str, angle: str, quorum: int) -> DataFrame:
    """(group, n, angle): the mean course of angles modulo 180; null under the quorum."""
    t = 2 * F.radians(angle)
    s = rows.groupBy(group).agg(F.count(angle).alias("n"), F.sum(F.cos(t)).alias("c"), F.sum(F.sin(t)).alias("s"))
    mean = F.pmod(F.degrees(F.atan2("s", "c")) / 2, F.lit(180.0))
    return s.select(group, "n", F.when(F.col("n") >= quorum, mean).alias("angle"))


def adopted(chains: DataFrame) -> DataFrame:
    """chains (chain, name, parity, lo, hi) with nameless ones under the name of their only named twin of the other parity
    whose numbers overlap."""
    n = chains.filter("name is not null").select(F.col("name").alias("twin"), F.col("parity").alias("p2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.floor(F.col("lo") / 1000).alias("c0"), F.floor(F.col("hi") / 1000).alias("c1"))
    n = n.withColumn("cell", F.explode(F.sequence("c0", "c1")))
    o = chains.filter("name is null").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / 1000), F.floor(F.col("hi") / 1000))))
    met = o.join(n, "cell").filter("parity <> p2 and lo <= hi2 and lo2 <= hi").select("chain", "twin", "lo2", "hi2").distinct()
    one = met.groupBy("chain").agg(F.count(F.lit(1)).alias("k"), F.min("twin").alias("twin")).filter("k = 1").select("chain", "twin")
    return chains.join(one, "chain", "left").withColumn("name", F.coalesce("name", "twin")).drop("twin")


def gate(before_after: DataFrame, volume: str, limit: float) -> DataFrame:
    """(volume, before, after, n, passed): medians of sheets' rms before and after, and whether it didn't get worse."""
    g = before_after.groupBy(volume).agg(F.median("rms_before").alias("before"), F.median("rms_after").alias("after"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("passed", F.col("after") <= F.col("before") + limit)


def tier(reads: Column, candidates: Column, distance: Column, near: float = 400.0, least: int = 2) -> Column:
    """The rule that a proposal meets first."""
    return (
        F.when(candidates == 0, "no-candidate").when(reads < least, "held: too few reads").when(candidates > 1, "held: several candidates")
        .when(distance.isNull(), "held: no locality").when(distance > near, "refused: far").otherwise("clean")
    )
