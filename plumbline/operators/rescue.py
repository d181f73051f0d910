"""Rescue of rejected sheets: their scale and rotation are pinned, only a translation is looked for, page by page.

A page is bounded by its labels. Its candidates are sorted by explicit ordinals first, so that the result is the same
however rows are dealt out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stages as T

# How close translations agree, anchors at least, also on a sheet's own grid with and without a pair of
# anchors that share no street, and how far that grid has to be off the volume's, folded to quarter and half turns.
TOL_M, LEAST, OWN_LEAST, OWN_SHARED_LEAST, OWN_OFF, OWN_TURN = 12.0, 2, 3, 4, 2.0, 15.0
RAIL = "RR "


@dataclass
class Points:
    """Candidates: pixels, places, and the two streets (normalized) that cross there."""

    pixel: np.ndarray
    world: np.ndarray
    streets: list[frozenset[str]]

    def offsets(self, scale: float, rotation: float) -> np.ndarray:
        """The translation that each candidate implies; rows of a scan run down."""
        c, s = math.cos(math.radians(rotation)) * scale, math.sin(math.radians(rotation)) * scale
        return self.world - self.pixel @ np.array([[c, s], [s, -c]])

    def disjoint(self, own: list[int]) -> bool:
        """Whether two of these share no street."""
        some = list({self.streets[i] for i in own})
        return any(not a & b for i, a in enumerate(some) for b in some[i + 1 :])

    def independent(self, own: list[int]) -> bool:
        """Enough candidates of two pairs of streets and two pixels at least."""
        return len(own) >= LEAST and len({self.streets[i] for i in own}) > 1 and len({tuple(np.round(self.pixel[i])) for i in own}) > 1

    def rail(self, own: list[int]) -> bool:
        return any(s.startswith(RAIL) for i in own for s in self.streets[i])


def _densest(p: Points, offsets: np.ndarray, shared_rail: bool) -> list[int]:
    """The first largest cluster of offsets; one with a railway has to be independent, and without shared_rail disjoint."""
    best: list[int] = []
    for at in offsets:
        own = np.flatnonzero(np.hypot(*(offsets - at).T) <= TOL_M).tolist()
        if len(own) > len(best) and (not p.rail(own) or (p.independent(own) and (shared_rail or p.disjoint(own)))):
            best = own
    return best


def pinned_fit(p: Points, scale: float, rotation: float) -> tuple[np.ndarray, list[int]] | None:
    """(translation, anchors) at a scale and rotation, the anchors sharing a street or not.

    A railway cluster whose anchors share a street is taken only where no other one does.
    """
    if not len(p.streets):
        return None
    offsets = p.offsets(scale, rotation)
    for shared_rail in (False, True):
        own = _densest(p, offsets, shared_rail)
        if p.independent(own):
            return offsets[own].mean(0), own
    return None


def own_grid_pin(own: float | None, volume: float) -> float | None:
    """A sheet's own rotation where it differs enough from the volume's to be another hypothesis."""
    if own is None or math.isnan(own):
        return None
    quarter, half = abs((own - volume + 45) % 90 - 45), abs((own - volume + 90) % 180 - 90)
    return own if quarter > OWN_OFF or half > OWN_TURN else None


def rescued(p: Points, scale: float, rotation: float, own: float | None = None, quadrants: bool = False) -> tuple[str, float, np.ndarray, list[int]] | None:
    """(how, rotation, translation, anchors): by the volume's pin, else by either end of the sheet's own grid, where
    disjoint anchors go before many, else, if asked for, at the first of the other quadrants that has a cluster."""
    if (found := pinned_fit(p, scale, rotation)) is not None:
        return "pinned", rotation, *found
    if (pin := own_grid_pin(own, rotation)) is not None:
        ends = [(pin + turn, pinned_fit(p, scale, pin + turn)) for turn in (0.0, 180.0)]
        ranked = [(p.disjoint(f[1]), len(f[1]), angle, f) for angle, f in ends if f is not None]
        ranked = [r for r in ranked if r[1] >= (OWN_LEAST if r[0] else OWN_SHARED_LEAST)]
        if ranked:
            best = max(ranked, key=lambda r: r[:2])  # the first of equal ones
            return "own grid", best[2], *best[3]
    for turn in (90.0, 180.0, 270.0) if quadrants else ():
        if (found := pinned_fit(p, scale, rotation + turn)) is not None:
            return "quadrant", rotation + turn, *found
    return None


def rescue(records: DataFrame, candidates: DataFrame, volume: str, key: str, quadrants: bool = False) -> DataFrame:
    """records (volume, key, status, scale, rotation, own_rotation) with what became of them: status, how, dx, dy, turned,
    anchors. A volume at a time, as a page alone is too little work for a group.

    Only rejected records that weren't revoked are tried; those without a cluster keep their status. A cluster with two
    anchors that share no street is a rescue, another one a revoked rescue, whose place neighbours may still vouch for.
    candidates: (volume, key, ord, px, py, x, y, street_a, street_b).
    """
    types = {f.name: f.dataType.simpleString() for f in records.schema.fields}
    fields = [volume, key, "status", "how", "dx", "dy", "turned", "anchors"]
    open_ = F.startswith("status", F.lit("REJECTED")) & ~T.is_revoked(F.col("status"))
    tried = records.filter(open_)
    rest = records.filter(~F.coalesce(open_, F.lit(False)))

    def run(group: tuple, r: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        c = c.sort_values([key, "ord"], kind="stable")
        pages = c[key].to_numpy()
        pixel, world, streets = c[["px", "py"]].to_numpy(float), c[["x", "y"]].to_numpy(float), [frozenset(s) for s in zip(c.street_a, c.street_b, strict=True)]
        for row in r.itertuples():
            page = getattr(row, key)
            a, b = np.searchsorted(pages, page), np.searchsorted(pages, page, "right")
            p = Points(pixel[a:b], world[a:b], streets[a:b])
            found = rescued(p, row.scale, row.rotation, row.own_rotation, quadrants)
            if found is None:
                out.append([group[0], page, row.status, None, None, None, None, 0])
            else:
                how, angle, shift, own = found
                out.append([group[0], page, T.RESCUED if p.disjoint(own) else T.REVOKED, how, float(shift[0]), float(shift[1]), angle, len(own)])
        return pd.DataFrame(out, columns=fields)

    schema = f"`{volume}` {types[volume]}, `{key}` {types[key]}, status string, how string, dx double, dy double, turned double, anchors int"
    done = tried.groupBy(volume).cogroup(candidates.groupBy(volume)).applyInPandas(run, schema)
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("how", "string"), ("dx", "double"), ("dy", "double"), ("turned", "double"))]
    return done.unionByName(rest.select(volume, key, "status", *empty, F.lit(0).alias("anchors")))


def disjoint_pair(sets: Column) -> Column:
    """Whether two of an array's sets of streets share none."""
    return F.exists(sets, lambda a: F.exists(sets, lambda b: ~F.arrays_overlap(a, b)))


def revoke_shared(records: DataFrame, anchors: str) -> DataFrame:
    """records with rescues revoked whose recorded anchors (arrays of streets) all share one."""
    shared = (F.col("status") == T.RESCUED) & (F.size(anchors) > 0) & ~disjoint_pair(F.col(anchors))
    return records.withColumn("status", F.when(F.coalesce(shared, F.lit(False)), F.lit(T.REVOKED)).otherwise(F.col("status")))
