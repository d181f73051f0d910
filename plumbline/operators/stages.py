"""Records on their way: status rules, transitions, upserts, funnels, rollups and freshness. One module owns each rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import aggs as A

# Statuses of a record.
STRICT, RESCUED, CORROBORATED = "OK", "OK (rescued)", "OK (rescued, neighbor-corroborated)"
VERIFIED_PREFIX, REVIEWER, REVIEWER_OLD = "OK (verified: ", "OK (reviewer-verified)", "OK (owner-verified)"
REJECTED, REVOKED = "REJECTED (no valid RANSAC model)", "REJECTED (rescue revoked: anchors share one street)"
REVOKED_PREFIX = "REJECTED (rescue revoked"
# The bucket of what has no place, the gate of a score, the states of a volume, tolerances about constants.
UNLOCATED, GATE_M = "(footprint unknown)", 15.0
STATES = ("served", "processed-unserved", "ready", "no-scans")
SCALE_TOL, ROTATION_TOL = 0.10, 1.5


def is_committed(status: Column) -> Column:
    return F.startswith(status, F.lit("OK"))


def is_reviewer(status: Column) -> Column:
    return status.isin(REVIEWER, REVIEWER_OLD)


def reviewer_value(suffix: str) -> Column:
    """A reviewer's field of a record; records of before its name was changed have it under the older one."""
    return F.coalesce(F.col(f"reviewer_{suffix}"), F.col(f"owner_{suffix}"))


def is_revoked(status: Column) -> Column:
    return F.startswith(status, F.lit(REVOKED_PREFIX))


def status_verified(channels: Column) -> Column:
    return F.concat(F.lit(VERIFIED_PREFIX), F.array_join(channels, "+"), F.lit(")"))


def build_report(records: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """One row a volume: the funnel of statuses, then statistics of what was accepted automatically.

    records: (volume, status, residual_m, rmse_m, rotation_deg). Reviewers' rows count apart and in no statistic; revoked
    ones count as flagged too.
    """
    s = F.col("status")
    auto = F.coalesce(is_committed(s) & ~is_reviewer(s), F.lit(False))
    r = records.withColumn("auto_", auto).withColumns({c: F.when(F.col("auto_"), F.col(v)) for c, v in (("res_", "residual_m"), ("rmse_", "rmse_m"), ("rot_", "rotation_deg"))})
    known = F.coalesce(s, F.lit(""))
    return r.groupBy("volume").agg(
        F.count(F.lit(1)).alias("n_sheets"), F.count_if(s == STRICT).alias("strict_accepted"), F.count_if(s == RESCUED).alias("rescued"), F.count_if(s == CORROBORATED).alias("corroborated"),
        F.count_if(F.startswith(s, F.lit(VERIFIED_PREFIX))).alias("verified"), F.count_if(is_reviewer(s)).alias("reviewer_verified"), F.count_if(is_revoked(s)).alias("revoked"),
        F.count_if(~is_committed(known)).alias("flagged"), F.round(F.median("res_"), 4).alias("median_residual_m"), F.round(A.p90_of("res_"), 4).alias("p90_residual_m"),
        F.round(F.median("rmse_"), 4).alias("median_rmse_m"), F.count("rmse_").alias("scored"), F.count_if(F.col("auto_") & F.col("rmse_m").isNull()).alias("unscored"),
        F.count_if(F.col("rmse_") > GATE_M).alias("over_gate"), F.min("rot_").alias("rotation_min"), F.max("rot_").alias("rotation_max"), *(extra or []),
    )


def coverage_state(served: Column, processed: Column, scans: Column) -> Column:
    """The one state that a volume is in, the furthest first."""
    return F.when(served, STATES[0]).when(processed, STATES[1]).when(scans, STATES[2]).otherwise(STATES[3])


def rollup(rows: DataFrame, keys: str, name: str) -> DataFrame:
    """Counts by state and the sum of sheets for each of a row's keys; rows with several keys count in each of them.

    `last` marks the bucket of what has no place, which is shown last.
    """
    each = rows.select(F.explode(keys).alias(name), "state", "sheets")
    states = [F.count_if(F.col("state") == s).alias(s.replace("-", "_")) for s in STATES]
    out = each.groupBy(name).agg(F.count(F.lit(1)).alias("volumes"), *states, F.coalesce(F.sum("sheets"), F.lit(0)).alias("sheets"))
    return out.withColumn("last", F.col(name) == UNLOCATED)


def transition(prior: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, status, took): new records over prior ones; a rejection never takes the place of a committed record."""
    p = prior.select(key, F.col("status").alias("prior_"))
    n = new.select(key, F.col("status").alias("new_"))
    both = p.join(n, key, "full")
    keep = F.col("new_").isNull() | (F.coalesce(is_committed(F.col("prior_")), F.lit(False)) & ~is_committed(F.col("new_")))
    return both.select(key, F.when(keep, F.col("prior_")).otherwise(F.col("new_")).alias("status"), (~keep).alias("took"))


def upsert(disk: DataFrame, mine: DataFrame, keys: list[str]) -> DataFrame:
    """Disk rows with mine in their places, and my rows that are new."""
    return disk.join(mine.select(*keys), keys, "left_anti").select(*disk.columns).unionByName(mine.select(*disk.columns))


def add_unless_live(queue: DataFrame, new: DataFrame, key: str, live: Column) -> DataFrame:
    """Queue rows and those new ones whose key has no live row."""
    return queue.unionByName(new.join(queue.filter(live).select(key).distinct(), key, "left_anti").select(*queue.columns))


def seam_shift(dx: Column, dy: Column, applied_dx: Column, applied_dy: Column, least: float = 2.0, skip: float = 0.01) -> Column:
    """struct(dx, dy) still to apply: the rounded total less what was applied; nothing for small totals or rests."""
    total_x, total_y = F.round(dx, 3), F.round(dy, 3)
    rest_x, rest_y = total_x - F.coalesce(applied_dx, F.lit(0.0)), total_y - F.coalesce(applied_dy, F.lit(0.0))
    go = (F.hypot(total_x, total_y) >= least) & (F.hypot(rest_x, rest_y) >= skip)
    return F.struct(F.when(go, rest_x).otherwise(0.0).alias("dx"), F.when(go, rest_y).otherwise(0.0).alias("dy"))


def windows(scale: Column, rotation: Column, multiple: Column | None = None, scale_tol: float = SCALE_TOL, rot_tol: float = ROTATION_TOL) -> Column:
    """struct(scale_lo, scale_hi, rot_lo, rot_hi) about a volume's constants, or about a page's declared multiple of them."""
    s = scale if multiple is None else scale * F.coalesce(multiple, F.lit(1.0))
    return F.struct((s * (1 - scale_tol)).alias("scale_lo"), (s * (1 + scale_tol)).alias("scale_hi"), (rotation - rot_tol).alias("rot_lo"), (rotation + rot_tol).alias("rot_hi"))


def current_scores(records: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Scores of records that haven't changed since: equal digests."""
    return records.select(key, "digest").join(scores, [key, "digest"]).select(key, "rmse_m")


def digest(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def staleness(newest: Column, archive: Column) -> Column:
    """Why an archive has to be built again, or null."""
    return F.when(archive.isNull() & newest.isNotNull(), "missing").when(newest > archive, "stale")


def first_success(tries: DataFrame, keys: list[str], order: str, ok: Column) -> DataFrame:
    """Of each key the first try that succeeded, else the last one."""
    t = tries.withColumn("ok_", ok)
    rest = [c for c in tries.columns if c not in keys]
    rank = F.when(F.col("ok_"), F.struct(F.lit(0).alias("a"), F.col(order).alias("b"))).otherwise(F.struct(F.lit(1).alias("a"), (-F.col(order)).alias("b")))
    picked = t.groupBy(*keys).agg(F.min_by(F.struct(*rest, "ok_"), rank).alias("r"))
    return picked.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest], F.col("r.ok_").alias("succeeded"))


def status_index(keys: DataFrame, facts: dict[str, tuple[DataFrame, Column]], key: str) -> DataFrame:
    """Every key with each fact, left null where a source doesn't know it. facts: name -> (source, its aggregate)."""
    out = keys.select(key).distinct()
    for name, (source, value) in facts.items():
        out = out.join(source.groupBy(key).agg(value.alias(name)), key, "left")
    return out


# Why a volume's era is left open.
ERA_REFUSALS = {"no table": "no renumbering table", "no table year": "no renumbering year", "no year": "no edition year", "same year": "dated in the renumbering year"}


def proposed_era(declared: Column, table: Column, table_year: Column, year: Column) -> Column:
    """struct(modern, refusal): whether a volume prints modern numbers, from its year and the year a city renumbered.

    A declaration goes before everything; what a year can't tell is refused, first reason first.
    """
    known = declared.isNotNull()
    why = F.when(~table, ERA_REFUSALS["no table"]).when(table_year.isNull(), ERA_REFUSALS["no table year"]).when(year.isNull(), ERA_REFUSALS["no year"]).when(year == table_year, ERA_REFUSALS["same year"])
    refusal = F.when(~known, why)
    return F.struct(F.when(known, declared).when(refusal.isNull(), year > table_year).alias("modern"), refusal.alias("refusal"))


def era_of(addresses_modern: Column) -> Column:
    """An era that nobody declared is modern."""
    return F.when(F.coalesce(addresses_modern, F.lit(True)), "modern").otherwise("renumbered")


def without_entries(queue: DataFrame, volume: str, track: str | None = None) -> DataFrame:
    """Queue rows but those of a volume, on one track or on all."""
    gone = F.col("volume") == volume if track is None else (F.col("volume") == volume) & (F.col("track") == track)
    return queue.filter(~F.coalesce(gone, F.lit(False)))


def backlog(volumes: DataFrame, queue: DataFrame, live: Column, runnable: Column) -> DataFrame:
    """(volume, track, runnable) of what can be queued: volumes with sheets and no live entry, to place while results are
    fewer than sheets, else to serve unless they are served by us. volumes: (volume, sheets, results, ours)."""
    busy = queue.filter(live).select("volume").distinct()
    placed = F.coalesce("results", F.lit(0)) >= F.col("sheets")
    track = F.when(~placed, "place").when(~F.coalesce("ours", F.lit(False)), "serve")
    rows = volumes.filter("sheets > 0").join(busy, "volume", "left_anti").withColumn("track", track).filter("track is not null")
    return rows.select("volume", "track", F.coalesce(runnable, F.lit(False)).alias("runnable"))


# When a volume looks short of aliases, and the samples that this takes.
LOW_RATE, LEAST_READS, MANY_EMPTY, LEAST_PAGES = 0.80, 100, 0.10, 10


def alias_gap(rate: Column, reads: Column, empty: Column, pages: Column) -> Column:
    """The parts of an advice, as an array: few reads match, and many pages have no candidates; each needs its sample."""
    few = F.when((rate < LOW_RATE) & (reads >= LEAST_READS), F.format_string("%.0f%% of %d street reads match", F.bround(rate * 100), reads.cast("long")))
    many = F.when((pages >= LEAST_PAGES) & (empty / F.nullif(pages, F.lit(0)) >= MANY_EMPTY), F.format_string("%d of %d pages have no candidates", empty.cast("long"), pages.cast("long")))
    return F.filter(F.array(few, many), lambda x: x.isNotNull())


def gated(records: DataFrame, manifest: DataFrame, key: str, least: int) -> DataFrame:
    """(key, junctions): rejected records, not revoked ones, with junctions enough in the manifest (key, junctions)."""
    s = F.col("status")
    return records.filter(F.startswith(s, F.lit("REJECTED")) & ~is_revoked(s)).select(key).join(manifest.filter(F.col("junctions") >= least), key)


def lost(images: DataFrame, recorded: DataFrame, stem: str, page: Column) -> DataFrame:
    """(id): images whose name gives no page though its tail names a recorded one. recorded: (page)."""
    ident = F.regexp_extract(stem, r"_p((?:(?!_p).)+)$", 1)
    return images.filter(page.isNull()).select(ident.alias("id")).filter("id <> ''").join(recorded.select(F.col("page").alias("id")), "id", "left_semi").distinct()


def staged_export(records: DataFrame, services: DataFrame, key: str, folder: str) -> int:
    """Write the committed records to a staging folder, in place of what is there, and return how many they are.

    Nothing is written unless each of them has a service (key, service); a missing one fails.
    """
    from . import joins as J

    whole = J.required(records.filter(is_committed(F.col("status"))), services, key)
    n = whole.count()  # fails before anything is written
    whole.write.mode("overwrite").json(folder)
    return n
