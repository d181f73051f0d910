"""Sequences: runs, islands, pieces of polylines, even samples, places in an order, and kernels that go row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def islands(rows: DataFrame, group: list[str], order: list[str], breaks: Column) -> DataFrame:
    """rows with `island`: how often `breaks` has been true in the group so far. breaks may use F.lag over `window`."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("break_", F.coalesce(breaks, F.lit(False)).cast("int")).withColumn("island", F.sum("break_").over(w)).drop("break_")


def lag(column: str, group: list[str], order: list[str]) -> Column:
    return F.lag(column).over(Window.partitionBy(*group).orderBy(*order))


def lead(column: str, group: list[str], order: list[str]) -> Column:
    return F.lead(column).over(Window.partitionBy(*group).orderBy(*order))


def joined_lines(lines: DataFrame, group: list[str], order: list[str], line: str) -> DataFrame:
    """(group, line) of the entries of printed lists: a line that doesn't end in a full stop goes on in the next one, unless
    that begins with a dash. Blank lines are left out."""
    some = lines.withColumn(line, F.regexp_replace(F.col(line), r"\s+$", "")).filter(F.trim(line) != "")
    before = lag(line, group, order)
    opens = F.endswith(before, F.lit(".")) | F.startswith(F.ltrim(line), F.lit("-"))
    parts = F.array_sort(F.collect_list(F.struct(*order, F.trim(line).alias("text_"))))
    whole = F.array_join(F.transform(parts, lambda p: p["text_"]), " ")
    return islands(some, group, order, opens).groupBy(*group, "island").agg(whole.alias(line)).select(*group, line)


def split_sustained(rows: DataFrame, group: list[str], order: list[str], value: str, accepted: Column) -> DataFrame:
    """rows with `piece`: a run is split where an accepted value drops under the accepted one before it and the next
    accepted one is under that too; a single low value is a misread and stays. Rows that aren't accepted go with the run."""
    keys = ", ".join(f"`{c}`" for c in group), ", ".join(f"`{c}`" for c in order)
    near = lambda f: F.expr(f"{f}(ok_) ignore nulls over (partition by {keys[0]} order by {keys[1]})")
    r = rows.withColumn("ok_", F.when(accepted, F.col(value)))
    r = r.withColumns({"prev_": near("lag"), "next_": near("lead")})
    drop = (F.col("ok_") < F.col("prev_")) & (F.col("next_") < F.col("prev_"))
    return islands(r, group, order, drop).withColumnRenamed("island", "piece").drop("ok_", "prev_", "next_")


def cut_at_shared(vertices: DataFrame) -> DataFrame:
    """(way, piece, points): ways cut at inner vertices that another street uses; such a vertex ends one piece and begins
    the next. vertices: (way, street, pos, node)."""
    shared = vertices.groupBy("node").agg(F.count_distinct("street").alias("k")).filter("k > 1").select("node", F.lit(True).alias("shared"))
    w = Window.partitionBy("way")
    v = vertices.join(shared, "node", "left").withColumn("last", F.max("pos").over(w))
    inner = F.coalesce(F.col("shared"), F.lit(False)) & (F.col("pos") > 0) & (F.col("pos") < F.col("last"))
    v = v.withColumn("cut", inner.cast("int"))
    v = v.withColumn("piece", F.sum("cut").over(w.orderBy("pos")))
    both = F.when(F.col("cut") == 1, F.array(F.col("piece") - 1, F.col("piece"))).otherwise(F.array("piece"))
    v = v.withColumn("piece", F.explode(both))
    return v.groupBy("way", "street", "piece").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda x: x["node"]).alias("nodes"))


def even_places(n: Column, k: int) -> Column:
    """Places (from 0) of k evenly spaced rows of n, both ends among them; all where there are no more."""
    spread = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (n - 1) / F.lit(max(k - 1, 1))).cast("long"))
    return F.when(n <= k, F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)).cast("long"))).otherwise(F.array_distinct(spread))


def sample_evenly(rows: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """k evenly spaced rows of each group, by rank."""
    ranked = ranked_in_group(rows, group, order)
    total = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n_")).select(*group, F.explode(even_places(F.col("n_"), k)).alias("place_"))
    return ranked.join(F.broadcast(total) if not group else total, [*group, "place_"]).drop("place_")


def ranked_in_group(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """rows with `place_`, their rank in the group from 0.

    The rank is taken in slices of the order's first column, whose sizes are added up, so a group may hold most of the rows.
    """
    slices = rows.withColumn("slice_", F.floor(F.col(order[0]).cast("double") / 1024))
    sizes = slices.groupBy(*group, "slice_").agg(F.count(F.lit(1)).alias("k_"))
    before = sizes.withColumn("before_", F.sum("k_").over(Window.partitionBy(*group).orderBy("slice_")) - F.col("k_")).drop("k_")
    w = Window.partitionBy(*group, "slice_").orderBy(*order)
    out = slices.withColumn("r_", F.row_number().over(w)).join(before, [*group, "slice_"])
    return out.withColumn("place_", F.col("before_") + F.col("r_") - 1).drop("slice_", "r_", "before_")


def places(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their place from 1 in an order over all of them.

    A range sort, a count for each partition, and ranks within partitions: no task holds more than its range. The order has
    to be total. The sorted rows are counted and ranked in the same job, on their partition number.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part_", F.spark_partition_id()).withColumn("id_", F.monotonically_increasing_id())
    sizes = dealt.groupBy("part_").agg(F.count(F.lit(1)).alias("k_"), F.min("id_").alias("first_"))
    before = sizes.withColumn("before_", F.sum("k_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("part_", "first_", F.coalesce("before_", F.lit(0)).alias("before_"))  # a row for each partition
    out = dealt.join(F.broadcast(before), "part_")
    return out.withColumn(name, F.col("before_") + F.col("id_") - F.col("first_") + 1).drop("part_", "id_", "first_", "before_")


def latest(rows: DataFrame, group: list[str], time: str, tie: str) -> DataFrame:
    """Each group's latest row; the smaller tie-breaker of equal times. An aggregate, nothing is sorted."""
    rest = [c for c in rows.columns if c not in group]
    best = rows.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(F.col(time), -F.col(tie))).alias("r"))
    return best.select(*group, *[F.col(f"r.{c}").alias(c) for c in rest])


def compressed(chain: DataFrame, group: list[str], order: str, old: str, new: str, block: int = 100) -> DataFrame:
    """(group, hundred, old_first, old_last, new_first, new_last, n, worst): a chain of pairs by blocks of its new numbers.

    worst: the largest deviation from the line between a block's first and last pair.
    """
    c = chain.withColumn("hundred", F.floor(F.col(new) / block))
    ends = c.groupBy(*group, "hundred").agg(
        F.min_by(F.struct(F.col(old).alias("o"), F.col(new).alias("n")), order).alias("a"), F.max_by(F.struct(F.col(old).alias("o"), F.col(new).alias("n")), order).alias("z"), F.count(F.lit(1)).alias("n"),
    )
    both = c.join(ends, [*group, "hundred"])
    step = F.coalesce((F.col("z.n") - F.col("a.n")) / F.nullif(F.col("z.o") - F.col("a.o"), F.lit(0)), F.lit(0.0))
    dev = F.abs(F.col("a.n") + (F.col(old) - F.col("a.o")) * step - F.col(new))
    return both.groupBy(*group, "hundred").agg(
        F.first("a.o").alias("old_first"), F.first("z.o").alias("old_last"), F.first("a.n").alias("new_first"), F.first("z.n").alias("new_last"),
        F.first("n").alias("n"), F.max(dev).alias("worst"),
    )


def drawn(rows: DataFrame, stratum: str, order: list[str], counts: list[tuple[str, int]], seed: int) -> DataFrame:
    """rows of the strata with `draw`, the place in which a seeded sample without repeats takes them; too few rows raise.

    The sample of the i-th stratum is that of `random.Random(seed + i)` over its rows in order. What it takes depends on how
    many rows there are, not on the rows, so that only the counts of the named strata come to the driver.
    """
    import random

    some = rows.filter(F.col(stratum).isin(*[name for name, _ in counts]))
    have = {r[0]: r[1] for r in some.groupBy(stratum).agg(F.count(F.lit(1))).collect()}  # a row for each named stratum
    taken = []
    for i, (name, k) in enumerate(counts):
        if have.get(name, 0) < k:
            raise ValueError(f"{name}: {have.get(name, 0)} rows for a sample of {k}")
        taken += [(name, place, draw) for draw, place in enumerate(random.Random(seed + i).sample(range(have[name]), k))]
    kind = rows.schema[stratum].dataType.simpleString()
    places_ = rows.sparkSession.createDataFrame(taken, f"`{stratum}` {kind}, place_ long, draw long")
    return ranked_in_group(some, [stratum], order).join(F.broadcast(places_), [stratum, "place_"]).drop("place_")  # the sample's rows
