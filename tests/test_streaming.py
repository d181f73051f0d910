import os

from pyspark.sql import functions as F

from plumbline.streaming import funnel


def test_windows_and_sessions_agree_with_a_batch(spark, sf_dir, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartitionByRange(4, "ts").write.mode("overwrite").parquet(str(source))
    for i, part in enumerate(sorted(source.glob("part-*"))):  # files are taken by age
        os.utime(part, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = funnel.read_events(spark, str(source), 1)
    for name, build in (("w", funnel.window_counts), ("s", funnel.sessions)):
        out = f"{tmp_path}/{name}"
        funnel.run_to_table(build(stream), out, f"{tmp_path}/{name}-marks")
        got = spark.read.parquet(out)
        total = build(events.withColumn("ts", F.col("ts").cast("timestamp")))
        keys = [c for c in total.columns if c not in ("n", "value")]
        # append mode emits what the watermark has passed: a subset of the batch's rows, equal in value
        assert got.count() > 0
        assert got.select(*keys, "n").exceptAll(total.select(*keys, "n")).count() == 0


def test_repeats_are_dropped(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    both = events.union(events.limit(50))
    (tmp_path / "in").mkdir()
    both.coalesce(2).write.mode("overwrite").parquet(str(tmp_path / "in"))
    funnel.run_to_table(funnel.first_sightings(funnel.read_events(spark, str(tmp_path / "in")), "60 days"), f"{tmp_path}/out", f"{tmp_path}/marks")
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()
