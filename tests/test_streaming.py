"""Streams over a folder of files, drained with what is there."""

from pyspark.sql import functions as F

from fairground.streaming import jobs

SCHEMA = "post_id string, handle string, ts timestamp_ntz"


def write(spark, path, *rows):
    spark.createDataFrame([(p, h, t) for p, h, t in rows], "post_id string, handle string, t string").select("post_id", "handle", F.col("t").cast("timestamp_ntz").alias("ts")).coalesce(1).write.mode("append").parquet(path)


def test_posts_are_merged_once(spark, tmp_path):
    source, seen = f"{tmp_path}/posts", []
    write(spark, source, ("1", "a", "2026-08-20 10:00:00"), ("2", "a", "2026-08-20 11:00:00"), ("1", "a", "2026-08-20 12:00:00"))

    def drain():
        stream = jobs.deduplicated(jobs.read_stream(spark, source, spark.read.parquet(source).schema, "ts"), ["post_id"], "ts")
        jobs.into_table(stream, lambda batch, epoch: seen.extend(r.post_id for r in batch.collect()), f"{tmp_path}/check").awaitTermination()

    drain()
    assert sorted(seen) == ["1", "2"]
    drain()
    assert sorted(seen) == ["1", "2"]  # offsets were committed
    write(spark, source, ("2", "a", "2026-08-20 13:00:00"), ("3", "b", "2026-08-19 09:00:00"))
    drain()
    assert sorted(seen) == ["1", "2", "3"]  # a known post stays out, a late one counts


def test_error_counts_carry_over_batches(spark, tmp_path):
    source = f"{tmp_path}/runs"
    rows = spark.createDataFrame([("a", "2026-08-20 10:00:00", True), ("a", "2026-08-20 11:00:00", True), ("b", "2026-08-20 10:00:00", True), ("b", "2026-08-20 11:00:00", False)], "source_id string, t string, fallita boolean")
    for hour in ("10", "11"):
        rows.where(F.col("t").contains(f" {hour}:")).select("source_id", F.col("t").cast("timestamp").alias("ts"), "fallita").coalesce(1).write.mode("append").parquet(source)
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, "ts", files_per_trigger=10)
    out = jobs.into_files(jobs.error_counts(stream), f"{tmp_path}/out", f"{tmp_path}/check", "update", ["source_id"])
    assert {r.source_id: r.errori for r in out.collect()} == {"a": 2, "b": 0}


def test_daily_usage(spark, tmp_path):
    source = f"{tmp_path}/calls"
    write(spark, source, *((str(i), "a", f"2026-08-20 {i % 24:02d}:00:00") for i in range(8)), ("9", "a", "2026-08-21 00:00:00"))
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, "ts")
    out = jobs.into_files(jobs.daily_usage(stream, "ts", 10), f"{tmp_path}/out", f"{tmp_path}/check", "complete")
    assert {str(r.giorno): (r.usate, r.semaforo) for r in out.collect()} == {"2026-08-20": (8, "giallo"), "2026-08-21": (1, "verde")}
