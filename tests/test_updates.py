"""Landed updates as a stream: cursors by platform, and a crash between merge and commit."""

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from fairground.sources import updates
from fairground.streaming import jobs

SCHEMA = "piattaforma string, lotto long, post_id long, testo string, assente int"


def land(spark, path, platform, lot, ids, **more):
    rows = spark.createDataFrame([(platform, lot, i, f"t{i}") for i in ids], "piattaforma string, lotto long, post_id long, testo string")
    updates.land(rows.withColumns(more), path)


def merge_into(path, fail_at=None):
    """A merge by key: each epoch's rows replace what it wrote before; it may fail once after it has written."""

    def merge(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        if epoch == fail_at:
            raise RuntimeError("lost between merge and commit")

    return merge


def merged(spark, path):
    return sorted((r.piattaforma, r.lotto, r.post_id) for r in spark.read.parquet(path).collect())


def test_a_crash_loses_and_repeats_nothing(spark, tmp_path):
    landed, out, state = (f"{tmp_path}/{n}" for n in ("landed", "out", "state"))
    run = lambda merge: jobs.into_table(updates.read_updates(spark, f"file://{landed}", SCHEMA), merge, state).awaitTermination()
    land(spark, landed, "facebook", 0, range(5))
    land(spark, landed, "instagram", 3, range(10, 13))
    run(merge_into(out))
    first = [("facebook", 0, i) for i in range(5)] + [("instagram", 3, i) for i in range(10, 13)]
    assert merged(spark, out) == first
    # New lots of one platform and a new platform; the run dies after the merge.
    land(spark, landed, "facebook", 1, range(5, 9))
    land(spark, landed, "telegram", 0, [77])
    with pytest.raises(StreamingQueryException):
        run(merge_into(out, fail_at=1))
    # What lands before the restart waits for a batch of its own: the lost batch is done again as it was.
    land(spark, landed, "instagram", 4, [20])
    for _ in range(2):
        # A run may do no more than the lost batch.
        run(merge_into(out))
    want = sorted([*first, *(("facebook", 1, i) for i in range(5, 9)), ("telegram", 0, 77), ("instagram", 4, 20)])
    assert merged(spark, out) == want
    assert {r.epoch: r.n for r in spark.read.parquet(out).groupBy("epoch").agg(F.count("*").alias("n")).collect()} == {0: 8, 1: 5, 2: 1}
    # Nothing new: nothing read.
    run(merge_into(out))
    assert merged(spark, out) == want


def test_cursors_and_odd_names(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    reader = updates.LotReader(f"file://{landed}", None)
    assert reader.initialOffset() == {} and reader.latestOffset() == {}
    land(spark, landed, "facebook", 2, [1, 2])
    land(spark, landed, "facebook", 10, [3])
    (tmp_path / "landed" / "piattaforma=facebook" / "lotto=x").mkdir()
    (tmp_path / "landed" / "other").mkdir()
    assert reader.latestOffset() == {"facebook": 10}
    assert {p.lot for p in reader.partitions({}, {"facebook": 10})} == {2, 10}
    assert {p.lot for p in reader.partitions({"facebook": 2}, {"facebook": 10})} == {10}
    assert reader.partitions({"facebook": 10}, {"facebook": 10}) == []


def test_columns_a_lot_has_not_are_null(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    land(spark, landed, "facebook", 0, [1])
    land(spark, landed, "facebook", 1, [2], assente=F.lit(4))
    rows = jobs.into_files(updates.read_updates(spark, landed, SCHEMA), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted((r.post_id, r.lotto, r.testo, r.assente) for r in rows.collect()) == [(1, 0, "t1", None), (2, 1, "t2", 4)]
