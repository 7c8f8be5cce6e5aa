"""Keyed state with timers: equal to the batch form however rows fall into batches, with a restart in between."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fairground.streaming import jobs, timers

DAY = datetime(2026, 1, 1)
STEPS = [(3, "da_verificare"), (9, "sospesa")]


def land(spark, path, rows, batch):
    spark.createDataFrame([(k, DAY + timedelta(hours=h), bad) for k, h, bad in rows], "k string, ts timestamp, fallita boolean").coalesce(1).write.parquet(f"{path}/in/b{batch:03}")


def drained(spark, path, make):
    """One run over what has landed, from the checkpoint of the run before."""
    stream = spark.readStream.schema("k string, ts timestamp, fallita boolean").option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    with timers.rocksdb(spark):
        rows = make(stream)
        rows.writeStream.foreachBatch(lambda b, epoch: b.write.mode("overwrite").parquet(f"{path}/out/epoch={epoch}")).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()


def changes(spark, path):
    return sorted((r.k, r.dal, r.stato) for r in spark.read.parquet(f"{path}/out").collect())


def batches(seed, n=160, lots=4, late=20):
    """Rows of eight keys over sixty days, a little out of order, in lots."""
    rng = random.Random(seed)
    rows = sorted((h + rng.randint(-late, late), h) for h in (rng.randint(30, 1400) for _ in range(n)))
    rows = [(rng.choice("abcdefgh"), h, rng.random() < 0.5) for _, h in rows]
    return [rows[i * n // lots : (i + 1) * n // lots] for i in range(lots)] + [[("end", 2000, False)]]


def test_ageing_equals_the_batch_form_over_a_restart(spark, tmp_path):
    make = lambda s: timers.ageing(s, "k", "ts", "attiva", STEPS, "2 days")
    lots = batches(3)
    for i, lot in enumerate(lots):
        land(spark, tmp_path, lot, i)
        if i in (1, len(lots) - 1):
            # Two runs: the second goes on from where the first stopped.
            drained(spark, tmp_path, make)
    until = F.lit(DAY + timedelta(hours=2000) - timedelta(days=2))
    want = sorted((r.k, r.dal, r.stato) for r in timers.aged(spark.read.parquet(f"{tmp_path}/in/*"), "k", "ts", "attiva", STEPS, until).collect())
    got = changes(spark, tmp_path)
    assert got == want and {s for *_, s in got} == {"attiva", "da_verificare", "sospesa"} and len(got) > 30


def slow_breaker(rows, failures, pause, end):
    out = []
    for k in sorted({r[0] for r in rows}):
        errors, until = 0, None
        for _, h, bad in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], not r[2])):
            if until is not None and until < h:
                errors, until = 0, None
            if until is not None or h > end:
                continue
            errors = errors + 1 if bad else 0
            if errors == failures:
                out.append((k, DAY + timedelta(hours=h), "aperto"))
                errors, until = 0, h + pause
                if until <= end:
                    out.append((k, DAY + timedelta(hours=until), "chiuso"))
    return sorted(out)


@pytest.mark.parametrize("seed", [5])
def test_breaker_equals_one_pass_row_by_row(spark, tmp_path, seed):
    lots = batches(seed)
    for i, lot in enumerate(lots):
        land(spark, tmp_path, lot, i)
    drained(spark, tmp_path, lambda s: timers.breaker(s, "k", "ts", "fallita", 2, 48 * 60, "2 days"))
    want = slow_breaker([r for lot in lots for r in lot], 2, 48, 2000 - 48)
    assert changes(spark, tmp_path) == want and len(want) > 10


def test_no_key_and_no_time(spark):
    rows = spark.createDataFrame([(None, DAY), ("a", None), ("a", DAY)], "k string, ts timestamp")
    out = timers.aged(rows, "k", "ts", "attiva", STEPS, F.lit(DAY + timedelta(days=4)))
    assert sorted((r.k, r.stato) for r in out.collect()) == [("a", "attiva"), ("a", "da_verificare")]
    assert timers.aged(rows.limit(0), "k", "ts", "attiva", STEPS, F.lit(DAY)).count() == 0
