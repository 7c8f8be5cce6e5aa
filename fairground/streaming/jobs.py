"""Structured Streaming forms: deduplicated posts, daily quota windows, sessions, event upserts.

All work in event time: a late post counts on the day it was published.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_stream(spark: SparkSession, path: str, schema, ts: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream, with ``ts`` as a timestamp."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def deduplicated(stream: DataFrame, keys: list[str], ts: str, delay: str = "2 days") -> DataFrame:
    """Rows by key once, with state kept for ``delay`` of event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def daily_usage(stream: DataFrame, ts: str, budget: int, delay: str = "1 day") -> DataFrame:
    """Extractions of each day, their share of the budget and the light it shows."""
    from fairground.functions.scores import light

    days = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day")).agg(F.count("*").alias("usate"))
    share = F.col("usate") / budget
    return days.select(F.to_date("window.start").alias("giorno"), "usate", share.alias("quota"), light(share >= 0.85, share >= 0.7).alias("semaforo"))


def sessions(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Runs of a key's rows without a gap."""
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("inizio"), F.col("session_window.end").alias("fine"), "n")


def error_counts(outcomes: DataFrame, key: str = "source_id", ts: str = "ts", failed: str = "fallita") -> DataFrame:
    """``key, errori, ultimo``: failures since the last success of each key, kept as state and sent after each batch."""

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, last = state.get if state.exists else (0, None)
        good, bad = None, []
        for rows in batches:
            wrong = rows[failed].to_numpy(bool)
            fine = rows[ts][~wrong].max()
            good = fine if good is None or pd.isna(good) or fine > good else good
            # Failures before the last success so far are done with: only those after it are held.
            after = rows[ts][wrong]
            bad = [b[b > good] if good is not None and not pd.isna(good) else b for b in [*bad, after]]
            newest = rows[ts].max()
            last = newest if last is None or newest > last else last
        known = good is not None and not pd.isna(good)
        count = sum(map(len, bad)) + (0 if known else count)
        state.update((count, last))
        yield pd.DataFrame({key: [keys[0]], "errori": [count], "ultimo": [last]})

    kind = outcomes.schema[key].dataType.simpleString()
    return outcomes.select(key, ts, failed).groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, errori long, ultimo timestamp", "errori long, ultimo timestamp", "update", GroupStateTimeout.NoTimeout)


def into_table(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True):
    """Run ``merge(batch, epoch)`` on every micro-batch. Offsets are committed after it, so a crash loses no post and a
    merge by key makes a repeated batch harmless."""
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def into_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Drain what is there into Parquet files in the shared folder, and read them.

    Each batch is written to a folder of its own, so a batch that is done again replaces what it wrote. In append mode
    all batches are the result; a complete result is the last batch; of updates the last row of each of ``keys`` counts.
    """
    schema = stream.schema

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    # Any folder is there to be read even if no batch came.
    spark = stream.sparkSession
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/epoch=-1")
    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "epoch long"])).parquet(path)
    if mode == "append":
        return rows.drop("epoch")
    if mode == "complete":
        last = rows.agg(F.max("epoch").alias("_last"))
        return rows.join(F.broadcast(last), F.col("epoch") == F.col("_last")).drop("epoch", "_last")
    names = [f.name for f in schema]
    return rows.groupBy(*(keys or [])).agg(F.max_by(F.struct(*names), "epoch").alias("_r")).select("_r.*")
