"""Keyed state with event-time timers: ageing of what is confirmed again and again, and a breaker over failures.

Both keep, for each key, the rows that the watermark has not passed yet, and take them in order of their time once it has:
so what they say does not depend on how rows fall into batches, and equals what the batch forms say of the same rows. State
lies in the RocksDB store, timers wake a key when something is due, and a key that has nothing to wait for keeps no state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000
STEPS = "stato string, dal timestamp"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started here keep their state in the RocksDB store, which keyed state with timers needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


class _Ordered(StatefulProcessor):
    """Rows of a key in the order of their time: held until the watermark has passed them."""

    #: Kept beside the rows held, as DDL, and what it is before the first row.
    KEPT, NONE = "", ()
    HELD = "ms bigint, ok boolean"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.HELD)
        self.kept = handle.getValueState("kept", self.KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.held.appendList(list(zip(pdf["ms"].tolist(), pdf["ok"].tolist())))
        yield from self.advance(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.advance(key, timerValues.getCurrentWatermarkInMs())

    def advance(self, key, now: int) -> Iterator[pd.DataFrame]:
        held = sorted((r[0], r[1]) for r in self.held.get())
        due, rest = [r for r in held if r[0] <= now], [r for r in held if r[0] > now]
        state = tuple(self.kept.get()) if self.kept.exists() else self.NONE
        out: list[tuple] = []
        for ms, ok in due:
            state = self.take(self.until(state, ms, out), ms, ok, out)
        state = self.until(state, now + 1, out)
        if due:
            self.held.put(rest) if rest else self.held.clear()
        wake = self.next(state)
        if wake is None:
            self.kept.clear()
        else:
            self.kept.update(state)
            self.handle.registerTimer(wake)
        if rest:
            self.handle.registerTimer(rest[0][0])
        if out:
            yield pd.DataFrame({self.key: [key[0]] * len(out), "stato": [s for s, _ in out], "ms": [ms for _, ms in out]})

    def until(self, state: tuple, ms: int, out: list) -> tuple:
        """The state just before ``ms``, with what falls due until then in ``out``."""
        raise NotImplementedError

    def take(self, state: tuple, ms: int, ok: bool, out: list) -> tuple:
        """The state after a row."""
        raise NotImplementedError

    def next(self, state: tuple) -> int | None:
        """When to wake the key again; none if the state says no more than none would."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Ageing(_Ordered):
    """State: the time of the last confirmation, and how many steps of age it has gone through since."""

    KEPT, NONE = "ms bigint, steps int", (None, 0)

    def __init__(self, key: str, fresh: str, steps: list[tuple[int, str]]):
        self.key, self.fresh, self.steps = key, fresh, steps

    def until(self, state, ms, out):
        last, n = state
        while last is not None and n < len(self.steps) and last + self.steps[n][0] < ms:
            out.append((self.steps[n][1], last + self.steps[n][0]))
            n += 1
        # After the last step nothing more can happen but a confirmation, which begins anew: the key is forgotten.
        return self.NONE if n == len(self.steps) else (last, n)

    def take(self, state, ms, ok, out):
        if state[0] is None or state[1]:
            out.append((self.fresh, ms))
        return (ms, 0)

    def next(self, state):
        return None if state[0] is None else state[0] + self.steps[state[1]][0] + 1


class Breaker(_Ordered):
    """State: failures in a row, and until when the circuit is open."""

    KEPT, NONE = "errori int, fino bigint", (0, None)

    def __init__(self, key: str, failures: int, pause: int):
        self.key, self.failures, self.pause = key, failures, pause

    def until(self, state, ms, out):
        errors, end = state
        if end is not None and end < ms:
            out.append(("chiuso", end))
            return self.NONE
        return state

    def take(self, state, ms, ok, out):
        errors, end = state
        if end is not None:
            # Nothing should have run; what did anyway counts for nothing.
            return state
        if ok:
            return self.NONE
        if errors + 1 < self.failures:
            return (errors + 1, None)
        out.append(("aperto", ms))
        return (0, ms + self.pause)

    def next(self, state):
        if state == self.NONE:
            return None
        return state[1] + 1 if state[1] is not None else 2**52


def _run(stream: DataFrame, key: str, ts: str, ok: Column, processor: _Ordered, delay: str) -> DataFrame:
    rows = stream.select(key, ts, F.unix_millis(ts).alias("ms"), ok.alias("ok")).where(F.col(ts).isNotNull() & F.col(key).isNotNull())
    schema = StructType([StructField(key, stream.schema[key].dataType), StructField("stato", StringType()), StructField("ms", LongType())])
    out = rows.withWatermark(ts, delay).groupBy(key).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    return out.select(key, "stato", F.timestamp_millis("ms").alias("dal"))


def ageing(stream: DataFrame, key: str, ts: str, fresh: str, steps: list[tuple[int, str]], delay: str = "1 day") -> DataFrame:
    """``key, stato, dal`` for each change: ``fresh`` with the first confirmation and with each after a step, and ``steps``
    (days since the last confirmation, name; ascending) as they fall due. A step is due after its days, not on them.

    Rows without a key or time are left out; rows that come later than ``delay`` are too. Of steps that the watermark has not
    reached nothing is said. Times count in milliseconds.
    """
    return _run(stream, key, ts, F.lit(True), Ageing(key, fresh, [(days * DAY, name) for days, name in steps]), delay)


def aged(rows: DataFrame, key: str, ts: str, fresh: str, steps: list[tuple[int, str]], until: Column) -> DataFrame:
    """The batch form of ``ageing``, for the rows up to ``until``."""
    ms = F.unix_millis(ts)
    end = F.unix_millis(until)
    seen = rows.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(key, ms.alias("_ms")).where(F.col("_ms") <= end)
    w = Window.partitionBy(key).orderBy("_ms")
    seen = seen.withColumns({"_before": F.lag("_ms").over(w), "_after": F.lead("_ms").over(w)})
    first = seen.where(F.col("_before").isNull() | (F.col("_ms") - F.col("_before") > steps[0][0] * DAY)).select(key, F.lit(fresh).alias("stato"), F.col("_ms").alias("_at"))
    limit = F.coalesce("_after", end + 1)
    for days, name in steps:
        due = F.col("_ms") + days * DAY
        first = first.unionByName(seen.where(due < limit).select(key, F.lit(name).alias("stato"), due.alias("_at")))
    return first.select(key, "stato", F.timestamp_millis("_at").alias("dal"))


def breaker(stream: DataFrame, key: str, ts: str, failed: str, failures: int, pause_minutes: int, delay: str = "1 hour") -> DataFrame:
    """``key, stato, dal`` for each change of a circuit: ``aperto`` with the last of so many failures in a row, ``chiuso``
    when its pause is over; then failures count from 0. A success clears the count, what runs while it is open counts for
    nothing. Rows of one time go failures first.
    """
    return _run(stream, key, ts, ~F.coalesce(F.col(failed), F.lit(False)), Breaker(key, failures, pause_minutes * 60_000), delay)
