"""Keyed state with timers: staleness that is noticed though no row comes, and snapshots every N seconds (STR-07, STR-10).

A key is looked at at each multiple of `every_s` after its first row, until it has been silent for `forget_s`; then its state ends. In
event time (the default) a look is taken once the watermark has passed it, so that the result depends on the rows alone, not on how they
fall into micro-batches; with mode "ProcessingTime" it is taken by the clock, and rows count by when they come. Rows that a
look doesn't cover yet wait in the state, summed up per look.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that such operators need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def with_timers(spark: SparkSession) -> None:
    """Sets the state store of the session's queries that start from now on."""
    spark.conf.set(*STORE)


class Looks(StatefulProcessor):
    """Looks at a key at each multiple of every_ms. Subclasses say what a row adds (gathered), and what a look gives (look)."""

    #: Columns of the state, as DDL, and of what waits per look.
    kept, waiting = "", ""

    def __init__(self, every_s: float, forget_s: float, clock: bool):
        self.every, self.forget, self.clock = int(every_s * 1000), int(forget_s * 1000), clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", f"{self.kept}, last bigint")  # last: ms of the newest row that a look has covered
        self.wait = handle.getMapState("wait", "at bigint", f"{self.waiting}, last bigint")

    # In subclasses.
    def gathered(self, rows: pd.DataFrame, before: tuple | None) -> tuple:
        """What rows add to what waits for the same look; rows are in time order, with id as the tie."""
        raise NotImplementedError

    def look(self, key: tuple, at: int, kept: tuple | None, added: tuple | None, last: int) -> tuple[tuple, list[tuple]]:
        """(what is kept, rows out) of a look."""
        raise NotImplementedError

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = pd.concat(list(rows))  # of a micro-batch and key
        ms = found["us"] // 1000
        if self.clock:
            ms = pd.Series(timerValues.getCurrentProcessingTimeInMs(), index=found.index)
        found = found.assign(ms=ms, at=-(-ms // self.every) * self.every).sort_values(["us", "id"], kind="stable")
        for at, part in found.groupby("at"):
            before = self.wait.getValue((int(at),)) if self.wait.containsKey((int(at),)) else None
            new = self.gathered(part, before[:-1] if before else None)
            self.wait.updateValue((int(at),), (*new, max(int(part["ms"].max()), before[-1] if before else 0)))
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(int(found["at"].min()))
        yield self.frame([])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        reached = timerValues.getCurrentProcessingTimeInMs() if self.clock else timerValues.getCurrentWatermarkInMs()
        at, out = expiredTimerInfo.getExpiryTimeInMs(), []
        pending = {k[0]: v for k, v in self.wait.iterator()}
        state = self.now.get() if self.now.exists() else None
        kept, last = (state[:-1], state[-1]) if state else (None, 0)
        while at is not None and at <= reached:
            added = pending.pop(at, None)
            if added is None and at - last > self.forget:  # silent for too long: the state ends; what came since begins anew
                kept, last, at = None, 0, min(pending, default=None)
                continue
            if added is not None:
                self.wait.removeKey((at,))
                last = max(last, added[-1])
            kept, rows = self.look(key, at, kept, added[:-1] if added else None, last)
            out += rows
            at += self.every
        if kept is None:
            self.now.clear()
        else:
            self.now.update((*kept, last))
        if at is not None:
            self.handle.registerTimer(at)
        yield self.frame(out)

    def close(self) -> None:
        pass


class Silence(Looks):
    kept, waiting = "stale bigint, fresh bigint, raised boolean", "n bigint"

    def __init__(self, limit_s: float, every_s: float, forget_s: float, clock: bool):
        super().__init__(every_s, forget_s, clock)
        self.limit = limit_s

    def gathered(self, rows, before):
        return (len(rows) + (before[0] if before else 0),)

    def look(self, key, at, kept, added, last):
        stale, fresh, raised = kept or (0, 0, False)
        age, out = (at - last) / 1000, []
        if age > self.limit:
            stale, fresh = stale + 1, 0
        elif age < 0.5 * self.limit:
            stale, fresh = 0, fresh + 1
        if raised != (stale >= 2 if not raised else fresh < 2):
            raised = not raised
            out.append((key[0], at * 1000, "raised" if raised else "cleared", age))
        return (stale, fresh, raised), out

    def frame(self, rows):
        return pd.DataFrame(rows, columns=["key", "us", "change", "age_s"])


class Snapshot(Looks):
    kept, waiting = "total bigint, value double", "n bigint, value double"

    def gathered(self, rows, before):
        value = rows["value"].dropna()
        return (len(rows) + (before[0] if before else 0), float(value.iloc[-1]) if len(value) else (before[1] if before else None))

    def look(self, key, at, kept, added, last):
        total, value = kept or (0, None)
        n, new = added or (0, None)
        total, value = total + n, value if new is None or pd.isna(new) else new
        return (total, value), [(key[0], at * 1000, n, total, value, (at - last) / 1000)]

    def frame(self, rows):
        return pd.DataFrame(rows, columns=["key", "us", "n", "total", "value", "age_s"])


def _looked(stream: DataFrame, key: str, ts: str, columns: list, processor: Looks, out: str, delay: str, clock: bool) -> DataFrame:
    with_timers(stream.sparkSession)
    timed = stream if clock else stream.withWatermark(ts, delay)
    rows = timed.where(F.col(ts).isNotNull()).select(F.col(key).cast("string").alias("key"), ts, F.unix_micros(ts).alias("us"), *columns)
    return rows.groupBy("key").transformWithStateInPandas(processor, out, "Append", "ProcessingTime" if clock else "EventTime")


def silences(stream: DataFrame, key: str, limit_s: float, every_s: float, forget_s: float, ts: str = "ts", delay: str = "5 seconds", clock: bool = False) -> DataFrame:
    """(key, us, change, age_s): alarms raised at the second look in a row that finds the key's newest row older than limit_s, and cleared at
    the second one that finds it younger than half of that; looks between both change nothing (STR-07). Null keys are a key; rows
    without a time go, late ones too. A key that comes back after forget_s begins anew."""
    return _looked(stream, key, ts, [F.lit(0).cast("long").alias("id")], Silence(limit_s, every_s, forget_s, clock), "key string, us long, change string, age_s double", delay, clock)


def snapshots(stream: DataFrame, key: str, value: str, id_col: str, every_s: float, forget_s: float, ts: str = "ts", delay: str = "5 seconds", clock: bool = False) -> DataFrame:
    """(key, us, n, total, value, age_s): at each look the rows since the one before, all rows so far, and the last value by (ts, id_col)
    that isn't null (STR-10). Otherwise as silences()."""
    columns = [F.col(id_col).cast("long").alias("id"), F.col(value).cast("double").alias("value")]
    return _looked(stream, key, ts, columns, Snapshot(every_s, forget_s, clock), "key string, us long, n long, total long, value double, age_s double", delay, clock)
