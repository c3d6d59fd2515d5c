"""Streaming forms (STR-01 to STR-15): the batch expressions over Structured Streaming, with watermarks for state that ends.

A stream is a DataFrame of readStream whose time column is a TIMESTAMP. drained() runs a query over what a file source has now.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import idempotent_sink, scratch


def file_stream(spark: SparkSession, path: str, time_col: str, most_files: int = 1000) -> DataFrame:
    """A Parquet folder or file as a stream, its time as TIMESTAMP."""
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # a stream takes folders or patterns, and a pattern takes single files too
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(pattern).withColumn(time_col, F.col(time_col).cast("timestamp"))


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Everything that the query gives for the input that there is now, through the idempotent sink; no rows if there is no input. In
    complete mode, what the last micro-batch gave."""
    spark = stream.sparkSession
    path, schema = scratch(spark, "stream"), stream.schema
    spark.createDataFrame([], schema).write.parquet(f"{path}/batch=none")

    def whole(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch=last")

    q = stream.writeStream.outputMode(mode).foreachBatch(whole if mode == "complete" else idempotent_sink(path)).option("checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def bars(trades: DataFrame, keys: list[str], interval: str, grace: str | None = "5 seconds") -> DataFrame:
    """Bars that close once the watermark passes their end, ticks counted in the order of (ts, trade_id) within the bar (STR-01,
    STR-02). Later trades are dropped (STR-03). grace None: the stream has its watermarks already (STR-04)."""
    order = F.struct("ts", "trade_id")
    prices = F.transform(F.array_sort(F.collect_list(F.struct("ts", "trade_id", "price"))), lambda x: x["price"])
    timed = trades.withWatermark("ts", grace) if grace else trades
    out = timed.groupBy(*keys, F.window("ts", interval).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("quantity").alias("volume"), F.count("*").alias("trade_count"), prices.alias("p"),
    )
    steps = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda a, b: (a != b).cast("int"))
    ticks = F.when(F.size("p") < 2, 0).otherwise(F.aggregate(steps, F.lit(0), lambda s, x: s + x))
    return out.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("bar_start"), "open", "high", "low", "close", "volume", "trade_count", ticks.cast("long").alias("tick_count"))


def deduplicated(stream: DataFrame, keys: list[str], ts: str, within: str) -> DataFrame:
    """The first row of each key within the watermark (STR-05, STR-15)."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def sliding_counts(stream: DataFrame, keys: list[str], length: str, slide: str, grace: str) -> DataFrame:
    """Counts per key in sliding windows (STR-11)."""
    return stream.withWatermark("ts", grace).groupBy(*keys, F.window("ts", length, slide).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def late_split(rows: DataFrame, watermark: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows) of a micro-batch against a watermark column, for quarantine in foreachBatch (STR-03)."""
    late = F.col(ts) < F.col(watermark)
    return rows.where(~F.coalesce(late, F.lit(False))), rows.where(late)


def suppressed(stream: DataFrame, key: str, ttl_s: float) -> DataFrame:
    """The first row of a key, then none within ttl_s of the last emitted one, with the number held back before it (STR-06, STR-08).
    State is the last emitted time and a count per key. Rows of a micro-batch are taken in time order."""
    ttl = int(ttl_s * 1e6)

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, 0)
        rows = sorted((us, i) for f in frames for us, i in zip(f["us"].tolist(), f["id"].tolist()))
        out = []
        for us, i in rows:
            if last is None or us - last >= ttl:
                out.append((k[0], i, us, held))
                last, held = us, 0
            else:
                held += 1
        state.update((last, held))
        yield pd.DataFrame(out, columns=["key", "id", "us", "held_before"])

    rows = stream.select(F.col(key).alias("key"), "id", F.unix_micros("ts").alias("us"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, id long, us long, held_before long", "last long, held long", "append", "NoTimeout")


def transitions(stream: DataFrame, key: str, status: str, allowed: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows whose status doesn't follow from the last one of their key (STR-12)."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (last,) = state.get if state.exists else (None,)
        rows = sorted((us, i, s) for f in frames for us, i, s in zip(f["us"].tolist(), f["id"].tolist(), f["status"].tolist()))
        out = []
        for _, i, s in rows:
            if last is not None and s not in allowed.get(last, ()):
                out.append((k[0], i, last, s))
            last = s
        state.update((last,))
        yield pd.DataFrame(out, columns=["key", "id", "before", "status"])

    rows = stream.select(F.col(key).alias("key"), "id", F.unix_micros("ts").alias("us"), F.col(status).alias("status"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, id long, before string, status string", "last string", "append", "NoTimeout")


def hysteresis(ticks: DataFrame, key: str) -> DataFrame:
    """Alarms raised after two stale checks and cleared after two fresh ones below half the threshold; between both nothing changes
    (STR-07, FRE-06). ticks: key, us, id, age_s, limit_s. A batch form of the same walk is in order per key."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        stale, fresh, raised = state.get if state.exists else (0, 0, False)
        rows = sorted((us, i, age, limit) for f in frames for us, i, age, limit in zip(f["us"].tolist(), f["id"].tolist(), f["age_s"].tolist(), f["limit_s"].tolist()))
        out = []
        for us, i, age, limit in rows:
            if age > limit:
                stale, fresh = stale + 1, 0
            elif age < 0.5 * limit:
                stale, fresh = 0, fresh + 1
            if not raised and stale >= 2:
                raised = True
                out.append((k[0], i, us, "raised"))
            elif raised and fresh >= 2:
                raised = False
                out.append((k[0], i, us, "cleared"))
        state.update((stale, fresh, raised))
        yield pd.DataFrame(out, columns=["key", "id", "us", "change"])

    return ticks.select(F.col(key).alias("key"), "us", "id", "age_s", "limit_s").groupBy("key").applyInPandasWithState(step, "key string, id long, us long, change string", "stale long, fresh long, raised boolean", "append", "NoTimeout")


def latest(stream: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """The last known value of each key, for update mode (STR-13)."""
    return stream.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value), F.max("ts").alias("ts"))


def finality(stream: DataFrame, depth: int) -> DataFrame:
    """Rows (chain, id, block) once their block lies `depth` below the chain's tip (STR-09). State is what is still pending of a chain,
    that is the rows of its last blocks."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        tip, blocks, ids = state.get if state.exists else (-1, [], [])
        pending = pd.concat([pd.DataFrame({"block": blocks, "id": ids}, dtype="int64"), *(f[["block", "id"]] for f in frames)])
        tip = max(tip, int(pending["block"].max()) if len(pending) else -1)
        done = pending["block"] <= tip - depth
        state.update((tip, pending["block"][~done].tolist(), pending["id"][~done].tolist()))
        yield pending[done].assign(chain=k[0])[["chain", "id", "block"]]

    return stream.groupBy("chain").applyInPandasWithState(step, "chain string, id long, block long", "tip long, blocks array<long>, ids array<long>", "append", "NoTimeout")


def alerted(stream: DataFrame, alert: Callable[[DataFrame, int], None]):
    """Calls alert(rows, number) for each micro-batch that has rows, for what there is now (UDF-06, STR-10); returns the ended query."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            alert(batch, batch_id)

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", scratch(stream.sparkSession, "progress")).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
