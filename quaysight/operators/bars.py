"""OHLCV bars over event time (AGG-01 to AGG-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of the bar intervals.
INTERVALS = {"1s": 1, "5s": 5, "1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def completeness(n: Column, span_s: Column, window_s: Column) -> Column:
    """0 without trades, 0.3 with one, else 0.7 for the time covered and 0.3 for ten trades (AGG-06)."""
    full = F.round(0.7 * F.least(F.lit(1.0), span_s / window_s) + 0.3 * F.least(F.lit(1.0), n / 10), 3)
    return F.when(n == 0, 0.0).when(n == 1, 0.3).otherwise(full)


def bars(trades: DataFrame, intervals: list[str], keys: list[str]) -> DataFrame:
    """A bar per key, interval and epoch-aligned bucket that has trades.

    trades: keys, trade_id, ts, price, quantity, side. Open, close and tick order follow (ts, trade_id). All intervals share one
    shuffle: the tick window and the aggregation are partitioned alike. vwap is null where the quantity is 0. A side other than buy
    is a sale; nulls in price or quantity are left out of the sums.
    """
    each = trades.withColumn("interval", F.explode(F.array(*[F.struct(F.lit(i).alias("interval"), F.lit(INTERVALS[i]).cast("long").alias("seconds")) for i in intervals])))
    each = each.select(*keys, "trade_id", "ts", "price", "quantity", "side", "interval.interval", "interval.seconds")
    each = each.withColumn("us", micros(F.col("ts"))).withColumn("bar_us", F.col("us") - F.pmod(F.col("us"), F.col("seconds") * 1000000))
    group = [*keys, "interval", "seconds", "bar_us"]
    w = Window.partitionBy(*group).orderBy("us", "trade_id")
    each = each.withColumn("tick", (F.col("price") != F.lag("price").over(w)).cast("int"))
    buy = F.lower("side") == "buy"
    order = F.struct("us", "trade_id")
    out = each.groupBy(*group).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"), F.sum(F.when(buy, F.col("quantity")).otherwise(0.0)).alias("buy_volume"), F.sum(F.when(buy, 0.0).otherwise(F.col("quantity"))).alias("sell_volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"), F.coalesce(F.sum("tick"), F.lit(0)).alias("tick_count"), F.count("*").alias("trade_count"), F.min("us").alias("first_us"), F.max("us").alias("last_us"),
    )
    n, span = F.col("trade_count"), (F.col("last_us") - F.col("first_us")) / 1000000
    return out.select(
        *keys, "interval", F.timestamp_micros("bar_us").cast("timestamp_ntz").alias("bar_start"), "open", "high", "low", "close", "volume", "buy_volume", "sell_volume",
        F.when(F.col("volume") != 0, F.bround(F.col("notional") / F.col("volume"), 8)).alias("vwap"), "tick_count", F.round(F.col("tick_count") / n, 3).alias("tick_to_trade"), "trade_count",
        F.round(n / F.col("seconds"), 3).alias("arrival_rate"), "first_us", "last_us", completeness(n, span, F.col("seconds")).alias("completeness"),
    )


def late_trades(trades: DataFrame, interval: str, keys: list[str], arrival: str = "arrival_ts", grace_s: int = 5) -> DataFrame:
    """Trades per key that arrive more than the grace after the end of their bar (AGG-07)."""
    step = INTERVALS[interval] * 1000000
    end = F.col("us") - F.pmod(F.col("us"), F.lit(step).cast("long")) + step
    t = trades.withColumn("us", micros(F.col("ts"))).withColumn("late", (micros(F.col(arrival)) > end + grace_s * 1000000).cast("long"))
    return t.groupBy(*keys).agg(F.sum("late").alias("late_trades"), F.count("*").alias("trades"))
