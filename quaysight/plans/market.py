"""Queries over bars, features, momentum and as-of joins, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof, nearest
from ..operators.bars import bars, late_trades
from ..operators.features import foundation, momentum
from ..sources import adapters
from ..sources.adapters import SQL as VIEWS

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def bars_sql(intervals: dict[str, int], keys: str) -> str:
    """The body of a bars CTE, to be used after trades."""
    values = ", ".join(f"('{k}', {v})" for k, v in intervals.items())
    names = keys.replace(" ", "")
    return f"""each AS (SELECT {keys}, trade_id, ts, price, quantity, side, iv.i AS "interval", iv.s AS seconds, epoch_us(ts) AS us, epoch_us(ts) - epoch_us(ts) % (CAST(iv.s AS BIGINT) * 1000000) AS bar_us FROM trades, (VALUES {values}) AS iv(i, s)),
ticked AS (SELECT *, CAST(price <> lag(price) OVER (PARTITION BY {names}, "interval", bar_us ORDER BY us, trade_id) AS INT) AS tick FROM each),
grouped AS (SELECT {keys}, "interval", seconds, bar_us, arg_min(price, {{'a': us, 'b': trade_id}}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {{'a': us, 'b': trade_id}}) AS close, sum(quantity) AS volume,
 sum(CASE WHEN lower(side) = 'buy' THEN quantity ELSE 0 END) AS buy_volume, sum(CASE WHEN lower(side) = 'buy' THEN 0 ELSE quantity END) AS sell_volume, sum(price * quantity) AS notional, CAST(coalesce(sum(tick), 0) AS BIGINT) AS tick_count, count(*) AS trade_count, min(us) AS first_us, max(us) AS last_us
 FROM ticked GROUP BY {keys}, "interval", seconds, bar_us),
bars AS (SELECT {keys}, "interval", make_timestamp(bar_us) AS bar_start, open, high, low, close, volume, buy_volume, sell_volume, notional / volume AS vwap, tick_count, round(tick_count / trade_count, 3) AS tick_to_trade, trade_count, round(trade_count / seconds, 3) AS arrival_rate, first_us, last_us,
 CASE WHEN trade_count = 1 THEN 0.3 ELSE round(0.7 * least(1.0, ((last_us - first_us) / 1000000) / seconds) + 0.3 * least(1.0, trade_count / 10), 3) END AS completeness FROM grouped)"""


BAR_COLUMNS = "open, high, low, close, volume, buy_volume, sell_volume, round(round_even(vwap, 8), 6) AS vwap, tick_count, tick_to_trade, trade_count, arrival_rate, first_us, last_us, completeness"


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that the order of additions doesn't show; -0.0 becomes 0.0."""
    return df.select(*[(F.round(F.col(n), digits) + 0.0).alias(n) if t == "double" and n not in skip else F.col(n) for n, t in df.dtypes])


@query(f"WITH {VIEWS['trades']}, {bars_sql({'1h': 3600}, 'venue, symbol')} SELECT venue, symbol, \"interval\", bar_start, {BAR_COLUMNS} FROM bars")
def agg_bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(adapters.trades(spark, sf_dir), ["1h"], ["venue", "symbol"]).withColumn("vwap", F.round("vwap", 6))


@query(f"WITH {VIEWS['trades']}, {bars_sql({'1s': 1, '5s': 5, '1m': 60, '5m': 300, '15m': 900, '1h': 3600, '1d': 86400}, 'venue, symbol')} SELECT venue, symbol, \"interval\", bar_start, {BAR_COLUMNS} FROM bars")
def agg_bars_all_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(adapters.trades(spark, sf_dir), ["1s", "5s", "1m", "5m", "15m", "1h", "1d"], ["venue", "symbol"]).withColumn("vwap", F.round("vwap", 6))


@query(f"WITH {VIEWS['trades']}, a AS (SELECT *, CASE WHEN trade_id % 7 = 0 THEN epoch_us(ts) + 3700000000 ELSE epoch_us(ts) END AS arr, epoch_us(ts) - epoch_us(ts) % 3600000000 + 3600000000 + 5000000 AS lim FROM trades) SELECT venue, symbol, CAST(sum(CAST(arr > lim AS INT)) AS BIGINT) AS late_trades, count(*) AS trades FROM a GROUP BY 1, 2")
def agg_late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapters.trades(spark, sf_dir)
    late = t.withColumn("arrival_ts", F.when(F.col("trade_id") % 7 == 0, F.col("ts") + F.expr("INTERVAL 3700 SECONDS")).otherwise(F.col("ts")))
    return late_trades(late, "1h", ["venue", "symbol"])


def _one_bars(spark: SparkSession, sf_dir: str, interval: str) -> DataFrame:
    return bars(adapters.trades(spark, sf_dir), [interval], ["symbol"])


def _quoted(b: DataFrame) -> DataFrame:
    return b.withColumns({"bid": F.col("low"), "ask": F.col("high"), "bid_volume": F.col("buy_volume"), "ask_volume": F.col("sell_volume")})


_R = "(close / nullif(lag(close) OVER w, 0) - 1)"
_FEATURES = (
    [f"CASE WHEN lag(close, {k}) OVER w <> 0 THEN (close / lag(close, {k}) OVER w - 1) * 100 ELSE 0 END AS return_{k}" for k in (1, 5, 15, 60)]
    + [f"CASE WHEN bars > {k} THEN coalesce(stddev_pop(r) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 0) * sqrt(525600) ELSE 0 END AS volatility_{k}" for k in (5, 15, 60)]
    + [f"CASE WHEN bars > {k} THEN coalesce(stddev_pop(CASE WHEN r < 0 THEN r END) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 0) * sqrt(525600) ELSE 0 END AS down_{k}" for k in (15, 60)]
)
_M = lambda p: f"avg(r ** {p}) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS m{p}"


@query(
    f"""WITH {VIEWS['trades']}, {bars_sql({'1m': 60}, 'symbol')},
b AS (SELECT symbol, bar_start, high, low, close, volume, buy_volume, sell_volume, row_number() OVER w AS bars, CASE WHEN lag(close) OVER w > 0 THEN {_R} END AS r FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_start)),
f AS (SELECT *, {', '.join(_FEATURES)}, {_M(1)}, {_M(2)}, {_M(3)}, stddev_pop(r) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS sd, kurtosis_pop(r) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS ku,
 sum(r * volume) OVER (w ROWS BETWEEN 18 PRECEDING AND CURRENT ROW) AS rv, sum(CASE WHEN r IS NOT NULL THEN volume END) OVER (w ROWS BETWEEN 18 PRECEDING AND CURRENT ROW) AS v19,
 avg(volume) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS vnew, avg(volume) OVER (w ROWS BETWEEN 19 PRECEDING AND 10 PRECEDING) AS vold,
 sum((high + low + close) / 3 * volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) / sum(volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS vw,
 avg(volume) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS v5, avg(volume) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS v60 FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bar_start))
SELECT symbol, bar_start, bars, {', '.join(f'round(return_{k}, 7) + 0.0 AS return_{k}' for k in (1, 5, 15, 60))}, {', '.join(f'round(volatility_{k}, 7) + 0.0 AS volatility_{k}' for k in (5, 15, 60))},
 {', '.join(f'round(CASE WHEN abs(volatility_{k}) > 1e-8 THEN return_{k} / volatility_{k} ELSE 0 END, 7) + 0.0 AS sharpe_{k}' for k in (5, 15, 60))}, {', '.join(f'round(CASE WHEN abs(down_{k}) > 1e-8 THEN return_{k} / down_{k} ELSE 0 END, 7) + 0.0 AS sortino_{k}' for k in (15, 60))},
 round(CASE WHEN bars > 60 AND sd > 0 THEN (m3 - 3 * m1 * m2 + 2 * m1 ** 3) / sd ** 3 ELSE 0 END, 7) + 0.0 AS skewness, round(CASE WHEN bars > 60 AND sd > 0 THEN ku ELSE 0 END, 7) + 0.0 AS kurtosis,
 round(CASE WHEN bars >= 21 THEN rv / v19 * 100 ELSE 0 END, 7) + 0.0 AS volume_momentum, round(CASE WHEN bars >= 20 AND vold > 0 THEN (vnew - vold) / vold * 100 ELSE 0 END, 7) + 0.0 AS volume_acceleration,
 round(CASE WHEN bars >= 20 AND vw > 0 THEN (close - vw) / vw * 100 ELSE 0 END, 7) + 0.0 AS vwap_deviation, round(CASE WHEN (low + high) / 2 > 0 THEN (high - low) / ((low + high) / 2) * 100 ELSE 0 END, 7) + 0.0 AS spread,
 round(CASE WHEN buy_volume + sell_volume > 0 THEN (buy_volume - sell_volume) / (buy_volume + sell_volume) ELSE 0 END, 7) + 0.0 AS imbalance, round(CASE WHEN bars >= 10 AND v60 > 0 THEN v5 / v60 ELSE 1 END, 7) + 0.0 AS volume_profile,
 round(least(bars / 60, 1.0), 7) + 0.0 AS confidence, epoch_ms(TIMESTAMP '2024-02-01') - epoch_ms(bar_start) AS data_age_ms FROM f WHERE bars >= 5"""
)
def win_foundation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(foundation(_quoted(_one_bars(spark, sf_dir, "1m")), as_of=F.lit("2024-02-01").cast("timestamp")), 7)


@query(
    f"""WITH {VIEWS['trades']}, {bars_sql({'1h': 3600}, 'symbol')},
b AS (SELECT symbol, bar_start, close, volume, row_number() OVER w AS bars, {', '.join(f"CASE WHEN lag(close, {k}) OVER w > 0 THEN (close / lag(close, {k}) OVER w - 1) * 100 ELSE 0 END AS momentum_{n}" for n, k in (('1h', 1), ('4h', 4), ('1d', 24), ('1w', 168)))},
 lag(close, 4) OVER w AS c4, lag(close, 8) OVER w AS c8, lag(close, 9) OVER w AS c9 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_start)),
f AS (SELECT *, regr_slope(close, bars) OVER h / avg(close) OVER h * 100 AS slope_pct, regr_slope(close, bars) OVER s > 1e-9 * avg(close) OVER s AS pu, regr_slope(volume, bars) OVER s > 1e-9 * avg(volume) OVER s AS vu, avg(volume) OVER (PARTITION BY symbol ORDER BY bar_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / avg(volume) OVER (PARTITION BY symbol ORDER BY bar_start ROWS BETWEEN 19 PRECEDING AND 10 PRECEDING) AS vr,
 greatest((momentum_1h > 0)::INT + (momentum_4h > 0)::INT + (momentum_1d > 0)::INT + (momentum_1w > 0)::INT, (momentum_1h < 0)::INT + (momentum_4h < 0)::INT + (momentum_1d < 0)::INT + (momentum_1w < 0)::INT) / 4 AS trend_confidence
 FROM b WINDOW h AS (PARTITION BY symbol ORDER BY bar_start ROWS BETWEEN 167 PRECEDING AND CURRENT ROW), s AS (PARTITION BY symbol ORDER BY bar_start ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
g AS (SELECT *, trend_confidence * least((abs(momentum_1h) + abs(momentum_4h) + abs(momentum_1d) + abs(momentum_1w)) / 4 / 10, 1.0) AS strength, CASE WHEN bars < 20 OR c9 <= 0 THEN 0.5 WHEN abs((close / c9 - 1) * 100) > 1 AND vr > 1.2 THEN 0.8 WHEN abs((close / c9 - 1) * 100) > 1 AND vr > 1.0 THEN 0.6 WHEN abs((close / c9 - 1) * 100) > 1 THEN 0.4 ELSE 0.5 END AS volume_confirmation FROM f)
SELECT symbol, bar_start, bars, round(momentum_1h, 7) + 0.0 AS momentum_1h, round(momentum_4h, 7) + 0.0 AS momentum_4h, round(momentum_1d, 7) + 0.0 AS momentum_1d, round(momentum_1w, 7) + 0.0 AS momentum_1w, round(slope_pct, 7) + 0.0 AS slope_pct, round(trend_confidence, 7) AS trend_confidence,
 CASE WHEN slope_pct > 0.1 THEN 'up' WHEN slope_pct < -0.1 THEN 'down' ELSE 'sideways' END AS trend, round(least(abs(slope_pct) / 5, 1.0), 7) AS trend_strength, round(strength, 7) AS strength, round(CASE WHEN c4 > 0 AND c8 > 0 THEN ((close / c4 - 1) - (c4 / c8 - 1)) * 100 ELSE 0 END, 7) + 0.0 AS acceleration, CAST(volume_confirmation AS DOUBLE) AS volume_confirmation,
 CAST(CASE WHEN bars < 20 THEN 0.0 WHEN pu AND NOT vu THEN -0.7 WHEN NOT pu AND vu THEN 0.7 ELSE 0.0 END AS DOUBLE) AS price_volume_divergence, round(CASE WHEN abs(momentum_1d) < 0.1 THEN 0 ELSE greatest(-1.0, least(1.0, (momentum_1h - momentum_1d) / abs(momentum_1d))) END, 7) + 0.0 AS horizon_divergence,
 round(least(bars / 168, 1.0) * (trend_confidence + strength + volume_confirmation) / 3, 7) AS confidence FROM g WHERE bars >= 168"""
)
def win_momentum_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(momentum(_one_bars(spark, sf_dir, "1h").select("symbol", "bar_start", "close", "volume")), 7)


@query(
    f"""WITH {VIEWS['trades']}, t AS (SELECT h.ts AS tick, s.series FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-30 00:00:00', INTERVAL 1 HOUR)) AS ts) h, (SELECT DISTINCT event_type AS series FROM events) s)
SELECT t.series, t.tick, e.ts AS matched_ts, e.value AS value_asof FROM t ASOF LEFT JOIN (SELECT event_type AS series, ts, arg_max(value, value) AS value FROM events GROUP BY 1, 2) e ON t.series = e.series AND t.tick >= e.ts"""
)
def join_asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-07: the last observation of each series at every hour."""
    obs = adapters.table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), F.col("ts").alias("tick"), "value")
    hours = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"), F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR"))).alias("tick"))
    ticks = hours.withColumn("series", F.explode(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])))
    ticks = ticks.join(obs.select("series").distinct(), "series", "left_semi")
    return asof(ticks, obs, "tick", ["series"], ["value"])


@query(
    """WITH l AS (SELECT event_id, event_type, ts, ts - INTERVAL 24 HOUR AS t0 FROM events), r AS (SELECT event_type, ts, max(value) AS value FROM events GROUP BY 1, 2),
b AS (SELECT l.*, r.ts AS bt, r.value AS bv FROM l ASOF LEFT JOIN r ON l.event_type = r.event_type AND l.t0 >= r.ts), f AS (SELECT b.*, r.ts AS ft, r.value AS fv FROM b ASOF LEFT JOIN r ON b.event_type = r.event_type AND b.t0 <= r.ts),
g AS (SELECT *, epoch_us(t0) - epoch_us(bt) AS db, epoch_us(ft) - epoch_us(t0) AS df FROM f)
SELECT event_id, event_type, CASE WHEN df IS NULL OR db <= df THEN CASE WHEN db <= 17280000000 THEN bv END ELSE CASE WHEN df <= 17280000000 THEN fv END END AS value_nearest FROM g"""
)
def join_nearest_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-08: the value nearest to 24 hours ago, within a fifth of that."""
    e = adapters.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    back = F.col("ts") - F.expr("INTERVAL 24 HOURS")
    return nearest(e.drop("value"), e, "ts", ["event_type"], "value", back, F.lit(24 * 3600 * 1000000 // 5)).select("event_id", "event_type", "value_nearest")


@query(
    f"""WITH {VIEWS['trades']}, {bars_sql({'5m': 300, '15m': 900, '1h': 3600}, 'symbol')}, e AS (SELECT symbol, "interval", bar_start + CASE "interval" WHEN '5m' THEN INTERVAL 5 MINUTE WHEN '15m' THEN INTERVAL 15 MINUTE ELSE INTERVAL 1 HOUR END AS bar_end, close FROM bars),
m AS (SELECT * FROM e WHERE "interval" = '5m'), q AS (SELECT * FROM e WHERE "interval" = '15m'), h AS (SELECT * FROM e WHERE "interval" = '1h')
SELECT m.symbol, m.bar_end, m.close, q.close AS close_15m, h.close AS close_1h FROM m ASOF LEFT JOIN q ON m.symbol = q.symbol AND m.bar_end >= q.bar_end ASOF LEFT JOIN h ON m.symbol = h.symbol AND m.bar_end >= h.bar_end"""
)
def join_multi_timeframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-09: each 5-minute bar with the newest closed 15-minute and 1-hour bars, without look-ahead."""
    b = bars(adapters.trades(spark, sf_dir), ["5m", "15m", "1h"], ["symbol"])
    end = F.col("bar_start") + F.when(F.col("interval") == "5m", F.expr("INTERVAL 5 MINUTES")).when(F.col("interval") == "15m", F.expr("INTERVAL 15 MINUTES")).otherwise(F.expr("INTERVAL 60 MINUTES"))
    b = b.select("symbol", "interval", end.alias("bar_end"), "close")
    of = lambda i: b.where(F.col("interval") == i).drop("interval")
    out = asof(of("5m"), of("15m"), "bar_end", ["symbol"], ["close"]).withColumnRenamed("close_asof", "close_15m").drop("matched_ts")
    return asof(out, of("1h"), "bar_end", ["symbol"], ["close"]).withColumnRenamed("close_asof", "close_1h").drop("matched_ts")
