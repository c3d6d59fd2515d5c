"""Rolling features of bars (WIN-01 to WIN-12) and momentum (WIN-13 to WIN-20).

Each feature is a Column over one window per block of a key, so that all of them take one shuffle and one sort. A feature whose inputs don't
reach is 0. n returns need n + 1 bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blocks

YEAR_MINUTES = 525600


def finite(x: Column, default: float = 0.0) -> Column:
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), default).otherwise(x)


def foundation(bars: DataFrame, key: str = "symbol", as_of: Column | None = None) -> DataFrame:
    """Returns, volatility, ratios, moments and flow features per bar; bars with fewer than 5 bars so far give no row.

    bars: key, bar_start, high, low, close, volume, bid, ask, bid_volume, ask_volume. Rows without a key give none. Frames reach 61
    bars back, so that long series are cut into blocks.
    """
    w = Window.partitionBy(key, "_block").orderBy("_n")
    last = lambda n, skip=0: w.rowsBetween(-(n - 1) - skip, -skip)
    prev = F.lag("close").over(w)
    b = blocks(bars.dropna(subset=[key]), [key], "bar_start", ["bar_start"], 61, 2048).withColumn("bars", F.col("_n").cast("int")).withColumn("r", F.when(prev > 0, F.col("close") / prev - 1))
    r, n, close, volume = F.col("r"), F.col("bars"), F.col("close"), F.col("volume")
    typical, traded = (F.col("high") + F.col("low") + close) / 3, F.when(volume > 0, volume)
    # Every window function is a column of its own first, so that none is planned twice.
    base = {f"past_{k}": F.lag("close", k).over(w) for k in (1, 5, 15, 60)} | {f"sd_{k}": F.stddev_pop("r").over(last(k)) for k in (5, 15, 60)} | {f"down_{k}": F.stddev_pop(F.when(r < 0, r)).over(last(k)) for k in (15, 60)}
    base |= {"skew": F.skewness("r").over(last(60)), "kurt": F.kurtosis("r").over(last(60)), "rv": F.sum(r * volume).over(last(19)), "v19": F.sum(F.when(r.isNotNull(), volume)).over(last(19)), "new": F.avg("volume").over(last(10)), "old": F.avg("volume").over(last(10, 10))}
    base |= {"pv": F.sum(typical * traded).over(last(20)), "v20": F.sum(traded).over(last(20)), "v5": F.avg("volume").over(last(5)), "v60": F.avg("volume").over(last(60))}
    b = b.withColumns({f"_{name}": c for name, c in base.items()})
    of = lambda name: F.col(f"_{name}")
    year = float(YEAR_MINUTES) ** 0.5
    ratio = lambda x, by: F.when(F.abs(by) > 1e-8, x / by).otherwise(0.0)
    b = b.where("_own and bars >= 5").withColumns({f"return_{k}": F.when(of(f"past_{k}") != 0, (close / of(f"past_{k}") - 1) * 100).otherwise(0.0) for k in (1, 5, 15, 60)} | {f"volatility_{k}": F.when(n > k, finite(of(f"sd_{k}") * year)).otherwise(0.0) for k in (5, 15, 60)} | {"_vwap": of("pv") / of("v20")})
    mid, both = (F.col("bid") + F.col("ask")) / 2, F.col("bid_volume") + F.col("ask_volume")
    out = {name: F.col(name) for name in (*(f"return_{k}" for k in (1, 5, 15, 60)), *(f"volatility_{k}" for k in (5, 15, 60)))}
    out |= {f"sharpe_{k}": ratio(F.col(f"return_{k}"), F.col(f"volatility_{k}")) for k in (5, 15, 60)}
    out |= {f"sortino_{k}": F.when(n > k, ratio(F.col(f"return_{k}"), finite(of(f"down_{k}") * year))).otherwise(0.0) for k in (15, 60)}
    out |= {
        "skewness": F.when((n > 60) & (of("sd_60") > 0), finite(of("skew"))).otherwise(0.0),
        "kurtosis": F.when((n > 60) & (of("sd_60") > 0), finite(of("kurt"))).otherwise(0.0),
        "volume_momentum": F.when(n >= 21, finite(of("rv") / F.when(of("v19") != 0, of("v19")) * 100)).otherwise(0.0),
        "volume_acceleration": F.when((n >= 20) & (of("old") > 0), (of("new") - of("old")) / of("old") * 100).otherwise(0.0),
        "vwap_deviation": F.when((n >= 20) & (of("vwap") > 0), (close - of("vwap")) / of("vwap") * 100).otherwise(0.0),
        "spread": F.when(mid > 0, (F.col("ask") - F.col("bid")) / mid * 100).otherwise(0.0),
        "imbalance": F.when(both > 0, (F.col("bid_volume") - F.col("ask_volume")) / both).otherwise(0.0),
        "volume_profile": F.when((n >= 10) & (of("v60") > 0), of("v5") / of("v60")).otherwise(1.0),
        "confidence": F.least(n / 60, F.lit(1.0)),
    }
    cols = [c.alias(name) for name, c in out.items()]
    if as_of is not None:
        cols.append((F.unix_millis(as_of.cast("timestamp")) - F.unix_millis(F.col("bar_start").cast("timestamp"))).alias("data_age_ms"))
    return b.select(key, "bar_start", "bars", *cols)


def momentum(bars: DataFrame, key: str = "symbol", history: int = 168) -> DataFrame:
    """Horizon momentum, trend, strength, acceleration, volume confirmation and divergences of hourly bars; rows from `history` bars
    on. bars: key, bar_start, close, volume. A slope within 1e-9 of the mean is flat, so that the order of additions doesn't show."""
    w = Window.partitionBy(key, "_block").orderBy("_n")
    last = lambda n, skip=0: w.rowsBetween(-(n - 1) - skip, -skip)
    b = blocks(bars, [key], "bar_start", ["bar_start"], max(history, 168) + 1, 2048).withColumn("bars", F.col("_n").cast("int"))
    close, n = F.col("close"), F.col("bars")
    past = lambda k: F.lag("close", k).over(w)
    horizon = lambda k: F.when(past(k) > 0, (close / past(k) - 1) * 100).otherwise(0.0)
    b = b.withColumns({f"momentum_{name}": horizon(k) for name, k in (("1h", 1), ("4h", 4), ("1d", 24), ("1w", 168))})
    hs = F.array("momentum_1h", "momentum_4h", "momentum_1d", "momentum_1w")
    up, down = F.size(F.filter(hs, lambda x: x > 0)), F.size(F.filter(hs, lambda x: x < 0))
    slope = F.regr_slope("close", "bars").over(last(history))
    slope_pct = finite(slope / F.avg("close").over(last(history)) * 100)
    b = b.withColumn("slope_pct", slope_pct).withColumn("trend_confidence", F.greatest(up, down) / 4)
    step = lambda lag_: F.when(past(lag_ + 4) > 0, (F.lag("close", lag_).over(w) if lag_ else close) / past(lag_ + 4) - 1)
    change9 = F.when(past(9) > 0, (close / past(9) - 1) * 100)
    vol_ratio = F.avg("volume").over(last(10)) / F.avg("volume").over(last(10, 10))
    confirm = F.when(n < 20, 0.5).when((F.abs(change9) > 1) & (vol_ratio > 1.2), 0.8).when((F.abs(change9) > 1) & (vol_ratio > 1.0), 0.6).when(F.abs(change9) > 1, 0.4).otherwise(0.5)
    rises = lambda c: F.regr_slope(c, "bars").over(last(20)) > 1e-9 * F.avg(c).over(last(20))
    price_up, volume_up = rises("close"), rises("volume")
    mean_abs = F.aggregate(hs, F.lit(0.0), lambda s, x: s + F.abs(x)) / 4
    long = F.col("momentum_1d")
    b = b.withColumns({
        "trend": F.when(F.col("slope_pct") > 0.1, "up").when(F.col("slope_pct") < -0.1, "down").otherwise("sideways"),
        "trend_strength": F.least(F.abs("slope_pct") / 5, F.lit(1.0)),
        "strength": F.col("trend_confidence") * F.least(mean_abs / 10, F.lit(1.0)),
        "acceleration": F.when(n >= 9, finite((step(0) - step(4)) * 100)).otherwise(0.0),
        "volume_confirmation": confirm,
        "price_volume_divergence": F.when(n < 20, 0.0).when(price_up & ~volume_up, -0.7).when(~price_up & volume_up, 0.7).otherwise(0.0),
        "horizon_divergence": F.when(F.abs(long) < 0.1, 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("momentum_1h") - long) / F.abs(long)))),
    })
    confidence = F.least(n / history, F.lit(1.0)) * (F.col("trend_confidence") + F.col("strength") + F.col("volume_confirmation")) / 3
    return b.where((n >= history) & F.col("_own")).withColumn("confidence", confidence).drop("_n", "_block", "_own", *[c for c in bars.columns if c not in (key, "bar_start")])


def short_momentum(bars: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, bar_start, momentum_5m, momentum_15m) of five-minute bars, 0 where the past doesn't reach (WIN-13)."""
    w = Window.partitionBy(key, "_block").orderBy("_n")
    past = lambda k: F.lag("close", k).over(w)
    b = blocks(bars, [key], "bar_start", ["bar_start"], 3)
    b = b.withColumns({f"momentum_{5 * k}m": F.when(past(k) > 0, (F.col("close") / past(k) - 1) * 100).otherwise(0.0) for k in (1, 3)})
    return b.where("_own").select(key, "bar_start", "momentum_5m", "momentum_15m")
