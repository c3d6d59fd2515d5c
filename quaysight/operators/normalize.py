"""Projections that bring landed values to one form (PRJ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lower limits of the epoch units (seconds below the first), by who reads them; a limit of None gives null above.
BANDS = {
    "collector": ((10**12, "s"), (10**15, "ms"), (10**18, "us"), (None, "ns")),
    "validator": ((10**10, "s"), (10**13, "ms"), (10**16, "us"), (10**19, "ns")),
    "reconciler": ((10**11, "s"), (10**14, "ms"), (10**17, "us"), (None, "ns")),
}
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def epoch_us(x: Column, bands: str = "collector") -> Column:
    """A bigint epoch in any unit as microseconds (PRJ-04 to PRJ-06)."""
    out = None
    for limit, unit in BANDS[bands]:
        up = {"s": 1000000, "ms": 1000, "us": 1}
        scaled = (x * F.lit(up[unit]).cast("bigint")) if unit in up else F.call_function("div", x, F.lit(1000).cast("bigint"))
        if limit is None:
            out = out.otherwise(scaled)
        elif limit < 2**63:
            out = F.when(x < limit, scaled) if out is None else out.when(x < limit, scaled)
        else:
            out = out.otherwise(scaled)
    return out


def text_us(text: Column) -> Column:
    """An ISO time as microseconds; null if no format fits. A time without zone is UTC."""
    return F.unix_micros(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in FORMATS]))


def decimal_or_null(x: Column, kind: str = "decimal(38,18)") -> Column:
    return x.try_cast(kind)


def levels(raw: Column) -> Column:
    """Book levels with a price and quantity above 0 (PRJ-03)."""
    return F.filter(raw, lambda x: (x["price"] > 0) & (x["quantity"] > 0))


def level_pairs(raw: Column) -> Column:
    """Book levels written as [price, quantity], texts or numbers, as structs with both above 0 (PRJ-03); what isn't a number goes."""
    number = lambda x: x.try_cast("double")
    pairs = F.transform(raw, lambda x: F.struct(number(F.get(x, F.lit(0))).alias("price"), number(F.get(x, F.lit(1))).alias("quantity")))
    return levels(pairs)


def level_maps(raw: Column) -> Column:
    """As level_pairs, of an array of maps with price and quantity."""
    number = lambda x, k: F.try_element_at(x, F.lit(k)).try_cast("double").alias(k)
    return levels(F.transform(raw, lambda x: F.struct(number(x, "price"), number(x, "quantity"))))


def canonical_symbol(venue: Column, symbol: Column) -> tuple[Column, Column]:
    """(BASE-QUOTE, confidence) inferred from a venue's symbol; null without a match (PRJ-07)."""
    s = F.upper(F.trim(symbol))
    s = F.when(F.lower(venue) == "kraken", F.regexp_replace(s, "^XBT", "BTC")).otherwise(s)
    split = r"^([A-Z0-9]{2,10})[-_/]([A-Z0-9]{2,10})$"
    tail = r"^([A-Z0-9]{2,10}?)(USDT|USDC|BUSD|USD|EUR|GBP|BTC|ETH)$"
    name = F.when(s.rlike(split), F.concat_ws("-", F.regexp_extract(s, split, 1), F.regexp_extract(s, split, 2))).when(s.rlike(tail), F.concat_ws("-", F.regexp_extract(s, tail, 1), F.regexp_extract(s, tail, 2)))
    return name, F.when(name.isNull(), None).when(symbol.rlike("[-_]"), 0.8).otherwise(0.7)


def base_quote(canonical: Column) -> Column:
    """struct(base, quote); the quote is UNKNOWN where there is none (PRJ-08)."""
    p = F.split(canonical, "-")
    return F.when(F.size(p) == 2, F.struct(p[0].alias("base"), p[1].alias("quote"))).otherwise(F.struct(canonical.alias("base"), F.lit("UNKNOWN").alias("quote")))


STABLE = ("USDT", "USDC", "BUSD", "DAI", "TUSD")


def plain_symbol(symbol: Column) -> Column:
    """Without separators, XBT as BTC, and a dollar quote as USDT unless the base is a stablecoin (PRJ-09)."""
    s = F.regexp_replace(F.regexp_replace(F.upper(symbol), "[-_/]", ""), "XBT", "BTC")
    return F.when(s.endswith("USD") & ~F.regexp_replace(s, "USD$", "").isin(*STABLE), F.concat(s, F.lit("T"))).otherwise(s)


def venue_symbol(venue: Column, canonical: Column) -> Column:
    """BTC-USDT as the venue writes it (PRJ-10)."""
    joined = F.regexp_replace(canonical, "-", "")
    return F.when(F.lower(venue) == "okx", canonical).when(F.lower(venue) == "kraken", F.regexp_replace(joined, "^BTC", "XBT")).otherwise(joined)


def symbol_registry(trades: DataFrame, as_of: Column) -> DataFrame:
    """Per symbol its venues, first and last sight and staleness from 0 (5 s) to 1 (60 s) (PRJ-11)."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_seen").cast("timestamp"))) / 1000000
    out = trades.groupBy("symbol").agg(F.array_sort(F.collect_set("venue")).alias("venues"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return out.withColumn("staleness", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (age - 5) / 55)))


def market_structure(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Alt dominance and volume to market cap ratios (PRJ-12). Columns: btc_dominance, eth_dominance, volume, market_cap; with as_of also
    age_s, the seconds since ts."""
    if as_of is not None:
        df = df.withColumn("age_s", (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1000000)
    return df.withColumn("alt_dominance", 100 - F.col("btc_dominance") - F.col("eth_dominance")).withColumn("volume_ratio", F.when(F.col("market_cap") > 0, F.col("volume") / F.col("market_cap")).otherwise(0.0))


def days_to_expiry(expiry: Column, as_of: Column) -> Column:
    return (F.unix_micros(expiry.cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))) / 86400e6


def tenor(days: Column) -> Column:
    return F.when(days <= 7, "weekly").when(days <= 30, "monthly").when(days <= 90, "quarterly").when(days <= 180, "semi_annual").when(days <= 365, "annual").otherwise("leap")


def moneyness(strike: Column, underlying: Column, kind: Column) -> Column:
    """ATM, ITM, OTM, DEEP_ITM or DEEP_OTM (PRJ-15)."""
    pct = F.abs(strike - underlying) / underlying * 100
    inside = F.when(kind == "call", strike < underlying).otherwise(strike > underlying)
    side = F.when(inside, "ITM").otherwise("OTM")
    return F.when(underlying.isNull() | (underlying == 0), "ATM").when(pct <= 5, "ATM").when(pct <= 15, side).otherwise(F.concat(F.lit("DEEP_"), side))


#: The type that a keyword gives an event, the first that fits, and priorities.
EVENT_WORDS = (("proposal", "governance_proposal"), ("governance", "governance_proposal"), ("release", "release"), ("upgrade", "upgrade"), ("unlock", "token_unlock"), ("listing", "listing"), ("hack", "security"), ("exploit", "security"))
EVENT_PRIORITY = {"security": 1, "upgrade": 2, "governance_proposal": 2, "token_unlock": 3, "listing": 3, "release": 4}


def event_type(raw: Column, source: Column) -> Column:
    low = F.lower(raw)
    out = F.when(F.lower(source) == "snapshot", "governance_proposal").when(F.lower(source) == "github", "release")
    for word, name in EVENT_WORDS:
        out = out.when(low.contains(word), name)
    return out.otherwise("other")


def event_priority(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in EVENT_PRIORITY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit(5))


def flow_class(explicit: Column, is_dex: Column, is_bridge: Column, is_exchange: Column, is_lst: Column) -> Column:
    """Transaction class by precedence (PRJ-18)."""
    return F.coalesce(explicit, F.when(is_dex, "dex_swap").when(is_bridge, "bridge").when(is_exchange, "cex_hot_wallet").when(is_lst, "lst").otherwise("erc20_transfer"))


def guarded(x: Column, default: float = 0.0, low: float | None = None, high: float | None = None) -> Column:
    """x, or the default where it is null, NaN or infinite; then held between the limits (PRJ-28)."""
    out = F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(default)).otherwise(x)
    out = out if low is None else F.greatest(out, F.lit(low))
    return out if high is None else F.least(out, F.lit(high))


def incident_class(topic: Column, payload_class: Column) -> Column:
    out = None
    for word, name in (("anomal", "Anomaly"), ("leak", "Leakage"), ("fresh", "Freshness"), ("schema", "SchemaViolation"), ("reconcil", "Reconciliation")):
        hit = F.lower(topic).contains(word)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.coalesce(out, payload_class, F.lit("Anomaly"))
