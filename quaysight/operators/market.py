"""Books, option chains and on-chain flows (AGG-08 to AGG-27, JOIN-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import kept as written
from .blocks import summed

BPS = (10, 50, 100, 500, 1000)


def _sum(levels: Column, what: str = "quantity") -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda s, x: s + x[what])


def book_snapshot(books: DataFrame, most: int = 20) -> DataFrame:
    """The best `most` levels of each side, volumes, imbalance (999 without asks), mid and liquidity within basis points of the mid;
    books with an empty side give no row. No level is exploded. books: key columns, bids, asks."""
    up = lambda a, b: F.when(a["price"] < b["price"], -1).when(a["price"] > b["price"], 1).when(a["quantity"] < b["quantity"], -1).when(a["quantity"] > b["quantity"], 1).otherwise(0)
    down = lambda a, b: F.when(a["price"] > b["price"], -1).when(a["price"] < b["price"], 1).when(a["quantity"] > b["quantity"], -1).when(a["quantity"] < b["quantity"], 1).otherwise(0)
    good = lambda x: (x["price"] > 0) & (x["quantity"] > 0)
    b = books.withColumn("bids", F.slice(F.array_sort(F.filter("bids", good), down), 1, most)).withColumn("asks", F.slice(F.array_sort(F.filter("asks", good), up), 1, most))
    b = b.where((F.size("bids") > 0) & (F.size("asks") > 0))
    b = b.withColumns({"best_bid": F.col("bids")[0]["price"], "best_ask": F.col("asks")[0]["price"], "bid_volume": _sum(F.col("bids")), "ask_volume": _sum(F.col("asks"))})
    b = b.withColumn("mid", (F.col("best_bid") + F.col("best_ask")) / 2).withColumn("imbalance", F.when(F.col("ask_volume") > 0, F.col("bid_volume") / F.col("ask_volume")).otherwise(999.0))
    cols = {"bid_levels": F.size("bids"), "ask_levels": F.size("asks")}
    for x in BPS:
        cols[f"bid_{x}bps"], cols[f"ask_{x}bps"] = _sum(_near("bids", x, -1)), _sum(_near("asks", x, 1))
    return b.withColumns(cols)


def _near(side: str, bps: int, sign: int) -> Column:
    """Levels within so many basis points of the mid."""
    limit = F.col("mid") * (1 + sign * bps / 10000)
    return F.filter(side, lambda v: v["price"] <= limit) if sign > 0 else F.filter(side, lambda v: v["price"] >= limit)


def book_order_violations(books: DataFrame, depth: int = 10) -> DataFrame:
    """Whether the first levels of each side are out of order as they stand (VAL-29), and whether the book is crossed: its best bid above its
    best ask (VAL-28)."""
    wrong = lambda side, bad: F.exists(F.zip_with(F.slice(side, 1, depth - 1), F.slice(side, 2, depth - 1), lambda a, b: F.coalesce(bad(a["price"], b["price"]), F.lit(False))), lambda x: x)
    crossed = F.array_max(F.transform("bids", lambda x: x["price"])) > F.array_min(F.transform("asks", lambda x: x["price"]))
    return books.withColumns({"bids_unordered": wrong("bids", lambda a, b: a < b), "asks_unordered": wrong("asks", lambda a, b: a > b), "crossed": F.coalesce(crossed, F.lit(False))})


def chain(options: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The newest quote of each contract (AGG-10). options: symbol, expiry, strike, option_type, ts, ... and the order columns."""
    newest = F.max_by(F.struct(*options.columns), F.struct(*(order or ["ts"])))
    return options.groupBy("symbol", "expiry", "strike", "option_type").agg(newest.alias("_r")).select("_r.*")


def ladders(contracts: DataFrame) -> DataFrame:
    """Per symbol and expiry the strikes, the strike nearest to the underlying and the newest underlying (AGG-11)."""
    distance = F.struct(F.abs(F.col("strike") - F.col("underlying")), "strike")
    return contracts.groupBy("symbol", "expiry").agg(
        F.count_distinct("strike").alias("n_strikes"), F.count("*").alias("n_contracts"), F.min("strike").alias("min_strike"), F.max("strike").alias("max_strike"), F.min_by("strike", distance).alias("atm_strike"), F.max("underlying").alias("underlying"),
    )


def chain_stats(contracts: DataFrame, tenor: Column) -> DataFrame:
    """Per symbol expiries, contracts and contracts by tenor (AGG-12)."""
    by = contracts.withColumn("tenor", tenor).groupBy("symbol", "tenor").agg(F.count("*").alias("n"), F.count_distinct("expiry").alias("e"), F.min("expiry").alias("lo"), F.max("expiry").alias("hi"))
    histogram = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "tenor", "n"))), ",")
    missing = F.array_except(F.array(*[F.lit(x) for x in ("weekly", "monthly", "quarterly")]), F.collect_set("tenor"))
    return by.groupBy("symbol").agg(F.sum("n").alias("n_contracts"), F.sum("e").alias("n_expiries"), F.min("lo").alias("first_expiry"), F.max("hi").alias("last_expiry"), histogram.alias("tenors"), F.array_join(F.array_sort(missing), ",").alias("missing_tenors"))


def surface_quality(contracts: DataFrame, as_of: Column, stale_s: int = 30) -> DataFrame:
    """Per symbol and expiry: stale quotes, odd greeks, gaps between strikes, jumps of the calls' volatility, and a score (AGG-13 to
    AGG-18). A ladder strike without a call breaks the comparison of volatilities."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1000000
    call = F.col("option_type") == "call"
    bad_delta = F.when(call, ~F.col("delta").between(0, 1)).otherwise(~F.col("delta").between(-1, 0))
    c = contracts.withColumns({"stale": age > stale_s, "age": age, "no_greeks": F.col("delta").isNull() | F.col("gamma").isNull(), "bad_delta": bad_delta, "bad_gamma": F.col("gamma") < 0})
    count = lambda x: F.sum(F.coalesce(F.col(x), F.lit(False)).cast("long"))
    flags = c.groupBy("symbol", "expiry").agg(F.count("*").alias("n"), *[count(x).alias(x) for x in ("stale", "no_greeks", "bad_delta", "bad_gamma")], F.max("age").alias("max_age_s"))
    strikes = contracts.groupBy("symbol", "expiry", "strike").agg(F.max(F.when(call, F.col("iv"))).alias("iv"))
    w = Window.partitionBy("symbol", "expiry").orderBy("strike")
    strikes = strikes.withColumn("spacing", F.col("strike") - F.lag("strike").over(w)).withColumn("iv_before", F.lag("iv").over(w))
    strikes = strikes.withColumn("mean", F.avg("spacing").over(Window.partitionBy("symbol", "expiry")))
    shape = strikes.groupBy("symbol", "expiry").agg(
        F.sum((F.abs(F.col("spacing") - F.col("mean")) > 0.5 * F.col("mean")).cast("long")).alias("strike_gaps"), F.sum((F.abs(F.col("iv") / F.col("iv_before") - 1) > 0.2).cast("long")).alias("iv_jumps"),
    ).na.fill(0, ["strike_gaps", "iv_jumps"])
    step = lambda x, high, low: F.when(x > 0.5, high).when(x > 0.2, low).otherwise(0.0)
    n = F.col("n")
    score = 1 - step(F.col("stale") / n, 0.4, 0.2) - step(F.col("no_greeks") / n, 0.2, 0.1) - step((F.col("bad_delta") + F.col("bad_gamma")) / n, 0.2, 0.1) - F.when(F.col("strike_gaps") > 3, 0.1).otherwise(0.0) - F.when(F.col("iv_jumps") > 3, 0.1).otherwise(0.0)
    return flags.join(shape, ["symbol", "expiry"]).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def flow_features(flows: DataFrame, wallets: DataFrame, window: str, whale_usd: float = 1e6) -> DataFrame:
    """On-chain features per chain and time bucket: whale and exchange flows, active addresses, sizes, DEX volume and the running
    staked value (AGG-20 to AGG-25). wallets (chain, address) are joined once for each end; both ends may count. Null or negative
    values count as 0."""
    w = wallets.select(F.col("chain"), F.lower(F.trim("address")).alias("a")).distinct()
    f = flows.withColumn("usd", F.when(F.col("value_usd") > 0, F.col("value_usd")).otherwise(0.0)).withColumn("bucket", F.date_trunc(window, "ts"))
    for end in ("to", "from"):
        f = f.withColumn("_a", F.lower(F.trim(f"{end}_address"))).join(w.select("chain", F.col("a").alias("_a"), F.lit(True).alias(f"{end}_exchange")), ["chain", "_a"], "left").drop("_a")
    usd = lambda c: F.sum(F.when(c, F.col("usd")).otherwise(0.0))
    into, out, whale = F.coalesce("to_exchange", F.lit(False)), F.coalesce("from_exchange", F.lit(False)), F.col("usd") >= whale_usd
    delta = F.when(F.col("event_type").rlike("unstake|redeem"), -F.col("usd")).when(F.col("event_type").rlike("stake|mint"), F.col("usd")).otherwise(0.0)
    keys = ["chain", "bucket"]
    sums = f.groupBy(*keys).agg(usd(whale & into).alias("whale_in"), usd(whale & out).alias("whale_out"), usd(into).alias("exchange_in"), usd(out).alias("exchange_out"), F.count("*").alias("tx_count"), F.avg("usd").alias("mean_usd"), usd(F.col("event_type") == "dex_swap").alias("dex_volume"), F.sum(delta).alias("tvl_delta"))
    ends = f.select(*keys, F.explode(F.array(F.lower(F.trim("from_address")), F.lower(F.trim("to_address")))).alias("a")).where("a <> ''")
    active = ends.groupBy(*keys).agg(F.count_distinct("a").alias("active_addresses"))
    run = Window.partitionBy("chain").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    out_ = sums.join(active, keys, "left").withColumn("tvl", F.sum("tvl_delta").over(run))
    before = F.lag("tvl").over(Window.partitionBy("chain").orderBy("bucket"))
    return out_.withColumns({"whale_net": F.col("whale_in") - F.col("whale_out"), "exchange_net": F.col("exchange_in") - F.col("exchange_out"), "tvl_change_pct": F.when(before > 0, F.least(F.greatest(F.col("tvl_delta") / before * 100, F.lit(-100.0)), F.lit(1000.0))).otherwise(0.0)})


def finalized(flows: DataFrame, depth: int = 12) -> DataFrame:
    """Flows whose block lies at least `depth` below the chain's tip and isn't invalidated: where a block was seen with different
    hashes, rows of older versions at or above it are dropped (AGG-26). flows: chain, block_number, block_hash, captured."""
    tip = flows.groupBy("chain").agg(F.max("block_number").alias("tip"))
    newest = flows.groupBy("chain", "block_number").agg(F.max_by("block_hash", "captured").alias("hash"), F.max("captured").alias("seen"), F.count_distinct("block_hash").alias("versions"))
    reorg = newest.where("versions > 1").groupBy("chain").agg(F.min("block_number").alias("reorg_block"), F.max("seen").alias("reorg_seen"))
    j = flows.join(tip, "chain").join(reorg, "chain", "left")
    stale = F.coalesce((F.col("block_number") >= F.col("reorg_block")) & (F.col("captured") < F.col("reorg_seen")), F.lit(False))
    return j.where((F.col("block_number") <= F.col("tip") - depth) & ~stale).withColumn("depth", F.col("tip") - F.col("block_number")).drop("tip", "reorg_block", "reorg_seen")


def settled(rows: DataFrame, depth: int = 12, state: dict[str, DataFrame] | None = None, step: int = 86400) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(rows that become final, state): rows (chain, id, block, hash, captured) become final once their chain's tip lies `depth` above
    their block. A row that brings a block that isn't final yet another hash is a reorganisation: of its block and all above it the
    rows captured before are dropped, save final ones (STR-09).

    Rows come in the order of (captured, id). state holds what the rows so far leave: `pending` rows, `tips` by chain, and the last
    `hashes` of blocks that aren't final. Rows in several portions, each with the state of the ones before, give what they give at once.
    Work is dealt by chain and block, and by chain and range of `step` captured units for the tips, so that a chain is many tasks. Only
    the rows of blocks with several hashes are sorted; a chain's tip at a row is the highest block whose first row came by then. Blocks,
    what turned and cuts are written once, to the shared folder, when settled() is called.
    """
    columns = ("chain", "id", "block", "hash", "captured")
    new, state = rows.select(*columns), state or {}
    tips, hashes = state.get("tips"), state.get("hashes")
    known = new.withColumn("_new", F.lit(True))
    if hashes is not None:
        known = known.unionByName(hashes.withColumn("id", F.lit(None).cast(new.schema["id"].dataType)).withColumn("_new", F.lit(False)))
    at = F.struct("captured", "id")
    seen = known.groupBy("chain", "block").agg(
        F.max_by(F.struct("hash", "captured"), at).alias("h"), F.min(F.when(F.col("_new"), at)).alias("_first"), (F.min("hash") != F.max("hash")).alias("_several"),
    )
    seen = written(seen, "blocks")
    rises = seen.where("_first IS NOT NULL").select("chain", "block", "_first.*")
    before = F.lag("hash").over(Window.partitionBy("chain", "block").orderBy("captured", "id"))
    turned = known.join(seen.where("_several").select("chain", "block"), ["chain", "block"], "left_semi").withColumn("_was", before).where(F.col("_new") & (F.col("hash") != F.col("_was")))
    turned = written(turned.select("chain", "block", "captured", "id", F.lit(True).alias("_turned")).unionByName(rises, allowMissingColumns=True), "turned")
    turned = summed(turned, ["chain"], "captured", ["captured", "id"], "block", "_tip", step, F.max).where("_turned")
    if tips is not None:
        turned = turned.join(tips.select("chain", F.col("tip").alias("_old")), "chain", "left").withColumn("_tip", F.greatest("_tip", "_old")).drop("_old")
    turned = turned.where(F.col("block") > F.col("_tip") - depth)
    cuts = turned.select("chain", F.explode(F.sequence("block", "_tip")).alias("block"), F.struct("captured", "id").alias("_cut"))  # `depth` blocks at most
    cuts = written(cuts.groupBy("chain", "block").agg(F.max("_cut").alias("_cut")), "cuts")
    pending = new.unionByName(state["pending"]) if "pending" in state else new
    tip = rises.groupBy("chain").agg(F.max("block").alias("tip"))
    tip = tip if tips is None else tip.unionByName(tips).groupBy("chain").agg(F.max("tip").alias("tip"))
    kept = pending.join(cuts, ["chain", "block"], "left").where("_cut IS NULL OR NOT struct(captured, id) < _cut").join(tip, "chain")
    final = F.col("block") <= F.col("tip") - depth
    last = seen.join(tip, "chain").where(~final)
    return kept.where(final).select(*columns), {"pending": kept.where(~final).select(*columns), "tips": tip, "hashes": last.select("chain", "block", "h.hash", "h.captured")}


def on_spine(features: DataFrame, spine: DataFrame, keys: list[str]) -> DataFrame:
    """A row of features for each row of the spine (key columns), of zeros where nothing happened (AGG-25)."""
    return spine.join(features, keys, "left").na.fill(0)
