"""Market-shaped views of the plain tables, as projections and joins only. SQL holds the same views for SQL engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades: (venue, symbol, trade_id, ts, price, quantity, side)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("venue"),
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        F.col("event_id").alias("trade_id"),
        "ts",
        F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("double") + 1).alias("quantity"),
        F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
    )


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of a part as the levels of its book: (symbol, bids, asks), arrays of (price, quantity)."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    bid = F.when(F.col("l_returnflag") != "A", F.struct(F.round(F.col("p_retailprice") * (1 - F.col("l_discount")), 4).alias("price"), F.col("l_quantity").alias("quantity")))
    ask = F.when(F.col("l_returnflag") == "A", F.struct(F.round(F.col("p_retailprice") * (1 + F.col("l_tax") + 0.001), 4).alias("price"), F.col("l_quantity").alias("quantity")))
    return lines.groupBy(F.col("p_partkey").alias("symbol")).agg(F.collect_list(bid).alias("bids"), F.collect_list(ask).alias("asks"))


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as option quotes: (symbol, expiry, strike, option_type, iv, delta, gamma, underlying, ts)."""
    part = table(spark, sf_dir, "part")
    under = part.groupBy(F.col("p_brand").alias("brand")).agg(F.avg("p_size").alias("underlying"))
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).join(under, F.col("p_brand") == F.col("brand"))
    call = F.col("l_linestatus") == "O"
    return lines.select(
        F.col("p_brand").alias("symbol"), F.date_trunc("month", "l_shipdate").cast("date").alias("expiry"), F.col("p_size").cast("double").alias("strike"),
        F.when(call, "call").otherwise("put").alias("option_type"), F.round(0.2 + F.col("l_discount"), 4).alias("iv"), F.round(F.when(call, F.col("l_tax") * 10).otherwise(-F.col("l_tax") * 10), 4).alias("delta"),
        F.round(F.col("l_discount") - 0.01, 4).alias("gamma"), "underlying", F.col("l_shipdate").alias("ts"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice").alias("seq"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transfers: (flow_id, chain, from_address, to_address, value_usd, ts, event_type, method)."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("o_orderpriority").startswith("1"), "dex_swap").when(F.col("o_orderpriority").startswith("2"), "lst_stake").when(F.col("o_orderpriority").startswith("3"), "lst_unstake").otherwise("erc20_transfer")
    return j.select(
        F.col("o_orderkey").alias("flow_id"), F.concat(F.lit("chain"), F.col("n_regionkey").cast("string")).alias("chain"), F.col("c_name").alias("from_address"),
        F.concat(F.lit("wallet"), (F.col("o_custkey") % 50).cast("string")).alias("to_address"), F.col("o_totalprice").alias("value_usd"), F.col("o_orderdate").alias("ts"), kind.alias("event_type"),
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as incidents: (incident_id, ts, incident_class, agent, severity, resolved, value)."""
    severity = F.when(F.col("value") < 10, "info").when(F.col("value") < 30, "warn").otherwise("crit")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("incident_id"), "ts", F.col("event_type").alias("incident_class"), F.concat(F.lit("agent"), (F.col("user_id") % 5).cast("string")).alias("agent"), severity.alias("severity"),
        (F.col("event_id") % 3 == 0).alias("resolved"), "value",
    )


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as executions: (venue, symbol, order_id, signal_us, order_us, ack_us, fill_us, slippage, queue, quantity, price, fee, rejected)."""
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return j.select(
        F.col("l_returnflag").alias("venue"), F.col("l_suppkey").alias("symbol"), F.col("l_orderkey").alias("order_id"), us("o_orderdate").alias("signal_us"), (us("o_orderdate") + F.col("l_linenumber") * 3600000000).alias("order_us"),
        us("l_shipdate").alias("ack_us"), (us("l_shipdate") + F.col("l_linenumber") * 60000000).alias("fill_us"), (F.col("l_discount") * 100).alias("slippage"), F.col("l_linenumber").alias("queue"), F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), (F.col("l_tax") * F.col("l_extendedprice")).alias("fee"), (F.col("o_orderstatus") == "P").alias("rejected"),
    )


SQL = {
    "trades": "trades AS (SELECT event_type AS venue, 'S' || CAST(user_id % 10 AS VARCHAR) AS symbol, event_id AS trade_id, ts, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS quantity, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side FROM events)",
    "levels": "levels AS (SELECT p_partkey AS symbol, l_returnflag <> 'A' AS bid, CASE WHEN l_returnflag <> 'A' THEN round(p_retailprice * (1 - l_discount), 4) ELSE round(p_retailprice * (1 + l_tax + 0.001), 4) END AS price, l_quantity AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey)",
    "options": "options AS (SELECT p_brand AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS expiry, CAST(p_size AS DOUBLE) AS strike, CASE WHEN l_linestatus = 'O' THEN 'call' ELSE 'put' END AS option_type, round(0.2 + l_discount, 4) AS iv, round(CASE WHEN l_linestatus = 'O' THEN l_tax * 10 ELSE -l_tax * 10 END, 4) AS delta, round(l_discount - 0.01, 4) AS gamma, underlying, l_shipdate AS ts, {'a': l_shipdate, 'b': l_orderkey, 'c': l_linenumber, 'd': l_extendedprice} AS seq FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (SELECT p_brand AS brand, avg(p_size) AS underlying FROM part GROUP BY 1) ON p_brand = brand)",
    "flows": "flows AS (SELECT o_orderkey AS flow_id, 'chain' || CAST(n_regionkey AS VARCHAR) AS chain, c_name AS from_address, 'wallet' || CAST(o_custkey % 50 AS VARCHAR) AS to_address, o_totalprice AS value_usd, o_orderdate AS ts, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'dex_swap' WHEN '2' THEN 'lst_stake' WHEN '3' THEN 'lst_unstake' ELSE 'erc20_transfer' END AS event_type FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)",
    "incidents": "incidents AS (SELECT event_id AS incident_id, ts, event_type AS incident_class, 'agent' || CAST(user_id % 5 AS VARCHAR) AS agent, CASE WHEN value < 10 THEN 'info' WHEN value < 30 THEN 'warn' ELSE 'crit' END AS severity, event_id % 3 = 0 AS resolved, value FROM events)",
    "executions": "executions AS (SELECT l_returnflag AS venue, l_suppkey AS symbol, l_orderkey AS order_id, epoch_us(o_orderdate) AS signal_us, epoch_us(o_orderdate) + l_linenumber * 3600000000 AS order_us, epoch_us(l_shipdate) AS ack_us, epoch_us(l_shipdate) + l_linenumber * 60000000 AS fill_us, l_discount * 100 AS slippage, l_linenumber AS queue, l_quantity AS quantity, l_extendedprice / l_quantity AS price, l_tax * l_extendedprice AS fee, o_orderstatus = 'P' AS rejected FROM orders JOIN lineitem ON o_orderkey = l_orderkey)",
}
