"""Queries over streams and datasets, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import adapters, io
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table
from ..streaming import bars as st
from .market import rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.file_stream(spark, f"{sf_dir}/events.parquet", "ts")


_CLOSED = "bar_us + 3600000000 <= (SELECT epoch_us(max(ts)) - 5000000 FROM events)"


@query(
    f"""WITH {VIEWS['trades']}, e AS (SELECT *, epoch_us(ts) AS us, epoch_us(ts) - epoch_us(ts) % 3600000000 AS bar_us FROM trades), t AS (SELECT *, (price <> lag(price) OVER (PARTITION BY venue, symbol, bar_us ORDER BY us, trade_id))::INT AS tick FROM e)
SELECT venue, symbol, make_timestamp(bar_us) AS bar_start, arg_min(price, {{'a': us, 'b': trade_id}}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {{'a': us, 'b': trade_id}}) AS close, sum(quantity) AS volume, count(*) AS trade_count, CAST(coalesce(sum(tick), 0) AS BIGINT) AS tick_count FROM t WHERE {_CLOSED} GROUP BY venue, symbol, bar_us"""
)
def str_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-02: the bars that the watermark has closed."""
    e = _events(spark, sf_dir)
    trades = e.select(F.col("event_type").alias("venue"), F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"), F.col("event_id").alias("trade_id"), "ts", F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("quantity"))
    return st.drained(st.bars(trades, ["venue", "symbol"], "1 hour"))


@query("SELECT event_type, user_id, count(*) AS n FROM (SELECT event_type, user_id, floor(value) AS v FROM events GROUP BY ALL) GROUP BY 1, 2")
def str_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05, STR-15: one row per type, user and whole value; the watermark spans the table."""
    e = _events(spark, sf_dir).withColumn("v", F.floor("value"))
    out = st.drained(st.deduplicated(e, ["event_type", "user_id", "v"], "ts", "400 days"))
    return out.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))


@query("WITH w AS (SELECT event_type, unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS start FROM events) SELECT event_type, start, count(*) AS n FROM w WHERE epoch_us(start) + 7200000000 <= (SELECT epoch_us(max(ts)) - 5000000 FROM events) GROUP BY 1, 2")
def str_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-11."""
    return st.drained(st.sliding_counts(_events(spark, sf_dir), ["event_type"], "2 hours", "1 hour", "5 seconds"))


@query(
    """WITH RECURSIVE o AS (SELECT event_type AS key, epoch_us(ts) AS us, event_id AS id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
e AS (SELECT key, us, id, k, us AS base, true AS emitted FROM o WHERE k = 1 UNION ALL SELECT o.key, o.us, o.id, o.k, CASE WHEN o.us - e.base >= 21600000000 THEN o.us ELSE e.base END, o.us - e.base >= 21600000000 FROM e JOIN o ON o.key = e.key AND o.k = e.k + 1)
SELECT key, id, us FROM e WHERE emitted"""
)
def str_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06, STR-08: at most one event of a type in six hours."""
    e = _events(spark, sf_dir).withColumn("id", F.col("event_id"))
    return st.drained(st.suppressed(e, "event_type", 6 * 3600)).select("key", "id", "us")


@query("WITH l AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) SELECT conv_id, turn, before, role FROM l WHERE before IS NOT NULL AND NOT ((before = 'user' AND role = 'assistant') OR (before = 'system' AND role = 'user'))")
def str_status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-12, in batch form only: roles that don't follow from the one before."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations").withColumn("before", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")))
    allowed = F.array(*[F.lit(x) for x in ("user>assistant", "system>user")])
    return c.where(F.col("before").isNotNull() & ~F.array_contains(allowed, F.concat_ws(">", "before", "role"))).select("conv_id", "turn", "before", "role")


@query("SELECT event_type, arg_max(value, {'a': ts, 'b': event_id}) AS value FROM events GROUP BY 1")
def str_latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-13."""
    return st.drained(st.latest(_events(spark, sf_dir), "event_type", "value", ["ts", "event_id"]), "complete").select("event_type", "value")


@query("WITH p AS (SELECT user_id, event_id, '{\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || CAST(user_id AS VARCHAR) || '}' AS payload, event_type FROM events) SELECT event_id, payload, sha256(payload) AS content_hash, event_type AS source_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS sequence, '1.0' AS schema_version FROM p")
def src_canonical_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return io.with_headers(e, F.col("event_type"), F.col("event_id")).select("event_id", "payload", "content_hash", "source_id", F.col("sequence").cast("bigint").alias("sequence"), "schema_version")


@query("SELECT event_id, 'hash_mismatch' AS reason, 'dlq.transport.events' AS dead_letter_topic FROM events WHERE event_id % 17 = 0")
def src_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03, SRC-04: messages whose payload was changed after it was hashed."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    m = io.with_headers(e, F.col("event_type"), F.col("event_id")).withColumn("payload", F.when(F.col("event_id") % 17 == 0, F.concat("payload", F.lit(" "))).otherwise(F.col("payload")))
    _, bad = io.dead_letters(m, "events", io.header_errors(m), F.lit("2024-02-01").cast("timestamp"))
    return bad.select("event_id", "reason", "dead_letter_topic")


@query("SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND event_type = 'view' GROUP BY 1, 2, 3")
def src_partitioned_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06 to SRC-08: written by day of a nanosecond time, read back by range with pruning."""
    e = table(spark, sf_dir, "events").withColumn("ns", F.unix_micros(F.col("ts").cast("timestamp")) * 1000)
    path = io.scratch(spark, "dataset")
    io.write_dataset(io.partitioned(e, "ns"), path, ["year", "month", "day"], ["ns"])
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    back = io.read_dataset(spark, path, ["year", "month", "day", "value"], "ts", at("2024-01-05"), at("2024-01-20"), F.col("event_type") == "view")
    return back.groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT user_id, event_id, event_type FROM events WHERE ts <= TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def src_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09."""
    return io.as_of_version(table(spark, sf_dir, "events"), ["user_id"], "ts", F.lit("2024-01-15").cast("timestamp_ntz"), ["event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT tier, count(*) AS n FROM (SELECT CASE WHEN a <= 300 THEN 'hot' WHEN a <= 900 THEN 'warm' WHEN a <= 2000 THEN 'cold' ELSE 'delete' END AS tier FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS a FROM orders)) GROUP BY 1")
def src_retention_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11."""
    o = table(spark, sf_dir, "orders").withColumn("tier", io.tier(F.col("o_orderdate"), F.lit("2002-01-01").cast("date"), 300, 900, 2000))
    return o.groupBy("tier").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS records, min(ts) AS first, max(ts) AS last, 'market' AS owner, 'events' AS kind FROM events")
def src_dataset_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13."""
    return io.dataset_info(table(spark, sf_dir, "events"), "ts", "market", "events").drop("schema")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'")
def src_entity_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14."""
    e = table(spark, sf_dir, "events").where(F.col("ts").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")))
    wanted = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return io.entities(e, "user_id", wanted, ("ts", "value")).select("event_id", "user_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 0.0::DOUBLE AS fee, 'clean.exchange_trades' AS dataset FROM events")
def src_typed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01, SRC-10, SRC-15 to SRC-17: JSON payloads as typed rows with defaults, and where they go."""
    e = table(spark, sf_dir, "events").withColumn("line", F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(","), F.expr("substr(props, 2)")))
    rows = io.json_rows(e.select("line"), "line", io.schema_of({"event_id": "int64", "k": "int64"}))
    out = io.with_defaults(rows, io.schema_of({"event_id": "int64", "k": "int64", "fee": "double"}), {"fee": 0.0})
    return out.withColumn("dataset", io.route(F.lit("raw_data.trades"))[1])


@query(
    """WITH RECURSIVE h AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events), (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR)) AS tick), t AS (SELECT tick, k FROM h, (SELECT DISTINCT event_type AS k FROM events)),
j AS (SELECT t.k, epoch_us(t.tick) AS us, (epoch_us(t.tick) - epoch_us(e.ts)) / 1000000 AS age FROM t ASOF JOIN (SELECT DISTINCT event_type AS k, ts FROM events) e ON t.k = e.k AND t.tick >= e.ts), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY us) AS n FROM j),
s AS (SELECT k, n, us, (age > 1200)::INT AS stale, (age < 600)::INT AS fresh, false AS raised, NULL::VARCHAR AS change FROM o WHERE n = 1
UNION ALL SELECT k, n, us, stale, fresh, CASE WHEN NOT raised AND stale >= 2 THEN true WHEN raised AND fresh >= 2 THEN false ELSE raised END, CASE WHEN NOT raised AND stale >= 2 THEN 'raised' WHEN raised AND fresh >= 2 THEN 'cleared' END
 FROM (SELECT o.k, o.n, o.us, CASE WHEN age > 1200 THEN s.stale + 1 WHEN age < 600 THEN 0 ELSE s.stale END AS stale, CASE WHEN age > 1200 THEN 0 WHEN age < 600 THEN s.fresh + 1 ELSE s.fresh END AS fresh, s.raised FROM s JOIN o ON o.k = s.k AND o.n = s.n + 1))
SELECT k AS key, us // 3600000000 AS id, us, change FROM s WHERE change IS NOT NULL"""
)
def str_freshness_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-07, FRE-06: hourly checks of each event type against a threshold of 20 minutes, with hysteresis."""
    from ..operators.asof import asof

    obs = table(spark, sf_dir, "events").select(F.col("event_type").alias("k"), F.col("ts").alias("tick"), F.col("event_id").alias("e"))
    edge = obs.agg(F.min("tick").alias("a"), F.max("tick").alias("b"))
    hours = edge.select(F.explode(F.sequence(F.date_trunc("hour", "a"), F.date_trunc("hour", "b"), F.expr("INTERVAL 1 HOUR"))).alias("tick")).select(F.col("tick").cast("timestamp_ntz").alias("tick"))
    j = asof(hours.join(obs.select("k").distinct()), obs, "tick", ["k"], ["e"]).where("matched_ts is not null")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    path = io.scratch(spark, "ticks")
    j.select("k", us("tick").alias("us"), F.call_function("div", us("tick"), F.lit(3600000000)).alias("id"), ((us("tick") - us("matched_ts")) / 1000000).alias("age_s"), F.lit(1200.0).alias("limit_s")).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    return st.drained(st.hysteresis(stream, "k"))
