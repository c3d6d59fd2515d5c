"""Queries over streams in several micro-batches: timers, late rows, several topics, replay and reorganisations, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import market
from ..sources import adapters, io, ledger
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table
from ..streaming import bars as st
from ..streaming import late, timers
from .market import rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def landed(rows: DataFrame, batch: Column, n: int) -> DataFrame:
    """rows as a stream of n micro-batches, written one after the other; batch: the number of each row's. A micro-batch is a file for each
    core, so that it is as many tasks; each file begins with a row of its own, so that none is missing where rows are few."""
    spark, path = rows.sparkSession, io.scratch(rows.sparkSession, "landed")
    files = spark.sparkContext.defaultParallelism
    marks = spark.range(files).select(F.col("id").alias("_file"))
    for b in range(n):
        dealt = rows.where(batch == b).withColumns({"_file": F.pmod(F.xxhash64(*rows.columns), F.lit(files)), "_row": F.lit(True)})
        dealt.unionByName(marks, allowMissingColumns=True).repartitionById(files, F.col("_file").cast("int")).write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)
    return stream.where("_row").select(*rows.columns)


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three micro-batches of ten days."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    return landed(e, F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), 3)


_TICKS = """h AS (SELECT unnest(generate_series((SELECT min(epoch_us(ts)) // 3600000000 FROM events), (SELECT (max(epoch_us(ts)) // 1000 - 5000) // 3600000 FROM events))) * 3600000 AS tick),
o AS (SELECT event_type AS key, epoch_us(ts) // 1000 AS ms, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS total FROM events),
l AS (SELECT key, ms, max(total) AS total, arg_max(value, total) AS value FROM o GROUP BY ALL),
j AS (SELECT k.key, h.tick, l.ms, l.total, l.value FROM h CROSS JOIN (SELECT DISTINCT key FROM o) k ASOF JOIN l ON k.key = l.key AND h.tick >= l.ms),
t AS (SELECT *, (tick - ms) / 1e3 AS age, total - coalesce(lag(total) OVER (PARTITION BY key ORDER BY tick), 0) AS n, row_number() OVER (PARTITION BY key ORDER BY tick) AS i FROM j)"""


@query(
    f"""WITH RECURSIVE {_TICKS},
s AS (SELECT key, i, tick, age, (age > 1200)::INT AS stale, (age < 600)::INT AS fresh, false AS raised, NULL::VARCHAR AS change FROM t WHERE i = 1
UNION ALL SELECT key, i, tick, age, stale, fresh, CASE WHEN dead THEN false WHEN NOT raised AND stale >= 2 THEN true WHEN raised AND fresh >= 2 THEN false ELSE raised END, CASE WHEN dead THEN NULL WHEN NOT raised AND stale >= 2 THEN 'raised' WHEN raised AND fresh >= 2 THEN 'cleared' END
 FROM (SELECT t.key, t.i, t.tick, t.age, t.n = 0 AND t.age > 7200 AS dead, CASE WHEN t.n = 0 AND t.age > 7200 THEN 0 WHEN t.age > 1200 THEN s.stale + 1 WHEN t.age < 600 THEN 0 ELSE s.stale END AS stale, CASE WHEN t.n = 0 AND t.age > 7200 THEN 0 WHEN t.age > 1200 THEN 0 WHEN t.age < 600 THEN s.fresh + 1 ELSE s.fresh END AS fresh, s.raised FROM s JOIN t ON t.key = s.key AND t.i = s.i + 1))
SELECT key, tick * 1000 AS us, change, age AS age_s FROM s WHERE change IS NOT NULL"""
)
def str_silence_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-07: event types that fall silent, looked at every hour by timers, no row needed; forgotten after two hours."""
    return st.drained(timers.silences(_timed_events(spark, sf_dir), "event_type", 1200, 3600, 7200))


@query(f"WITH {_TICKS} SELECT key, tick * 1000 AS us, n, total, value, age AS age_s FROM t")
def str_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-10: each event type's count and last value, every hour."""
    return st.drained(timers.snapshots(_timed_events(spark, sf_dir), "event_type", "value", "event_id", 3600, 400 * 86400))


_POLICIES = {"view": "drop", "click": "quarantine", "purchase": "grace", "signup": "process"}
_BATCH = "least(4, event_id * 5 // (SELECT count(*) FROM events) + CASE WHEN event_id % 7 = 0 THEN 1 WHEN event_id % 11 = 0 THEN 2 ELSE 0 END)"


@query(
    f"""WITH e AS (SELECT *, {_BATCH} AS b FROM events), g AS (SELECT event_type, b, max(ts) AS m FROM e GROUP BY ALL), k AS (SELECT e.*, (SELECT max(m) - INTERVAL 1 HOUR FROM g WHERE g.event_type = e.event_type AND g.b < e.b) AS mark FROM e),
r AS (SELECT *, (epoch_us(mark) - epoch_us(ts)) / 1e6 AS late_s FROM k), f AS (SELECT *, CASE WHEN coalesce(late_s, 0) <= 0 THEN 'in_time' WHEN event_type = 'signup' OR (event_type = 'purchase' AND late_s <= 518400) THEN 'processed' WHEN event_type IN ('click', 'purchase') THEN 'quarantined' ELSE 'dropped' END AS route FROM r)
SELECT event_type AS topic, route, count(*) AS n, CAST(CASE WHEN route <> 'dropped' THEN sum(event_id) END AS BIGINT) AS ids, CASE WHEN route IN ('processed', 'quarantined') THEN round(max(late_s), 3) END AS latest FROM f GROUP BY 1, 2"""
)
def str_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-03: five micro-batches, of which some rows come one or two late; by topic they are dropped, quarantined, let pass within six
    days, or processed."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    n, i = e.count(), F.col("event_id")
    b = F.least(F.floor(i * 5 / n) + F.when(i % 7 == 0, 1).when(i % 11 == 0, 2).otherwise(0), F.lit(4))
    step = late.late_step("event_type", "ts", _POLICIES, 3600, 6 * 86400)
    book = ledger.committed(landed(e, b, 5), io.scratch(spark, "late"), io.scratch(spark, "progress"), step)
    kept = book.table("rows").unionByName(book.table("quarantine"))
    sums = kept.groupBy(F.col("event_type").alias("topic"), "route").agg(F.sum("event_id").alias("ids"), F.when(F.col("route") != "in_time", F.round(F.max("late_s"), 3)).alias("latest"))
    return book.table("routes").groupBy("topic", "route").agg(F.sum("n").alias("n")).join(sums, ["topic", "route"], "left")


_TWO = "SELECT event_type AS topic, event_id AS trade_id, epoch_us(ts) AS us, value AS price, 1.0 AS quantity FROM events WHERE event_type = 'view' OR (event_type = 'click' AND ts < TIMESTAMP '2024-01-20')"


@query(
    f"""WITH e AS ({_TWO}), c AS (SELECT min(m) AS mark FROM (SELECT max(us) - CASE topic WHEN 'view' THEN 5000000 ELSE 60000000 END AS m FROM e GROUP BY topic)), t AS (SELECT *, us // 3600000000 * 3600000000 AS bar, (price <> lag(price) OVER (PARTITION BY topic, us // 3600000000 ORDER BY us, trade_id))::INT AS tick FROM e)
SELECT topic, make_timestamp(bar) AS bar_start, arg_min(price, {{'a': us, 'b': trade_id}}) AS open, arg_max(price, {{'a': us, 'b': trade_id}}) AS close, count(*) AS trade_count, CAST(coalesce(sum(tick), 0) AS BIGINT) AS tick_count FROM t WHERE bar + 3600000000 <= (SELECT mark FROM c) GROUP BY topic, bar"""
)
def str_two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-04: bars of two topics, of which one ends earlier; no bar closes that it is still behind of."""
    e = st.file_stream(spark, f"{sf_dir}/events.parquet", "ts").select("event_type", F.col("event_id").alias("trade_id"), "ts", F.col("value").alias("price"), F.lit(1.0).alias("quantity"))
    topics = [(e.where("event_type = 'view'"), "view", "5 seconds"), (e.where("event_type = 'click' AND ts < TIMESTAMP '2024-01-20'"), "click", "60 seconds")]
    return st.drained(st.bars(late.together(topics, "ts"), ["topic"], "1 hour", None)).select("topic", "bar_start", "open", "close", "trade_count", "tick_count")


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, round(sum(value), 4) AS total FROM events GROUP BY 1")
def src_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: three micro-batches through the ledger, the second one once more with other partitions."""
    stream = _timed_events(spark, sf_dir)
    book = ledger.committed(stream, io.scratch(spark, "ledger"), io.scratch(spark, "progress"), offsets=("event_type", "event_id"))
    second = book.batches()[1]
    again = spark.read.schema(stream.schema).parquet(*[f"{book.path}/{f}" for f in book.entry(second)["tables"]["rows"]["files"]])
    book.run(again.repartition(3, "user_id"), second, offsets=("event_type", "event_id"))
    return rounded(book.table("rows").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.sum("value").alias("total")), 4)


@query(
    f"""WITH {VIEWS['flows']}, r AS (SELECT chain, flow_id AS id, flow_id // 100 - CASE WHEN flow_id % 700 < 9 THEN 3 ELSE 0 END AS block, CASE WHEN flow_id % 700 < 9 THEN 'alt' || CAST(flow_id // 700 AS VARCHAR) ELSE 'main' END AS hash, flow_id AS captured FROM flows),
k AS (SELECT *, lag(hash) OVER (PARTITION BY chain, block ORDER BY captured) AS was, max(block) OVER (PARTITION BY chain ORDER BY captured) AS tip FROM r), v AS (SELECT chain, unnest(generate_series(block, tip)) AS block, captured AS cut FROM k WHERE hash <> was AND block > tip - 12), c AS (SELECT chain, block, max(cut) AS cut FROM v GROUP BY ALL)
SELECT r.chain, id, r.block, hash FROM r LEFT JOIN c ON c.chain = r.chain AND c.block = r.block WHERE r.block <= (SELECT max(block) FROM r x WHERE x.chain = r.chain) - 12 AND (cut IS NULL OR captured >= cut)"""
)
def str_reorganised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-09: flows twelve blocks below the tip, with blocks that get another hash while they are pending, in four micro-batches."""
    i = F.col("flow_id")
    alt = i % 700 < 9
    block = (F.floor(i / 100) - F.when(alt, 3).otherwise(0)).cast("long").alias("block")
    f = adapters.flows(spark, sf_dir).select("chain", i.cast("long").alias("id"), block, F.when(alt, F.concat(F.lit("alt"), F.floor(i / 700).cast("string"))).otherwise("main").alias("hash"), i.cast("long").alias("captured"))
    f = io.kept(f, "flows")
    edge = f.agg(F.max("captured").alias("m")).first()["m"]

    def step(rows: DataFrame, state: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        final, left = market.settled(rows, 12, state)
        return {"final": final}, left

    book = ledger.committed(landed(f, F.least(F.floor(F.col("captured") * 4 / edge), F.lit(3)), 4), io.scratch(spark, "chains"), io.scratch(spark, "progress"), step)
    return book.table("final").select("chain", "id", "block", "hash")
