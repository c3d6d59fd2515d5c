"""Streams in several micro-batches: timers, the ledger, late rows, several topics, reorganisations."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quaysight.operators import market
from quaysight.sources import io, ledger
from quaysight.streaming import bars as st
from quaysight.streaming import late, timers

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stateful operator starts a worker in each micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def landed(spark, rows, schema, cut):
    """rows in micro-batches; cut: the number of each row's by its place."""
    path = io.scratch(spark, "landed")
    df = spark.createDataFrame([(*r, cut(i)) for i, r in enumerate(rows)], f"{schema}, _b int")
    for b in sorted({cut(i) for i in range(len(rows))}):
        df.where(F.col("_b") == b).drop("_b").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop("_b").schema).option("maxFilesPerTrigger", 1).parquet(path)


def walk(rows, limit, every, forget, until):
    """The alarms of silences() by going through each key's looks."""
    out = []
    for key in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == key)
        state, last, look = None, 0, -(-times[0] // every) * every
        while look <= until:
            new = [t for t in times if look - every < t <= look]
            if not new and look - last > forget:
                later = [t for t in times if t > look]
                if not later:
                    break
                state, last, look = None, 0, -(-later[0] // every) * every
                continue
            last = max([last, *new])
            stale, fresh, raised = state or (0, 0, False)
            age = look - last
            if age > limit:
                stale, fresh = stale + 1, 0
            elif age < limit / 2:
                stale, fresh = 0, fresh + 1
            if not raised and stale >= 2:
                raised = True
                out.append((key, look, "raised", float(age)))
            elif raised and fresh >= 2:
                raised = False
                out.append((key, look, "cleared", float(age)))
            state, look = (stale, fresh, raised), look + every
    return sorted(out)


@pytest.mark.parametrize("cut", [lambda i: 0, lambda i: i // 20])
def test_silence_is_noticed_without_rows(spark, cut):
    rng = random.Random(5)
    times = {"a": [5, 70, 130, 900, 930, 960, 1000], "b": range(0, 2400, 40), "c": [10], "d": sorted(rng.sample(range(2400), 12)), None: [30, 50]}
    rows = sorted(((k, s) for k, of in times.items() for s in of), key=lambda r: r[1])
    stream = landed(spark, [(k, T0 + dt.timedelta(seconds=s)) for k, s in rows], "key string, ts timestamp", cut)
    got = st.drained(timers.silences(stream, "key", 120, 60, 600, delay="5 seconds")).collect()
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    found = sorted(((r.key or ""), r.us // 1000000 - base, r.change, r.age_s) for r in got)
    assert found == walk([(k or "", s) for k, s in rows], 120, 60, 600, max(s for _, s in rows) - 5)
    assert {"raised", "cleared"} <= {r[2] for r in found} and ("c", 180, "raised", 170.0) not in found


def test_silence_by_the_clock(spark):
    """The whole stream falls silent: the clock alone raises, and the state ends."""
    stream = landed(spark, [("a", T0)], "key string, ts timestamp", lambda i: 0)
    timers.with_timers(spark)
    q = timers.silences(stream, "key", 0.5, 1, 6, clock=True).writeStream.format("memory").queryName("clock").trigger(processingTime="500 milliseconds").option("checkpointLocation", io.scratch(spark, "p")).start()
    try:
        for _ in range(40):
            q.awaitTermination(1)
            left = [o["numRowsTotal"] for p in q.recentProgress[-1:] for o in p["stateOperators"]]
            if spark.table("clock").count() and left == [0]:
                break
        assert [r.change for r in spark.table("clock").collect()] == ["raised"] and left == [0]
    finally:
        q.stop()


def test_snapshots_every_n_seconds(spark):
    rows = [("a", 3, 1, 1.0), ("a", 9, 2, None), ("b", 11, 3, 5.0), ("a", 25, 4, 7.0), ("a", 25, 5, 8.0), ("b", 62, 6, 6.0)]
    stream = landed(spark, [(k, T0 + dt.timedelta(seconds=s), i, v) for k, s, i, v in rows], "key string, ts timestamp, id long, value double", lambda i: i // 2)
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = st.drained(timers.snapshots(stream, "key", "value", "id", 10, 1000, delay="0 seconds")).collect()
    found = {(r.key, r.us // 1000000 - base): (r.n, r.total, r.value) for r in got}
    assert found["a", 10] == (2, 2, 1.0) and found["a", 30] == (2, 4, 8.0) and found["a", 20] == (0, 2, 1.0) and found["b", 20] == (1, 1, 5.0)
    assert len([k for k in found if k[0] == "a"]) == 6


def test_a_failed_batch_counts_once(spark):
    rows = [(i, f"p{i % 3}") for i in range(40)]
    stream, path, progress = landed(spark, rows, "id long, source string", lambda i: i // 10), io.scratch(spark, "ledger"), io.scratch(spark, "progress")

    def fails(batch):
        if batch == 2:
            raise RuntimeError("between write and commit")

    with pytest.raises(StreamingQueryException):
        ledger.committed(stream, path, progress, offsets=("source", "id"), before_commit=fails)
    book = ledger.Ledger(spark, path)
    assert book.batches() == [0, 1] and book.table("rows").count() == 20
    book = ledger.committed(stream, path, progress, offsets=("source", "id"))
    assert sorted(r.id for r in book.table("rows").collect()) == list(range(40)) and book.batches() == [0, 1, 2, 3]
    assert book.entry(3)["offsets"] == {"p0": [30, 39], "p1": [31, 37], "p2": [32, 38]} and book.entry(3)["rows"] == 10
    assert book.vacuum() == 1 and book.table("rows").count() == 40
    ledger.committed(stream, path, progress)
    assert book.table("rows").count() == 40


def test_a_batch_that_runs_again_replaces_itself(spark):
    book, rows = ledger.Ledger(spark, io.scratch(spark, "ledger")), spark.range(100)

    def counted(rows, state):
        seen = state["seen"].first()["n"] if state else 0
        return {"rows": rows}, {"seen": rows.agg((F.count("*") + seen).alias("n"))}

    for b in range(3):
        book.run(rows.where(F.col("id") % 3 == b).repartition(2), b, counted)
    book.run(rows.where("id % 3 = 1").repartition(7, "id"), 1, counted)
    assert book.table("rows").count() == 100 and book.table("rows").distinct().count() == 100
    assert book.state()["seen"].first()["n"] == 100 and book.state(2)["seen"].first()["n"] == 67
    assert book.table("nothing") is None and ledger.Ledger(spark, io.scratch(spark, "ledger")).table("rows") is None


def test_late_rows_are_all_accounted_for(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["drop", "quarantine", "grace", "process", None]), None if i % 31 == 0 else T0 + dt.timedelta(seconds=i * 10 - rng.choice([0, 0, 0, 100, 400, 2000]))) for i in range(300)]
    stream = landed(spark, rows, "id long, topic string, ts timestamp", lambda i: i // 60)
    book = ledger.committed(stream, io.scratch(spark, "l"), io.scratch(spark, "p"), late.late_step("topic", "ts", {p: p for p in late.POLICIES}, 60, 300))
    want, marks = {}, {}
    for b in range(5):
        part = rows[b * 60 : b * 60 + 60]
        for i, topic, ts in part:
            behind = (marks[topic] - ts).total_seconds() if ts and topic in marks else -1
            if ts and behind <= 0:
                want[i] = "in_time"
            elif topic in ("drop", None):
                want[i] = "dropped"
            else:
                want[i] = "processed" if ts and (topic == "process" or (topic == "grace" and behind <= 300)) else "quarantined"
        for topic in {r[1] for r in part}:
            marks[topic] = max([marks.get(topic, T0 - dt.timedelta(days=1)), *(r[2] - dt.timedelta(seconds=60) for r in part if r[1] == topic and r[2])])
    kept = {r.id: r.route for t in ("rows", "quarantine") for r in book.table(t).collect()}
    assert kept == {i: r for i, r in want.items() if r != "dropped"} and {*want.values()} == {"in_time", "dropped", "processed", "quarantined"}
    assert book.table("routes").agg(F.sum("n")).first()[0] == 300
    assert late.slowest(book.state()["marks"]).first()["mark"] == min(marks.values())
    with pytest.raises(ValueError):
        late.policy_of(F.col("topic"), {"a": "b"})


def test_bars_wait_for_the_slower_topic(spark):
    schema = "trade_id long, ts timestamp, price double, quantity double"
    fast = landed(spark, [(i, T0 + dt.timedelta(minutes=i), float(i), 1.0) for i in range(60)], schema, lambda i: i // 20)
    slow = landed(spark, [(100 + i, T0 + dt.timedelta(minutes=i), float(i), 1.0) for i in range(22)], schema, lambda i: i // 11)
    both = late.together([(fast, "fast", "1 minute"), (slow, "slow", "1 minute")], "ts")
    got = {(r.topic, r.bar_start.minute): r.trade_count for r in st.drained(st.bars(both, ["topic"], "10 minutes", None)).collect()}
    assert got == {(t, m): 10 for t in ("fast", "slow") for m in (0, 10)}  # the slower one's watermark is 20 minutes


def test_settled_is_the_same_for_every_cut(spark):
    rng, tip, hashes, rows = random.Random(8), 0, {}, []
    for i in range(400):
        chain = rng.choice("xy")
        tip += rng.random() < 0.3
        block = max(0, tip - rng.choice([0, 0, 0, 1, 2, 3, 9]))
        if rng.random() < 0.06 or (chain, block) not in hashes:
            hashes[chain, block] = f"h{i}"
        rows.append((chain, i, block, hashes[chain, block], i))
    pending, tips, last, want = [], {}, {}, set()
    for r in rows:  # row by row
        chain, i, block, h, _ = r
        tips[chain] = max(tips.get(chain, -1), block)
        if last.get((chain, block), h) != h and block > tips[chain] - 5:
            pending = [p for p in pending if not (p[0] == chain and p[2] >= block)]
        last[chain, block] = h
        pending.append(r)
        want |= {p for p in pending if p[0] == chain and p[2] <= tips[chain] - 5}
        pending = [p for p in pending if p not in want]
    df = spark.createDataFrame(rows, "chain string, id long, block long, hash string, captured long")
    for cuts in ([0, 400], [0, 150, 151, 400], list(range(0, 401, 100))):
        state, got = {}, []
        for a, b in zip(cuts, cuts[1:]):
            final, state = market.settled(df.where(f"id >= {a} and id < {b}"), 5, state, step=50)
            got += [tuple(r) for r in final.collect()]
            state = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in state.items()}
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) < len(rows) - len(pending)


def test_settled_agrees_with_finalized_on_one_reorganisation(spark):
    rows = [("x", i, i // 2, "b" if i in (41, 40) else "a", i) for i in range(40)] + [("x", 40, 17, "b", 40)] + [("x", i, i // 2, "a", i) for i in range(41, 80)]
    df = spark.createDataFrame(rows, "chain string, id long, block long, hash string, captured long")
    one = {r.id for r in market.settled(df, 12)[0].collect()}
    assert one == {r.id for r in market.finalized(df.withColumnsRenamed({"block": "block_number", "hash": "block_hash"})).collect()}


def test_a_landed_micro_batch_is_many_tasks(spark):
    from quaysight.plans.timed import landed as in_batches

    rows = spark.createDataFrame([(i, min(i // 1000, 3) if i < 3003 else None) for i in range(3010)], "id long, b int")  # the last one: three rows
    seen = []

    def look(part, n):
        seen.append((n, sorted(r.id for r in part.collect()), part.where("id IS NOT NULL").groupBy(F.spark_partition_id()).count().count()))

    q = in_batches(rows, F.col("b"), 5).select("id").writeStream.foreachBatch(look).option("checkpointLocation", io.scratch(spark, "progress")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [s[1] for s in seen] == [list(range(1000)), list(range(1000, 2000)), list(range(2000, 3000)), [3000, 3001, 3002], []]
    assert [s[2] for s in seen[:3]] == [spark.sparkContext.defaultParallelism] * 3


def test_settled_sorts_only_blocks_with_several_hashes(spark, monkeypatch):
    """60,000 rows of 600 blocks, of which one is taken back: the running tip is made from a row per block and the row that turns."""
    real, sizes = market.summed, []

    def summed(df, *args, **options):
        sizes.append(df.count())
        return real(df, *args, **options)

    monkeypatch.setattr(market, "summed", summed)
    i = F.col("id")
    block = F.when(i == 40555, 402).otherwise(F.floor(i / 100)).cast("long").alias("block")
    df = spark.range(60000).select(F.lit("x").alias("chain"), "id", block, F.when(i == 40555, "b").otherwise("a").alias("hash"), i.alias("captured"))
    final, state = market.settled(df, 12)
    gone = {*range(40200, 40555)}
    assert {r.id for r in final.collect()} == {x for x in range(60000) if x not in gone and x // 100 <= 587}
    assert state["tips"].first()["tip"] == 599 and {r.block for r in state["hashes"].collect()} == {*range(588, 600)} == {r.block for r in state["pending"].collect()}
    assert sizes == [601]
