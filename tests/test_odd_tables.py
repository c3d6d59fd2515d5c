"""Queries and their SQL over small tables with odd rows, and operators at sizes where they did too much."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from quaysight import plans
from tests.test_oracles import TABLES, plain


@pytest.fixture
def changed(spark, sf_dir, tmp_path):
    """A folder with the small tables, of which some are replaced: changed(events=function of the table)."""

    def make(**tables):
        for t in TABLES:
            if t in tables:
                tables[t](spark.read.parquet(f"{sf_dir}/{t}.parquet")).write.parquet(f"{tmp_path}/{t}.parquet")
            else:
                os.symlink(f"{sf_dir}/{t}.parquet", f"{tmp_path}/{t}.parquet")
        return str(tmp_path)

    return make


def agrees(spark, folder, name):
    """The query's rows, which are those of its SQL."""
    df = plans.queries()[name](spark, folder)
    names = sorted(df.columns)
    rows = df.collect()
    duck = duckdb.connect()
    duck.execute("SET TimeZone='UTC'")
    for t in TABLES:
        at = f"{folder}/{t}.parquet"
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    cur = duck.execute(plans.oracle_sql()[name])
    at = [[d[0] for d in cur.description].index(c) for c in names]
    assert sorted(tuple(plain(r[c]) for c in names) for r in rows) == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    return rows


def test_trade_schema_by_every_rule(spark, changed):
    i = F.col("event_id")
    folder = changed(events=lambda e: e.withColumns({
        "value": F.when(i == 3, 0.0).when(i == 4, -1.0).when(i == 5, 2e7).when(i == 6, F.lit(None)).otherwise(F.col("value")),
        "props": F.when(i == 7, "{}").when(i == 8, '{"k": -1}').otherwise(F.col("props")), "user_id": F.when(i != 9, F.col("user_id")), "event_type": F.when(i != 10, F.col("event_type")),
    }))
    kinds = {(r.kind, r.violations, r.first_row) for r in agrees(spark, folder, "val_trade_schema") if r.kind != "implausible_time"}
    assert {("below_minimum", 1, 8), ("above_maximum", 1, 5), ("missing", 1, 6), ("missing", 1, 7), ("missing", 1, 9), ("missing", 1, 10)} <= kinds
    assert any(kind == "below_minimum" and n >= 2 for kind, n, _ in kinds)


def test_every_analyzer_counts_all_delays(spark, changed):
    i = F.col("event_id")
    folder = changed(events=lambda e: e.withColumn("value", F.when(i % 10 == 0, 0.5).when(i % 10 == 1, 0.001).when(i == 2, -1.0).otherwise(20.0)))
    found = {r.analyzer: (r.n, r.violations) for r in agrees(spark, folder, "leak_every_analyzer")}
    n = spark.read.parquet(f"{folder}/events.parquet").count()
    assert found["mempool_edge"] == (n - 1, n // 5) == found["execution_edge"]


def test_every_analyzer_without_fast_delays_or_copies(spark, changed):
    folder = changed(events=lambda e: e.withColumn("value", F.lit(20.0)), lineitem=lambda x: x.withColumn("l_discount", F.col("l_extendedprice")))
    found = {(r.analyzer, r.scope) for r in agrees(spark, folder, "leak_every_analyzer")}
    assert not {a for a, _ in found} & {"mempool_edge", "execution_edge"} and {("target_copies", "discount"), ("target_copies", "copy")} <= found


def test_momentum_with_closes_of_zero_and_flat_volumes(spark, changed):
    # One trade an hour of each of two symbols over ten days; volumes go 1, 2, 2, 1, 1, 2, 2, 1, ... which is flat over many bars.
    def hourly(e):
        r, first = spark.range(480), e.first()
        hour, user = F.floor(F.col("id") / 2), F.col("id") % 2
        price = F.when((hour % 50 == 7) & (user == 0), 0.0).otherwise(F.round(50 + 10 * F.sin(hour * 0.7 + user), 2))
        made = {"event_id": F.col("id"), "ts": F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_interval(hours=hour.cast("int")), "user_id": user, "event_type": F.lit(first.event_type), "value": price, "props": F.concat(F.lit('{"k": '), F.when((hour % 4).isin(0, 3), "0").otherwise("1"), F.lit("}"))}
        return r.select(*[made[c].alias(c) for c in e.columns])

    rows = agrees(spark, changed(events=hourly), "win_momentum_features")
    assert len(rows) == 2 * (240 - 167) and all(abs(r.acceleration) < float("inf") for r in rows)
    # Over twenty bars the volumes of a whole number of rounds have no slope.
    bars = spark.createDataFrame([("S", i, 100.0 + i, (0.1, 0.7, 0.7, 0.1)[i % 4]) for i in range(400)], "symbol string, bar_start long, close double, volume double")
    from quaysight.operators.features import momentum

    got = {r.bar_start: r.price_volume_divergence for r in momentum(bars).collect()}
    assert {v for i, v in got.items() if i % 4 == 3} == {-0.7}


def test_counts_over_times_look_at_each_row_once(spark):
    # 120,000 incidents of one agent in six hours: a frame that slides looks at 7,200,000,000 rows, which takes more than a minute.
    import time

    from quaysight.operators import incidents

    df = spark.range(120000).select(F.col("id").alias("incident_id"), F.timestamp_seconds(F.col("id") * 0.18).alias("ts"), F.lit("x").alias("incident_class"), F.lit("a").alias("agent"))
    began = time.time()
    total = incidents.spikes(df, 6 * 3600, 5).agg(F.count("*").alias("n"), F.sum("recent").alias("s")).first()
    assert (total.n, total.s) == (120000 - 4, sum(range(5, 120001)))
    near = incidents.root_causes(df, 180).agg(F.count_if("burst").alias("n"), F.max("related").alias("m")).first()
    assert (near.n, near.m) == (120000, 50) and time.time() - began < 30


def test_spikes_against_brute_force_with_ties_and_no_times(spark):
    from quaysight.operators import incidents

    rows = [(i, None if i % 11 == 0 else (i * i) % 397 + 86400 * (i % 3) - 200, "x" if i % 4 else None, "a") for i in range(300)]
    df = spark.createDataFrame(rows, "incident_id long, t long, incident_class string, agent string").withColumn("ts", F.timestamp_seconds("t"))
    want = {}
    for i, t, k, _ in rows:
        n = sum(c == k and (u is None if t is None else u is not None and t - 60 <= u <= t) for _, u, c, _ in rows)
        if n >= 5:
            want[i] = n
    assert {r.incident_id: r.recent for r in incidents.spikes(df, 60, 5).collect()} == want and len(want) > 50


def test_related_ids_of_many_within_reach(spark):
    # 100,000 incidents of one agent in one minute, two to a time: each has all others in reach.
    import time

    from quaysight.operators import incidents

    df = spark.range(100000).select(F.col("id").alias("incident_id"), F.timestamp_micros((F.col("id") / 2).cast("long") * 1000).alias("ts"), F.lit("a").alias("agent"))
    began = time.time()
    found = incidents.related_ids(df).select("incident_id", "related_count", F.size("related").alias("n"), F.get("related", F.lit(49)).alias("last"), F.array_contains("related", F.col("incident_id")).alias("own"))
    got = found.agg(F.min("related_count"), F.max("related_count"), F.min("n"), F.count_if("own"), F.sum("last")).first()
    assert tuple(got) == (99999, 99999, 50, 0, 50 * 50 + 49 * (100000 - 50)) and time.time() - began < 30


def test_related_texts_count_what_related_pairs(spark):
    from quaysight.operators import events as ev

    rows = [(i, f"Meeting alpha bravo {('delta', 'extra', 'zulu yankee')[i % 3]}", "k", "uv"[i * i % 7 % 2] if i % 13 else None, (i * 7919) % 400000 // 900 * 900 - 50000) for i in range(400)]
    e = spark.createDataFrame(rows, "id long, title string, kind string, source string, t long").withColumn("start", F.timestamp_seconds("t"))
    members = {r.id: (r.class_id, r.text_id) for r in ev.event_texts(e).collect()}
    size = {}
    for c, _ in members.values():
        size[c] = size.get(c, 0) + 1
    want = {}
    for r in ev.related(e).collect():
        for x, y in {(r.a, r.b), (r.b, r.a)}:
            at = (x, members[y][1], round(r.similarity, 6))
            want[at] = want.get(at, 0) + size[y] - (x == y)
    got = {(r.class_id, r.text_id, round(r.similarity, 6)): r.links for r in ev.related_texts(e).collect()}
    assert got == want and len(want) > 500 and max(size.values()) > 1


def test_related_events_of_one_text_in_reach_of_each_other(spark):
    # 200,000 events of two texts within a day: 20,000,000,000 pairs.
    from quaysight.operators import events as ev

    e = spark.range(200000).select("id", F.lit("Meeting alpha bravo").alias("title"), F.lit("k").alias("kind"), F.when(F.col("id") % 2 == 0, "u").otherwise("v").alias("source"), F.timestamp_seconds(F.col("id") % 86001).alias("start"))
    got = ev.related_texts(e).agg(F.count("*"), F.sum("links")).first()
    classes = ev.event_texts(e).select("class_id").distinct().count()
    assert got[0] == 2 * classes and got[1] == classes * (2 * 100000 - 1)


def test_related_events_names_every_pair(spark, tmp_path):
    # Which classes are related, not how many: each pair of events must be found through the classes of both.
    import datetime as dt
    import itertools

    from quaysight.plans import more

    rows = [(i, "view" if i % 5 else "buy", i % 3 * 97 + i % 2, float(i % 4), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7919 % 300000 // 1200 * 1200)) for i in range(400)]
    rows += [(i + 400, *r) for i, *r in rows[:40]]
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    got = more.join_related_events(spark, str(tmp_path)).collect()
    of = {r.b: r.a for r in got if r.kind == "member"}
    pairs = {(r.a, r.b): r.similarity for r in got if r.kind == "pair"}
    want = {}
    for (i, k, u, v, t), (j, l, m, n, o) in itertools.combinations(rows, 2):
        text = lambda i, k, u, v: ({w for w in (k, f"user{u % 97}", "even" if i % 2 == 0 else "oddly", f"zone{int(v) % 3}") if len(w) > 3}, k)
        (a, ka), (b, kb) = text(i, k, u, v), text(j, l, m, n)
        alike = round(len(a & b) / len(a | b) + 0.3 * (u % 2 == m % 2), 6)
        if ka == kb and sorted(a)[:3] == sorted(b)[:3] and abs((t - o).total_seconds()) < 86400 and alike > 0.7:
            want[tuple(sorted((of[i], of[j])))] = alike
    assert set(of) == {r[0] for r in rows} and pairs == want and len(want) > 1000 and any(a == b for a, b in want)
    assert len(pairs) == sum(r.kind == "pair" for r in got)
