"""Small fixtures for what tables don't show: nulls, ties, empty frames, quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaysight.functions import hashes
from quaysight.operators import anomaly, events, incidents, leakage, market, normalize, quality, reconcile, validate
from quaysight.operators.asof import asof, nearest
from quaysight.operators.bars import bars
from quaysight.operators.blocks import lagged, numbered, spans, summed
from quaysight.operators.features import foundation, momentum
from quaysight.sources import io
from quaysight.streaming import bars as streams

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.mark.parametrize(("bands", "value", "want"), [("collector", 10**9, 10**15), ("collector", 10**12, 10**15), ("collector", 10**15, 10**15), ("collector", 10**18, 10**15), ("validator", 10**10, 10**13), ("reconciler", 10**17, 10**14)])
def test_epoch_bands(spark, bands, value, want):
    assert spark.range(1).select(normalize.epoch_us(F.lit(value).cast("bigint"), bands).alias("x")).first().x == want


def test_text_times(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("2024-01-01",), ("garbage",), (None,)], "t string").select(normalize.text_us(F.col("t")).alias("x")).collect()
    assert [r.x for r in rows] == [1704067200000000] * 3 + [None] * 2


def test_symbols(spark):
    d = spark.createDataFrame([("kraken", "XBTUSDT"), ("coinbase", "BTC-USD"), ("okx", "ETH_USDT"), ("x", "BTC/EUR"), ("x", "???"), ("x", None)], "v string, s string")
    name, sure = normalize.canonical_symbol(F.col("v"), F.col("s"))
    assert [(r.n, r.c) for r in d.select(name.alias("n"), sure.alias("c")).collect()] == [("BTC-USDT", 0.7), ("BTC-USD", 0.8), ("ETH-USDT", 0.8), ("BTC-EUR", 0.7), (None, None), (None, None)]


def test_checksums(spark):
    d = spark.createDataFrame([("79927398713", "GB82WEST12345698765432", "080442957X"), ("79927398710", "GB82WEST12345698765431", "9780306406157"), (None, None, "9780306406158")], "l string, i string, b string")
    got = d.select(hashes.luhn(F.col("l")), hashes.iban(F.col("i")), hashes.isbn(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, True), (None, None, False)]


def test_guards(spark):
    d = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "x double")
    assert [r.g for r in d.select(normalize.guarded(F.col("x"), 0.0, 0.0, 1.0).alias("g")).collect()] == [0.0, 0.0, 0.0, 1.0]


def trades(spark, rows):
    return spark.createDataFrame([(s, i, at(t), p, q, side) for s, i, t, p, q, side in rows], "symbol string, trade_id long, ts timestamp_ntz, price double, quantity double, side string")


def test_bars_order_and_zero_volume(spark):
    t = trades(spark, [("a", 2, 10, 5.0, 1.0, "Buy"), ("a", 1, 10, 4.0, 1.0, None), ("a", 3, 59, 4.0, 2.0, "sell"), ("b", 4, 61, 1.0, 0.0, "buy")])
    got = {r.symbol: r for r in bars(t, ["1m"], ["symbol"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.open, a.close, a.tick_count, a.buy_volume, a.sell_volume, a.vwap) == (4.0, 4.0, 2, 1.0, 3.0, 4.25)
    assert (b.vwap, b.trade_count, b.completeness) == (None, 1, 0.3)
    assert bars(t.limit(0), ["1m"], ["symbol"]).count() == 0


def test_features_need_n_plus_one_bars(spark):
    rows = [("a", at(60 * i), 2.0, 1.0, 1.0 + i % 3, 1.0, 1.0, 2.0, 1.0, 1.0) for i in range(61)]
    d = spark.createDataFrame(rows, "symbol string, bar_start timestamp_ntz, high double, low double, close double, volume double, bid double, ask double, bid_volume double, ask_volume double")
    got = {r.bars: r for r in foundation(d).collect()}
    assert min(got) == 5 and got[60].volatility_60 == 0 and got[61].volatility_60 > 0
    flat = foundation(d.withColumn("close", F.lit(1.0))).orderBy("bars").collect()[-1]
    assert flat.skewness == 0 and flat.sharpe_60 == 0 and flat.volatility_60 == 0


def test_momentum_uses_168_lags(spark):
    d = spark.createDataFrame([("a", at(3600 * i), 100.0 + i, 1.0) for i in range(169)], "symbol string, bar_start timestamp_ntz, close double, volume double")
    got = momentum(d).orderBy("bars").collect()
    assert [r.bars for r in got] == [168, 169] and got[0].momentum_1w == 0 and got[1].momentum_1w == pytest.approx(168.0) and got[1].trend == "up"


def test_asof_ties_tolerance_and_nearest(spark):
    left = spark.createDataFrame([("a", at(10)), ("a", at(0)), ("b", at(5)), (None, at(9))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", at(10), 1.0), ("a", at(10), 2.0), ("a", at(4), 3.0), (None, at(1), 9.0)], "k string, ts timestamp_ntz, v double")
    got = {(r.k, r.ts): r.v_asof for r in asof(left, right, "ts", ["k"], ["v"]).collect()}
    assert got == {("a", at(10)): 2.0, ("a", at(0)): None, ("b", at(5)): None, (None, at(9)): 9.0}
    assert {r.v_asof for r in asof(left.where("k = 'a'"), right, "ts", ["k"], ["v"], strict=True).collect()} == {3.0, None}
    assert asof(left, right, "ts", ["k"], ["v"], tolerance_us=1000).where("v_asof is not null").count() == 1
    near = nearest(left.where("k = 'a'"), right, "ts", ["k"], "v", F.col("ts") - F.expr("INTERVAL 3 SECONDS"), F.lit(10_000_000)).collect()
    assert {r.ts: r.v_nearest for r in near} == {at(10): 3.0, at(0): 3.0}  # 7 s is as far from 4 s as from 10 s: the earlier counts


def test_book_without_asks_and_crossed(spark):
    kind = "symbol string, bids array<struct<price double, quantity double>>, asks array<struct<price double, quantity double>>"
    d = spark.createDataFrame([("a", [(1.0, 2.0), (3.0, 1.0), (2.0, 0.0)], [(4.0, 2.0)]), ("b", [(1.0, 1.0)], []), ("c", [(5.0, 1.0)], [(4.0, 1.0)])], kind)
    got = {r.symbol: r for r in market.book_snapshot(d).collect()}
    assert set(got) == {"a", "c"} and got["a"].best_bid == 3.0 and got["a"].bid_levels == 2 and got["a"].imbalance == 1.5
    flags = {r.symbol: (r.bids_unordered, r.crossed) for r in market.book_order_violations(d).collect()}
    assert flags == {"a": (True, False), "b": (False, False), "c": (False, True)}


def test_flows_both_ends_and_bad_values(spark):
    d = spark.createDataFrame([("x", "W1", "w1 ", 5.0, T0, "stake"), ("x", "a", "w1", None, T0, "unstake"), ("x", "a", "b", -3.0, T0, "dex_swap")], "chain string, from_address string, to_address string, value_usd double, ts timestamp_ntz, event_type string")
    r = market.flow_features(d, spark.createDataFrame([("x", "w1")], "chain string, address string"), "hour", 5.0).first()
    assert (r.whale_in, r.whale_out, r.exchange_net, r.active_addresses, r.tx_count, r.tvl) == (5.0, 5.0, 0.0, 3, 3, 5.0)


def test_suppression_times(spark):
    d = spark.createDataFrame([("c", at(s), i) for i, s in enumerate([0, 10, 29, 31, 62])], "k string, ts timestamp_ntz, incident_id long")
    got = incidents.suppressed(d, ["k"], 30).orderBy("us").collect()
    assert [(r.incident_id, r.repeats) for r in got] == [(0, 2), (3, 0), (4, 0)]


def test_reconcile_missing_first_row_and_tolerances(spark):
    a = spark.createDataFrame([(1, 1.0, at(0)), (2, 1.0, at(0)), (None, 1.0, at(0)), (4, None, at(0))], "k long, v double, t timestamp_ntz")
    b = spark.createDataFrame([(2, 1.0 + 1e-12, at(2)), (3, 1.0, at(0)), (None, 5.0, at(0)), (4, None, at(0.5))], "k long, v double, t timestamp_ntz")
    got = {(r.k, r.kind) for r in reconcile.compare(a, b, ["k"], ["v", "t"], times=("t",)).collect()}
    assert got == {(1, "missing_in_b"), (3, "missing_in_a"), (2, "timestamp_drift"), (None, "value_mismatch")}


def test_rules_and_split(spark):
    d = spark.createDataFrame([(1, "x", None), (None, "yy", 3.0), (3, "x", -1.0)], "id long, s string, v double")
    schema = validate.Schema("t", (validate.Field("s", max_length=1), validate.Field("v", low=0, required=True)), ("id",))
    clean, bad = validate.split(validate.violations(d, schema))
    assert clean.count() == 0 and {r.reason for r in bad.collect()} == {"missing:v", "too_long:s,key_missing:id", "below_minimum:v"}
    exclusive = validate.Schema("t", (), (), (validate.exclusive("x", ["s", "v"]),))
    assert [len(r.violations) for r in validate.violations(d, exclusive).collect()] == [0, 1, 1]


def test_flatline_and_adaptive(spark):
    d = spark.createDataFrame([("k", i, at(i), 1.0 if 5 <= i < 20 else float(i)) for i in range(40)], "k string, id long, ts timestamp_ntz, value double")
    assert [(r.length) for r in anomaly.flatlines(d, ["k"], ["ts", "id"]).collect()] == [15]
    wave = spark.createDataFrame([("k", i, at(i), 100.0 if i == 150 else float(i % 5)) for i in range(200)], "k string, id long, ts timestamp_ntz, value double")
    assert [r.id for r in anomaly.adaptive(wave, ["k"], ["ts", "id"]).collect()] == [150]


def test_shared_items(spark):
    d = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("c", 9), ("c", None)], "g string, x long")
    got = {(r.a, r.b): (r.shared, r.ratio) for r in leakage.shared(d, "g", F.col("x")).collect()}
    assert got == {("a", "b"): (1, 1.0), ("a", "c"): (0, 0.0), ("b", "c"): (0, 0.0)}


def test_quality_modes(spark):
    d = spark.range(1).select(F.lit(1.0).alias("schema_score"))
    s = quality.scored(d, {"schema": F.lit(1.0), "leakage": F.lit(0.95)})
    assert s.first().passed and quality.reached(s, ["schema", "leakage"], "strict").first().stopped_at == "leakage" and quality.reached(s, ["schema", "leakage"], "resilient").first().stopped_at is None


def test_corrupt_json_and_defaults(spark):
    d = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,)], "line string")
    rows = io.json_rows(d, "line", io.schema_of({"a": "int64"}))
    assert rows.count() == 2 and rows.where("_corrupt_record is not null").count() == 1
    assert io.with_defaults(rows, io.schema_of({"a": "int64", "b": "double"}), {"a": 0, "b": 1.5}).where("a is null or b <> 1.5").count() == 0


def test_stream_drops_late_rows(spark, tmp_path):
    rows = [("a", 1, at(0)), ("a", 2, at(3700)), ("a", 4, at(3750)), ("a", 3, at(10))]
    kind = "venue string, trade_id long, ts timestamp"
    for i, part in enumerate((rows[:2], rows[2:3], rows[3:])):
        spark.createDataFrame(part, kind).withColumns({"price": F.lit(1.0), "quantity": F.lit(1.0)}).coalesce(1).write.mode("append").parquet(str(tmp_path / f"p{i}"))
    import os
    import shutil

    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        name = next(x for x in os.listdir(tmp_path / f"p{i}") if x.endswith(".parquet"))
        shutil.copy(tmp_path / f"p{i}" / name, folder / f"{i}.parquet")
        os.utime(folder / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(spark.read.parquet(str(folder)).schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    got = streams.drained(streams.bars(s, ["venue"], "1 hour")).collect()
    assert [(r.bar_start, r.trade_count) for r in got] == [(T0, 1)]


def test_hysteresis(spark, tmp_path):
    ages = [0.0, 30.0, 30.0, 8.0, 4.0, 4.0, 30.0, 4.0]
    spark.createDataFrame([("s", i, i, a, 10.0) for i, a in enumerate(ages)], "k string, us long, id long, age_s double, limit_s double").write.parquet(str(tmp_path / "t"))
    s = spark.readStream.schema(spark.read.parquet(str(tmp_path / "t")).schema).parquet(str(tmp_path / "t"))
    assert [(r.id, r.change) for r in streams.drained(streams.hysteresis(s, "k")).orderBy("id").collect()] == [(2, "raised"), (5, "cleared")]


def test_final_flows_after_reorg(spark):
    d = spark.createDataFrame([("x", 1, 5, "h", 1), ("x", 2, 8, "old", 2), ("x", 3, 8, "new", 5), ("x", 4, 30, "h", 6)], "chain string, flow_id long, block_number long, block_hash string, captured long")
    assert sorted(r.flow_id for r in market.finalized(d).collect()) == [1, 3]


def test_landing(spark):
    from quaysight.operators import landing

    d = spark.createDataFrame([("1",), (" 1",), ("x",), (None,), ("1704067200",)], "t string")
    got = [tuple(r.r) if r.r else None for r in d.select(landing.coerced(F.col("t"), "bigint").alias("r")).collect()]
    assert got == [(1, "ok"), (1, "type_coerced"), (None, "type_mismatch"), (None, None), (1704067200, "ok")]
    assert d.select(landing.coerced(F.col("t"), "timestamp_us").alias("r")).collect()[4].r.value == 1704067200000000
    with pytest.raises(ValueError):
        landing.aligned(d, d, None)
    a, b = spark.createDataFrame([(1, 2.0)], "x long, y double"), spark.createDataFrame([(1, "s")], "x long, z string")
    assert landing.schema_difference(a, b) == [("y", "double", ""), ("z", "", "string")]
    assert landing.analysed(spark.createDataFrame([(1, 2, 3)], "user_id long, price long, bid long")) == ["price", "bid"]
    key = landing.symmetric_id("a", "b", F.lit(1)), landing.symmetric_id("b", "a", F.lit(1))
    assert spark.range(1).select(key[0] == key[1]).first()[0]


def test_custom_rules_are_columns(spark):
    d = spark.createDataFrame([(1,), (4,)], "x long")
    s = validate.Schema("t", (validate.Field("x", custom=lambda c: c % 2 == 0),))
    assert [len(r.violations) for r in validate.violations(d, s).collect()] == [1, 0]


def _series(spark, n=400):
    """Rows of a hot key, a small one and a null one over many ranges of 100 s, with ties, null times and null values."""
    rows = [(i, ("a", "b", None)[(i % 7 == 0) + (i % 11 == 0)], None if i % 97 == 5 else at((i * 37 % 400) * 5), None if i % 13 == 0 else float(i * 17 % 23)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, ts timestamp, value double")


def test_ranges_give_what_whole_keys_would(spark):
    rows, d = _series(spark)
    whole = {}
    for k in ("a", "b", None):
        mine = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2] is not None, r[2] or T0, r[0]))
        total = 0
        for n, r in enumerate(mine):
            total += r[0]
            whole[r[0]] = (n + 1, total, mine[n - 1][0] if n else None)
    order = ["ts", "id"]
    out = numbered(d.withColumn("x", F.col("id")), ["k"], "ts", order, 100)
    out = lagged(summed(out, ["k"], "ts", order, "x", "total", 100), ["k"], "ts", order, ["id"], step_s=100)
    assert {r.id: (r._n, r.total, r._before.id if r._before else None) for r in out.collect()} == whole
    assert numbered(d.where("id < 0"), ["k"], "ts", order).count() == 0


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_over_ranges(spark, direction, strict):
    rows, d = _series(spark)
    right = [r for r in rows if r[0] % 5 == 0]
    want = {}
    for i, k, ts, _ in rows:
        near = [(r[2], r[0]) for r in right if r[1] == k and ts is not None and r[2] is not None and (r[2] < ts or not strict and r[2] == ts if direction == "backward" else r[2] > ts or not strict and r[2] == ts)]
        best = (max if direction == "backward" else min)(near, key=lambda x: x[0], default=None)
        want[i] = best and max(x for x in near if x[0] == best[0])
    got = asof(d, d.where("id % 5 = 0").select("k", "ts", F.col("id").alias("v")), "ts", ["k"], ["v"], direction, strict=strict, step_s=100)
    assert {r.id: (r.matched_ts, r.v_asof) if r.matched_ts else None for r in got.collect()} == want


def test_near_rows_over_ranges(spark):
    rows, d = _series(spark)
    reach = dt.timedelta(minutes=2)
    out = spans(d, "ts", 90 * 1000000, 90 * 1000000, 100).where("_own")
    assert sorted(r.id for r in out.collect()) == [r[0] for r in rows]
    found = incidents.root_causes(d.withColumnsRenamed({"k": "agent"}), minutes=2, step_s=100)
    want = {i: sum(k == r[1] and r[0] != i and (ts is None and r[2] is None or None not in (ts, r[2]) and abs(r[2] - ts) <= reach) for r in rows) for i, k, ts, _ in rows}
    assert {r.id: r.related for r in found.collect()} == {i: min(n, 50) for i, n in want.items()}


def test_elements_of_a_hot_key(spark):
    rows, d = _series(spark)
    want = {}
    for k in ("a", "b", None):
        v = sorted((r[3] for r in rows if r[1] == k), key=lambda x: (x is not None, x or 0))
        want[k] = (len(v), *(v[int(len(v) * q)] for q in (0.5, 0.95, 0.99)))
    assert {r.k: (r.n, r.p50, r.p95, r.p99) for r in incidents.latency(d, ["k"], "value").collect()} == want
    health = events.health(d.withColumn("bad", F.col("id") % 2 == 0), ["k"], F.col("bad"), "value").collect()
    assert {r.k for r in health} == {"a", "b", None} and all(abs(r.uptime_pct + r.error_pct - 100) < 1e-9 for r in health)
    assert incidents.latency(d.where("id < 0"), ["k"], "value").count() == 0
