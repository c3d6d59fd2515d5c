"""Several sources, related ids, suggestions, leakage analyzers, audits, gaps across batches, odd series: against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaysight.operators import anomaly, incidents, leakage, validate
from quaysight.operators.sources import Source, Tolerance, all_pairs, same
from quaysight.sources import audit, io, ledger

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize(
    ("a", "b", "kind", "tolerance", "want"),
    [
        (None, None, "double", Tolerance(), True), (None, 1.0, "double", Tolerance(), False), (1e9, 1e9 + 0.5, "double", Tolerance(), True), (1e9, 1e9 + 2, "double", Tolerance(), False),
        (1.0, 1.0 + 2.3e-16, "double", Tolerance(0, 0, 2, 0), True), (1.0, 1.0 + 7e-16, "double", Tolerance(0, 0, 2, 0), False), (0.0, 5e-16, "double", Tolerance(0, 0, 0), True), (0.0, 5e-7, "double", Tolerance(), True),
        (float("inf"), float("inf"), "double", Tolerance(), True), (float("inf"), 1.0, "double", Tolerance(), False), (float("inf"), float("-inf"), "double", Tolerance(), False), (float("nan"), float("nan"), "double", Tolerance(), True), (float("nan"), 1.0, "double", Tolerance(), False),
        (1.004, 1.0, "double", Tolerance(0.005, decimal=3), True), (1.006, 1.0, "double", Tolerance(0.005, decimal=3), False), (3, 3, "long", Tolerance(), True), (3, 4, "long", Tolerance(), False),
        ("Ab", "aB", "string", Tolerance(case_sensitive=False), True), ("Ab", "aB", "string", Tolerance(), False), (True, True, "boolean", Tolerance(), True), (True, False, "boolean", Tolerance(), False),
    ],
)
def test_equal_values(spark, a, b, kind, tolerance, want):
    df = spark.createDataFrame([(a, b)], f"a {kind}, b {kind}")
    assert df.select(same(F.col("a"), F.col("b"), df.schema["a"].dataType, tolerance).alias("s")).first().s is want


def test_all_pairs_of_three_sources(spark):
    schema = "k string, price double, name string, v int"
    a = spark.createDataFrame([("x", 1.0, "N", 1), ("x", 2.0, "N", 2), (None, 5.0, "null", 1), ("only a", 1.0, "", 1)], schema)
    b = spark.createDataFrame([("x", 2.0, " N ", 1), (None, 5.0, None, 1)], schema)
    c = spark.createDataFrame([("x", 2.0, 9)], "k string, cost double, v int")
    blank = lambda c_: F.nullif(F.trim(c_), F.lit(""))
    sources = [Source("a", a, 1, order=("v",)), Source("b", b, 1, normalizers={"name": blank}, order=("v",)), Source("c", c, 5, {"cost": "price"}, order=("v",))]
    got = {(r.source_a, r.source_b, r.k, r.kind, r.field, r.severity, r.value_a, r.value_b) for r in all_pairs(sources, ["k"], ["price", "name"], severities={"name": "critical"}).collect()}
    assert got == {
        ("a", "b", "only a", "missing_record", None, "high", None, None), ("a", "b", None, "value_mismatch", "name", "critical", "null", None),
        ("a", "c", "only a", "missing_record", None, "high", None, None), ("a", "c", None, "missing_record", None, "high", None, None), ("b", "c", None, "missing_record", None, "high", None, None),
    }
    turned = all_pairs(sources[::-1], ["k"], ["price", "name"])
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(turned) == ids(all_pairs(sources, ["k"], ["price", "name"]))
    plan = turned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [k") == 1 and "Join" not in plan  # all sources meet at once
    assert all_pairs([Source(n, a.limit(0)) for n in "ab"], ["k"], ["price"]).count() == 0
    with pytest.raises(ValueError):
        all_pairs([sources[0], sources[0]], ["k"], ["price"])


def test_related_ids_of_one_agent(spark):
    rng = random.Random(2)
    rows = [(i, T0 + dt.timedelta(seconds=rng.choice([0, 600, 86340, 86400]) + rng.randrange(0, 20000)), "agent", 1.0) for i in range(2000)] + [(5000, None, "agent", 1.0), (5001, None, None, 1.0), (5002, T0, None, 1.0)]
    df = spark.createDataFrame(rows, "incident_id long, ts timestamp, agent string, value double")
    got = {r.incident_id: (r.related, r.related_count) for r in incidents.related_ids(df).collect()}
    timed = sorted((t, i) for i, t, a, _ in rows if t and a)
    for i, t, a, _ in rows[:2000:7] + rows[2000:]:
        near = [j for u, j in timed if t and a and j != i and abs((u - t).total_seconds()) <= 1800]
        assert got[i] == (near[:50], len(near)), i
    assert len(got) == len(rows) and max(len(r) for r, _ in got.values()) == 50


def brute_suggestions(values, valid):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, left = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
        return row[-1]

    out = set()
    for v in {v for v in values if v}:
        found = sorted((-round(1 - edits(v, w) / max(len(v), len(w)), 6), w) for w in {w for w in valid if w} if v != w)
        out |= {(v, w, -s) for s, w in [x for x in found if -x[0] >= 0.85][:3]}
    return out


def test_suggestions_against_brute_force(spark):
    rng = random.Random(6)
    valid = [f"Customer#{i:09}" for i in range(0, 120, 2)] + ["alpha", "alphabetical", "alphabetically", "a", "", None, "market_open_interest_by_venue_and_day"]
    values = [f"Customer#{rng.randrange(130):09}" for _ in range(40)] + ["Custmer#000000004", "alphabetcal", "alphabeticaly", "market_open_intrest_by_venu_and_da", "market_open_interest_by_venue_and_xyz9", "", None, "zzz"]
    got = validate.did_you_mean(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(v,) for v in valid], "valid string"))
    assert {tuple(r) for r in got.collect()} == brute_suggestions(values, valid)


def test_suggestions_grow_with_the_names(spark):
    """Joined rows of names with one prefix: twice the names, 2.16 times the rows (4 times by pieces)."""
    made = []
    for n in (1000, 2000):
        names = spark.range(n).select(F.format_string("Customer#%09d", "id").alias("value"))
        df = validate.did_you_mean(names, names.withColumnRenamed("value", "valid"))
        assert df.count() == 3 * n  # all done by one edit
        variants = names.select("value", F.explode(F.transform(F.sequence(F.lit(1), F.length("value")), lambda i: F.concat(F.substring("value", F.lit(1), i - 1), F.substring(F.col("value"), i + 1, F.length("value"))))).alias("k")).distinct()
        made.append(variants.groupBy("k").count().select(F.sum(F.col("count") * F.col("count"))).first()[0])
    assert made[1] <= 2.3 * made[0]


def test_examples_are_the_worst(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, 1.0, 2.0, 3.0]), f"x{i:04}") for i in range(3000)]
    got = {r.scope: r for r in leakage.with_examples(spark.createDataFrame(rows, "scope string, measure double, example string").repartition(7)).collect()}
    for s in "ab":
        bad = sorted((-m, e) for x, m, e in rows if x == s and m is not None)
        assert got[s].examples == [e for _, e in bad[:5]] and got[s].violations == len(bad) and got[s].n == sum(x == s for x, _, _ in rows) and got[s].worst == 3.0
    assert leakage.with_examples(spark.createDataFrame([], "scope string, measure double, example string")).count() == 0


def test_all_eight_analyzers(spark):
    ts = lambda s: T0 + dt.timedelta(seconds=s)
    make = spark.createDataFrame
    edge = make([(1, 5.0), (2, 500.0), (3, -1.0), (4, None)], "id long, delay_ms double")
    inputs = {
        "features": make([(i, ts(10 if i % 2 else 0)) for i in range(10)], "id long, ts timestamp"), "labels": make([(i, ts(5)) for i in range(10)], "id long, ts timestamp"),
        "splits": make([("train", "p"), ("test", "p"), ("test", "q"), ("valid", "q"), ("train", None)], "split string, item string"), "mempool": edge, "execution": edge, "bridge": edge,
        "folds": make([("0", "e", ts(0)), ("1", "e", ts(3600)), ("2", "f", ts(10**6))], "fold string, entity string, ts timestamp"), "numbers": make([(float(i), float(i), float(i % 2)) for i in range(50)], "target double, copy double, other double"),
    }
    found = leakage.analyze(inputs).collect()
    assert {(r.analyzer, r.scope) for r in found} == {
        ("temporal_ordering", ""), ("split_contamination", "test|train"), ("split_contamination", "test|valid"), ("mempool_edge", ""), ("execution_edge", ""), ("bridge_edge", ""), ("fold_entities", "0|1"), ("fold_embargo", "0|1"), ("target_copies", "copy"),
    }
    by = {(r.analyzer, r.scope): r for r in found}
    assert by["temporal_ordering", ""].examples == ["1", "3", "5", "7", "9"] and by["temporal_ordering", ""].worst == 5050.0 and by["mempool_edge", ""].n == 2
    assert by["split_contamination", "test|train"].examples == ["p"] and len({r.incident_id for r in found}) == len(found)
    assert {*leakage.ANALYZERS} == {r.analyzer for r in found} and leakage.analyze({"bridge": edge}).count() == 1
    with pytest.raises(ValueError):
        leakage.analyze({"features": edge})
    with pytest.raises(ValueError):
        leakage.analyze({"other": edge})


def test_audit_counts_in_the_run_that_writes(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(1000).select("id", F.timestamp_seconds("id").alias("ts")).mapInArrow(counted, "id long, ts timestamp")
    path = io.scratch(spark, "audited")
    r = audit.audited("even", rows, lambda d: d.where("id % 2 = 0"), path, "ts", {"big": F.col("id") >= 900, "never": F.col("id") < 0, "null": F.lit(None).cast("boolean")}, 600).first()
    assert (r.rows_in, r.rows_out, r.rows_lost, r.checks, r.within_sla, r.error) == (1000, 500, 500, {"big": 50, "never": 0, "null": 0}, True, None)
    assert seen.value == 1000 and spark.read.parquet(path).count() == 500 and (r["first"].second, r["last"].minute) == (0, 16)
    with pytest.raises(Exception, match="no such"):
        audit.audited("bad", rows, lambda d: d.select(F.raise_error(F.lit("no such")).alias("ts")), path, "ts")
    log = spark.read.parquet(f"{path}-audit").collect()
    assert {x.transformation: x.error is None for x in log} == {"even": True, "bad": False}
    empty = audit.audited("none", rows.limit(0), lambda d: d, path, "ts").first()
    assert (empty.rows_in, empty.rows_out, empty["first"], empty.within_sla) == (0, 0, None, None)


def test_gaps_over_any_cut(spark):
    rng = random.Random(7)
    rows = sorted({(rng.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rng.randrange(20000))) for _ in range(200)}, key=lambda r: r[1])
    rows = [(k, i, t) for i, (k, t) in enumerate(rows)] + [("a", 999, None)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp")
    want = sorted((r.id, r.gap_s) for r in anomaly.gaps(df.where("ts is not null"), ["k"], ["ts", "id"], 100).collect())
    for cuts in ([0, 1000], [0, 50, 51, 120, 1000]):
        book = ledger.Ledger(spark, io.scratch(spark, "g"))
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            book.run(df.where(f"id >= {lo} and id < {hi}"), b, anomaly.gaps_step(["k"], "id", 100))
        assert sorted((r.id, r.gap_s) for r in book.table("gaps").collect()) == want and len(want) > 20
        assert book.state()["last"].count() == 3


def test_a_flat_line_that_jumps(spark):
    rows = [(i, T0 + dt.timedelta(seconds=i), "k", 5.0 if i < 100 else 50.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, k string, value double")
    found = anomaly.level_shifts(df, ["k"], ["ts", "id"], 20).collect()
    assert {round(r["shift"]) for r in found} == {2250, 4500} and all(r.flat for r in found) and min(r.id for r in found) == 109
    small = df.withColumn("value", F.when(F.col("id") < 100, 5.0).otherwise(5.005))
    assert anomaly.level_shifts(small, ["k"], ["ts", "id"], 20).count() == 0
    tiny = df.withColumn("value", F.when(F.col("id") < 100, 1e-4).otherwise(2e-4))
    assert anomaly.level_shifts(tiny, ["k"], ["ts", "id"], 20).count() > 0


def test_finite_rows_stay_beside_an_odd_namesake(spark):
    rows = [(i, T0 + dt.timedelta(seconds=i), 1.0 + i % 3) for i in range(250)] + [(250, T0 + dt.timedelta(seconds=250), 99.0), (250, T0 + dt.timedelta(seconds=251), float("nan")), (251, T0 + dt.timedelta(seconds=252), None)]
    found = anomaly.analysed(spark.createDataFrame(rows, "id long, ts timestamp, x double"), "t", "id", "ts", ["x"], F.col("id")).where("field = 'x'").collect()
    assert {(r.kind, r.id) for r in found if r.id == 250} == {("spike", 250), ("non_finite", 250)}


def test_fields_with_most_violations(spark):
    v = validate.violations(spark.createDataFrame([(None, "x"), (None, "y"), (1, "ok")], "a int, b string"), validate.Schema("t", (validate.Field("a", required=True), validate.Field("b", allowed=("ok",)))))
    assert [(r.field, r.violations) for r in validate.top_fields(v).collect()] == [("a", 2), ("b", 2)] and validate.top_fields(v, 1).count() == 1
    assert isinstance(v.schema["a"].dataType, T.IntegerType)
