"""Leakage between features and labels, splits and folds (LEAK-01 to LEAK-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confidence(ratio: Column, n: Column) -> Column:
    return 1 / (1 + F.exp(-ratio * F.sqrt(n)))


def severity(score: Column) -> Column:
    return F.when(score >= 0.2, "critical").when(score >= 0.05, "high").when(score >= 0.01, "medium").otherwise("low")


def _rated(df: DataFrame, hits: str, n: str) -> DataFrame:
    ratio = F.col(hits) / F.col(n)
    return df.withColumn("ratio", ratio).withColumn("confidence", confidence(ratio, F.col(n))).withColumn("severity", severity(F.col("ratio") * F.col("confidence")))


def look_ahead(features: DataFrame, labels: DataFrame, id_col: str, feature_ts: str, label_ts: str, horizon_s: float = 0, tolerance_s: float = 0.05) -> DataFrame:
    """One row: pairs whose feature time lies behind the label time less the horizon and tolerance (LEAK-01, JOIN-01)."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    late = us(feature_ts) - (us(label_ts) - int((horizon_s + tolerance_s) * 1e6))
    j = features.select(id_col, feature_ts).join(labels.select(id_col, label_ts), id_col).select(late.alias("late"))
    return _rated(j.agg(F.count("*").alias("n"), F.count_if(F.col("late") > 0).alias("violations"), F.max(F.when(F.col("late") > 0, F.col("late") / 1000)).alias("max_ms")), "violations", "n")


def shared(df: DataFrame, group: str, item: Column) -> DataFrame:
    """Per pair of groups the distinct items that both have, their share of the smaller group and Jaccard similarity (LEAK-02,
    LEAK-04, SET-01, SET-02). Items are grouped once to the set of groups they are in, so that no item is joined with itself."""
    sets = df.where(item.isNotNull()).select(F.col(group).alias("g"), item.alias("item")).groupBy("item").agg(F.array_sort(F.collect_set("g")).alias("gs"))
    combos = sets.groupBy("gs").agg(F.count("*").alias("n"))
    sizes = combos.select(F.explode("gs").alias("g"), "n").groupBy("g").agg(F.sum("n").alias("size"))
    pairs = combos.select("n", F.explode("gs").alias("a"), "gs").select("n", "a", F.explode("gs").alias("b")).where("a < b").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    every = sizes.alias("x").join(sizes.alias("y"), F.col("x.g") < F.col("y.g")).select(F.col("x.g").alias("a"), F.col("y.g").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b"))
    out = every.join(pairs, ["a", "b"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
    return out.withColumn("ratio", F.col("shared") / F.least("size_a", "size_b")).withColumn("jaccard", F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared")))


def timing_edge(df: DataFrame, delay_ms: Column, limit_ms: float | None = None) -> DataFrame:
    """One row: events faster than plausible (LEAK-03, LEAK-07, LEAK-08). Without a limit, half the first percentile between 1 and
    100 ms. Negative delays are left out."""
    d = df.select(delay_ms.alias("d")).where("d >= 0")
    stats = d.agg(F.percentile("d", F.array(*[F.lit(q) for q in (0.01, 0.05, 0.1, 0.5, 0.9, 0.95, 0.99)])).alias("p"), F.count("*").alias("n"))
    limit = F.lit(limit_ms) if limit_ms is not None else F.greatest(F.lit(1.0), F.least(F.lit(100.0), 0.5 * F.col("p")[0]))
    bounds = stats.select("p", limit.cast("double").alias("limit_ms"))
    return _rated(d.join(F.broadcast(bounds)).groupBy("p", "limit_ms").agg(F.count_if(F.col("d") < F.col("limit_ms")).alias("faster"), F.count("*").alias("n")), "faster", "n")


def embargo(df: DataFrame, fold: str, ts: str, hours: float = 24) -> DataFrame:
    """Pairs of folds whose time ranges come closer than the embargo (LEAK-05, JOIN-12)."""
    r = df.groupBy(F.col(fold).alias("f")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    p = r.alias("x").join(r.alias("y"), F.col("x.f") < F.col("y.f"))
    gap = (F.greatest(us("x.lo"), us("y.lo")) - F.least(us("x.hi"), us("y.hi"))) / 3.6e9
    return p.select(F.col("x.f").alias("a"), F.col("y.f").alias("b"), gap.alias("gap_hours")).withColumn("violation", F.col("gap_hours") < hours)


def target_copies(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Per feature how often it equals the target, their correlation and normalised distance, and whether that is a leak (LEAK-06)."""
    each = df.select(F.col(target).alias("y"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("v")).select("y", "v.feature", "v.x")
    out = each.groupBy("feature").agg(F.avg((F.abs(F.col("x") - F.col("y")) <= 1e-10).cast("double")).alias("equal_rate"), F.abs(F.corr("x", "y")).alias("correlation"), F.avg(F.abs(F.col("x") - F.col("y"))).alias("mae"), F.stddev_pop("y").alias("sd"))
    nmae = F.col("mae") / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
    return out.withColumn("nmae", nmae).withColumn("leak", (F.col("equal_rate") > 0.95) | ((F.col("equal_rate") > 0.1) & (F.col("correlation") > 0.99)) | (F.col("nmae") < 0.1)).drop("mae", "sd")


def suspicious_columns(df: DataFrame, words: tuple[str, ...] = ("label", "target", "outcome", "result", "profit", "loss", "pnl")) -> list[str]:
    """Columns whose names speak of the answer (VAL-38)."""
    return [c for c in df.columns if any(w in c.lower() for w in words)]


def incident_id(kind: Column, scope: Column) -> Column:
    return F.concat(F.lit("leak_"), F.substring(F.sha2(F.concat_ws("|", kind, scope), 256), 1, 12))


def with_examples(rows: DataFrame, k: int = 5) -> DataFrame:
    """(scope, n, violations, worst, examples) of rows (scope, measure, example): a row violates if its measure isn't null; worst is the
    largest measure and examples the examples of the k largest, ties by their text. One pass: each task keeps k rows per scope at
    most and its counts, and only these are shuffled."""

    def run(batches):
        import heapq

        import pyarrow as pa

        kept: dict = {}
        for batch in batches:
            for scope, measure, example in zip(*(c.to_pylist() for c in batch.columns)):
                one = kept.setdefault(scope, [0, 0, []])
                one[0] += 1
                if measure is not None:
                    one[1] += 1
                    one[2].append((-measure, example or ""))
                    if len(one[2]) >= 64 * k:
                        one[2] = heapq.nsmallest(k, one[2])
        for scope, (n, violations, worst) in kept.items():
            listed = [{"by": by, "example": example} for by, example in heapq.nsmallest(k, worst)]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("by", pa.float64()), ("example", pa.string())])))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((scope, n, violations, listed), kinds)], names=["scope", "n", "violations", "worst"])

    each = rows.select(F.col("scope").cast("string"), F.col("measure").cast("double"), F.col("example").cast("string")).mapInArrow(run, "scope string, n long, violations long, worst array<struct<by: double, example: string>>")
    out = each.groupBy("scope").agg(F.sum("n").alias("n"), F.sum("violations").alias("violations"), F.slice(F.array_sort(F.flatten(F.collect_list("worst"))), 1, k).alias("w"))  # k rows per task
    return out.select("scope", "n", "violations", F.when(F.size("w") > 0, -F.col("w")[0]["by"]).alias("worst"), F.col("w.example").alias("examples"))


def _of_edges(rows: DataFrame, id_col: str, delay_ms: Column, limit_ms: float) -> DataFrame:
    d = rows.where(delay_ms >= 0).select(F.lit("").alias("scope"), F.when(delay_ms < limit_ms, limit_ms - delay_ms).alias("measure"), F.col(id_col).alias("example"))
    return with_examples(d)


def _of_shared(rows: DataFrame, group: str, item: str) -> DataFrame:
    """Pairs of groups: n is the number of items of the smaller one, violations those that both have."""
    sets = rows.where(F.col(item).isNotNull()).select(F.col(group).cast("string").alias("g"), F.col(item).cast("string").alias("i")).groupBy("i").agg(F.array_sort(F.collect_set("g")).alias("gs"))
    pair = F.explode(F.flatten(F.transform("gs", lambda a: F.transform(F.filter("gs", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b"))))))
    pairs = sets.where("size(gs) > 1").select("i", pair.alias("p"))
    found = with_examples(pairs.select(F.concat_ws("|", "p.a", "p.b").alias("scope"), F.lit(0).alias("measure"), F.col("i").alias("example"))).drop("n", "worst")
    size = sets.select(F.explode("gs").alias("g")).groupBy("g").agg(F.count("*").alias("size"))
    of = F.split("scope", "\\|")
    both = found.withColumns({"a": of[0], "b": of[1]}).join(size.select(F.col("g").alias("a"), F.col("size").alias("_a")), "a").join(size.select(F.col("g").alias("b"), F.col("size").alias("_b")), "b")
    return both.select("scope", F.least("_a", "_b").alias("n"), "violations", F.lit(None).cast("double").alias("worst"), "examples")


#: What each analyzer needs, in the order of analyze(): inputs by name, and what is made of them.
ANALYZERS = {
    "temporal_ordering": ("features", "labels"),
    "split_contamination": ("splits",),
    "mempool_edge": ("mempool",),
    "fold_entities": ("folds",),
    "fold_embargo": ("folds",),
    "target_copies": ("numbers",),
    "execution_edge": ("execution",),
    "bridge_edge": ("bridge",),
}


def analyze(inputs: dict[str, DataFrame], horizon_s: float = 0, tolerance_s: float = 0.05, edge_ms: float = 100, embargo_h: float = 24, most: int = 1000) -> DataFrame:
    """The findings of every analyzer whose inputs are given, the gravest first, `most` at most (LEAK-09): (incident_id, analyzer, scope,
    columns, n, violations, worst, examples, ratio, confidence, severity). An incident is one analyzer's, of one scope and its columns.

    Inputs: features (id, ts) and labels (id, ts); splits (split, item); folds (fold, entity, ts); mempool, execution and bridge
    (id, delay_ms); numbers (target and features, all numeric). Nulls never violate; at most five examples each (LEAK-01).
    """
    unknown = {*inputs} - {x for needs in ANALYZERS.values() for x in needs}
    if unknown:
        raise ValueError(f"not an input: {sorted(unknown)}")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    reports: dict[str, tuple[DataFrame, str]] = {}
    for name, needs in ANALYZERS.items():
        if not all(x in inputs for x in needs):
            continue
        df = inputs[needs[0]]
        if name == "temporal_ordering":
            j = df.select("id", F.col("ts").alias("_f")).join(inputs["labels"].select("id", F.col("ts").alias("_l")), "id")
            late = (us("_f") - us("_l") + int((horizon_s + tolerance_s) * 1e6)) / 1000
            reports[name] = with_examples(j.select(F.lit("").alias("scope"), F.when(late > 0, late).alias("measure"), F.col("id").alias("example"))), "feature_ts,label_ts"
        elif name in ("split_contamination", "fold_entities"):
            group, item = ("split", "item") if name == "split_contamination" else ("fold", "entity")
            reports[name] = _of_shared(df, group, item), item
        elif name == "fold_embargo":
            e = embargo(df, "fold", "ts", embargo_h).where("violation")
            reports[name] = e.select(F.concat_ws("|", "a", "b").alias("scope"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("violations"), (embargo_h - F.col("gap_hours")).alias("worst"), F.array().cast("array<string>").alias("examples")), "ts"
        elif name == "target_copies":
            t = target_copies(df, [c for c in df.columns if c != "target"], "target").where("leak")
            reports[name] = t.select(F.col("feature").alias("scope"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("violations"), F.greatest("equal_rate", "correlation").alias("worst"), F.array().cast("array<string>").alias("examples")), "target"
        else:
            reports[name] = _of_edges(df, "id", F.col("delay_ms"), edge_ms), "delay_ms"
    out = None
    for name, (df, columns) in reports.items():
        one = _rated(df.where("violations > 0"), "violations", "n").withColumns({"analyzer": F.lit(name), "columns": F.lit(columns)})
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no analyzer has its inputs")
    out = out.withColumn("incident_id", incident_id(F.col("analyzer"), F.concat_ws("|", "scope", "columns")))
    names = ("incident_id", "analyzer", "scope", "columns", "n", "violations", "worst", "examples", "ratio", "confidence", "severity")
    return out.select(*names).orderBy(F.desc(F.col("ratio") * F.col("confidence")), "incident_id").limit(most)


def combined(reports: dict[str, DataFrame], most: int = 1000) -> DataFrame:
    """The findings of several analyzers by identity, the gravest first, at most `most` (LEAK-09, JOIN-14). Each report has ratio,
    confidence and severity."""
    out = None
    for name, df in reports.items():
        one = df.select(F.lit(name).alias("analyzer"), "ratio", "confidence", "severity")
        out = one if out is None else out.unionByName(one)
    out = out.withColumn("incident_id", incident_id(F.col("analyzer"), F.col("severity")))
    first = out.groupBy("incident_id").agg(F.max_by(F.struct("analyzer", "ratio", "confidence", "severity"), "ratio").alias("r")).select("incident_id", "r.*")
    return first.orderBy(F.desc(F.col("ratio") * F.col("confidence")), "incident_id").limit(most)
