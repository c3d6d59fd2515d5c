"""The quality pipeline (QLT-01 to QLT-05): stage scores as columns of one plan, their weighted mean and what it lets through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weight and least score of each stage in order, the least final score, and the results that let a stage pass by mode.
WEIGHTS = {"schema": 0.15, "leakage": 0.35, "anomaly": 0.20, "freshness": 0.15, "reconciliation": 0.15}
GATES = {"schema": 0.99, "leakage": 1.0, "anomaly": 0.90, "freshness": 0.95, "reconciliation": 0.93}
FINAL_GATE = 0.88
MODES = {"strict": ("pass",), "resilient": ("pass", "warn"), "degraded": ("pass", "warn", "fail"), "emergency": ("pass", "warn", "fail", "error")}


def result(score: Column, gate: float) -> Column:
    return F.when(score.isNull(), "error").when(score >= gate, "pass").when(score >= gate * 0.9, "warn").otherwise("fail")


def scored(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """df with a score and a result per stage, the final score (rounded to six digits) and whether it passes."""
    out = df.withColumns({f"{s}_score": c for s, c in stages.items()}).withColumns({f"{s}_result": result(c, GATES[s]) for s, c in stages.items()})
    total = sum((WEIGHTS[s] * F.col(f"{s}_score") for s in stages), F.lit(0.0)) / sum(WEIGHTS[s] for s in stages)
    return out.withColumn("score", F.round(total, 6)).withColumn("passed", F.col("score") >= FINAL_GATE)


def reached(df: DataFrame, stages: list[str], mode: str) -> DataFrame:
    """df with the first stage that stops a row in the mode, null where none does (QLT-01)."""
    stop = None
    for s in stages:
        bad = ~F.col(f"{s}_result").isin(*MODES[mode])
        stop = F.when(bad, s) if stop is None else stop.when(bad, s)
    return df.withColumn("stopped_at", stop)


def with_controls(df: DataFrame, checks: dict[str, Column], sources: list[str], transformation: str, version: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their failed checks, one row of lineage with counts and an integrity hash) (QLT-05, PRJ-27, AGG-44, VAL-39)."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    out = df.withColumn("failed_checks", failed)
    n, kept = F.count("*"), F.count_if(F.size("failed_checks") == 0)
    lineage = out.agg(n.alias("rows_in"), kept.alias("rows_out"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string").alias("data_hash"))
    whole = F.concat_ws("|", F.lit(",".join(sorted(sources))), F.lit(transformation), F.lit(version), F.col("rows_in").cast("string"), F.col("rows_out").cast("string"))
    lineage = lineage.withColumn("filtered", F.greatest(F.lit(0), F.col("rows_in") - F.col("rows_out"))).withColumn("integrity", F.sha2(whole, 256))
    return out, lineage
