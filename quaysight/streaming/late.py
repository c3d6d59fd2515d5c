"""Late rows by policy, with a watermark per topic that is kept between micro-batches (STR-03, STR-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.ledger import Step

POLICIES = ("drop", "quarantine", "grace", "process")


def policy_of(topic: Column, policies: dict[str, str], otherwise: str = "drop") -> Column:
    """The policy of each row's topic."""
    wrong = {*policies.values(), otherwise} - {*POLICIES}
    if wrong:
        raise ValueError(f"not a policy: {sorted(wrong)}")
    out = F.lit(otherwise)
    for name, policy in policies.items():
        out = F.when(topic.eqNullSafe(F.lit(name)), policy).otherwise(out)
    return out


def routed(rows: DataFrame, marks: DataFrame | None, topic: str, ts: str, policy: Column, grace_s: float) -> DataFrame:
    """rows with late_s, the seconds by which a row lies behind its topic's mark (null: in time), and route: `in_time`, or for late ones
    `processed` (process; grace while late_s is at most grace_s), `quarantined` (quarantine; grace beyond) or `dropped`. marks: (topic,
    mark), of topics seen before; rows of new topics are in time, as rows without a time are quarantined or dropped by their policy."""
    marked = rows.withColumn("mark", F.lit(None).cast("timestamp")) if marks is None else rows.join(marks.select(F.col("topic").alias("_topic"), "mark"), F.col(topic).eqNullSafe(F.col("_topic")), "left").drop("_topic")
    behind = (F.unix_micros("mark") - F.unix_micros(F.col(ts).cast("timestamp"))) / 1000000
    late = marked.withColumn("late_s", F.when(behind > 0, behind)).withColumn("_policy", policy)
    timeless = F.col(ts).isNull()
    route = (
        F.when(~timeless & F.col("late_s").isNull(), "in_time").when(F.col("_policy") == "drop", "dropped").when(timeless | (F.col("_policy") == "quarantine"), "quarantined")
        .when((F.col("_policy") == "process") | (F.col("late_s") <= grace_s), "processed").otherwise("quarantined")
    )
    return late.withColumn("route", route).drop("_policy", "mark")


def advanced(rows: DataFrame, marks: DataFrame | None, topic: str, ts: str, delay_s: float) -> DataFrame:
    """(topic, mark): per topic the latest time of all rows less the delay; a mark never goes back. A row per topic."""
    new = rows.groupBy(F.col(topic).alias("topic")).agg(F.timestamp_micros((F.max(F.unix_micros(F.col(ts).cast("timestamp"))) - int(delay_s * 1e6))).alias("mark"))
    both = new if marks is None else new.unionByName(marks.select("topic", "mark"))
    return both.groupBy("topic").agg(F.max("mark").alias("mark"))


def slowest(marks: DataFrame) -> DataFrame:
    """One row: the mark of the slowest topic, up to which all topics are complete (STR-04)."""
    return marks.agg(F.min("mark").alias("mark"))


def late_step(topic: str, ts: str, policies: dict[str, str], delay_s: float, grace_s: float = 0.0, otherwise: str = "drop") -> Step:
    """A step for a ledger: tables `rows` (in time or processed), `quarantine` and `routes` (topic, route, n: what came, by what became of
    it, dropped ones too), and the state `marks`. Marks of a micro-batch are those that the ones before it left."""

    def step(rows: DataFrame, state: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        marks = state.get("marks")
        found = routed(rows, marks, topic, ts, policy_of(F.col(topic), policies, otherwise), grace_s)
        tables = {
            "rows": found.where("route in ('in_time', 'processed')"),
            "quarantine": found.where("route = 'quarantined'"),
            "routes": found.groupBy(F.col(topic).alias("topic"), "route").agg(F.count("*").alias("n")),
        }
        return tables, {"marks": advanced(rows, marks, topic, ts, delay_s)}

    return step


def together(streams: list[tuple[DataFrame, str, str]], ts: str) -> DataFrame:
    """Several topics' streams (stream, topic, delay) of equal columns as one, each with a watermark of its own. Spark's watermark is
    that of the slowest one (policy `min`), so that nothing closes while a topic is behind (STR-04)."""
    spark = streams[0][0].sparkSession
    if spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") != "min":
        raise ValueError("spark.sql.streaming.multipleWatermarkPolicy must be min")
    out = None
    for stream, topic, delay in streams:
        one = stream.withWatermark(ts, delay).withColumn("topic", F.lit(topic))
        out = one if out is None else out.unionByName(one)
    return out
