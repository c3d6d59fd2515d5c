"""Reading, writing and routing of datasets (SRC-01 to SRC-17)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type names of dataset definitions; other names are strings.
TYPES = {"string": T.StringType(), "int32": T.IntegerType(), "int64": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(), "date32": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType()}
#: Where a stream of raw data belongs.
ROUTES = {"raw_data.trades": "exchange_trades", "raw_data.book": "market_book", "raw_data.funding": "market_funding", "raw_data.oi": "market_oi", "raw_data.options": "options_surface", "raw_data.onchain": "onchain_flows", "raw_data.events": "offchain_events", "raw_data.macro": "macro_economic_indicators"}

#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; only a local session without that setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _LOCAL.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="quaysight-")
        _LOCAL[context.applicationId] = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to a new shared folder and read from there: for what is used several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def schema_of(definition: dict[str, str]) -> T.StructType:
    """A schema from simple type names (SRC-10)."""
    return T.StructType([T.StructField(name, TYPES.get(kind, T.StringType())) for name, kind in definition.items()])


def json_rows(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Typed rows of a JSON column, with the text of those that don't parse in _corrupt_record; nulls are skipped (SRC-01, SRC-17)."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return lines.where(F.col(column).isNotNull()).select(F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")


def with_headers(df: DataFrame, source: Column, order: Column, version: str = "1.0") -> DataFrame:
    """df with the payload as JSON in name order, its SHA-256, the source, a sequence per source by `order` and the schema version
    (SRC-02). Sequences are counted by ranges of the order, so that a source is many tasks."""
    from ..operators.blocks import numbered

    body = F.to_json(F.struct(*sorted(df.columns)))
    out = df.withColumn("source_id", source).withColumn("payload", body).withColumn("content_hash", F.sha2("payload", 256)).withColumn("schema_version", F.lit(version))
    return numbered(out.withColumn("_order", order), ["source_id"], "_order", ["_order"]).withColumnRenamed("_n", "sequence").drop("_order")


def header_errors(df: DataFrame) -> Column:
    """What is wrong with a message's envelope (SRC-03)."""
    return F.array_compact(F.array(F.when(F.col("payload").isNull(), "no_payload"), F.when(F.col("content_hash") != F.sha2("payload", 256), "hash_mismatch"), F.when(F.coalesce(F.col("sequence"), F.lit(0)) < 1, "bad_sequence"), F.when(F.coalesce(F.col("source_id"), F.lit("")) == "", "no_source")))


def dead_letters(df: DataFrame, origin: str, errors: Column, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters with origin, reason and time) (SRC-04)."""
    marked = df.withColumn("_errors", errors)
    good = marked.where(F.size("_errors") == 0).drop("_errors")
    bad = marked.where(F.size("_errors") > 0).withColumn("dead_letter_topic", F.lit(f"dlq.transport.{origin}")).withColumn("reason", F.array_join("_errors", ",")).withColumn("failed_at", as_of)
    return good, bad.drop("_errors")


def idempotent_sink(path: str):
    """A foreachBatch function that writes each micro-batch to a folder of its own, so that a repeated batch replaces itself (SRC-05)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def partitioned(df: DataFrame, ns: str) -> DataFrame:
    """df with year, month and day of a nanosecond time (SRC-07)."""
    t = F.timestamp_micros(F.call_function("div", F.col(ns), F.lit(1000).cast("bigint")))
    return df.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t)})


def write_dataset(df: DataFrame, path: str, partitions: list[str], sort: list[str], mode: str = "append", commit: Column | None = None) -> None:
    """Appends or overwrites a dataset in zstd Parquet (SRC-06). Rows are dealt by partition, large partitions to several tasks, and
    sorted so that row groups can be skipped."""
    out = df if commit is None else df.withColumn("_commit_ts", commit)
    if partitions:
        out = out.hint("rebalance", *partitions)
    writer = out.sortWithinPartitions(*partitions, *sort).write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def read_dataset(spark: SparkSession, path: str, columns: list[str] | None = None, time_col: str | None = None, start=None, end=None, filters: Column | None = None) -> DataFrame:
    """A dataset between two times inclusive, filtered and projected; filters reach the scan (SRC-08)."""
    df = spark.read.parquet(path)
    if time_col and start is not None:
        df = df.where(F.col(time_col) >= start)
    if time_col and end is not None:
        df = df.where(F.col(time_col) <= end)
    df = df if filters is None else df.where(filters)
    return df.select(*columns) if columns else df


def as_of_version(df: DataFrame, keys: list[str], commit: str, as_of: Column, order: list[str]) -> DataFrame:
    """The rows of a commit-stamped table as they stood at a time: of each key the newest commit until then (SRC-09)."""
    return df.where(F.col(commit) <= as_of).groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(commit, *order)).alias("_r")).select("_r.*")


def tier(ts: Column, as_of: Column, hot: int = 30, warm: int = 90, cold: int = 365) -> Column:
    """hot, warm, cold or delete by age in days (SRC-11)."""
    age = F.datediff(as_of, ts)
    return F.when(age <= hot, "hot").when(age <= warm, "warm").when(age <= cold, "cold").otherwise("delete")


def dataset_info(df: DataFrame, ts: str, owner: str = "", kind: str = "") -> DataFrame:
    """One row: declared type and owner, schema, records and the range of times (SRC-13)."""
    return df.agg(F.count("*").alias("records"), F.min(ts).alias("first"), F.max(ts).alias("last")).withColumns({"schema": F.lit(df.schema.simpleString()), "owner": F.lit(owner), "kind": F.lit(kind)})


def entities(df: DataFrame, entity: str, wanted: DataFrame | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the wanted entities, after a check that the required columns are there (SRC-14)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df if wanted is None else df.join(wanted.select(entity).distinct(), entity, "left_semi")


def with_defaults(df: DataFrame, schema: T.StructType, defaults: dict) -> DataFrame:
    """df in the types of the schema, with defaults for nulls and absent columns (SRC-15)."""
    have = lambda f: F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
    return df.select(*[(F.coalesce(have(f), F.lit(defaults[f.name]).cast(f.dataType)) if f.name in defaults else have(f)).alias(f.name) for f in schema.fields])


def route(topic: Column) -> tuple[Column, Column]:
    """(table, clean dataset) of a raw topic (SRC-16)."""
    table = F.try_element_at(F.create_map(*[F.lit(x) for p in ROUTES.items() for x in p]), topic)
    return table, F.when(table.isNotNull(), F.concat(F.lit("clean."), table))
