"""Exactly-once micro-batches: tables that a stream writes, the state it carries, and a ledger of what is committed (SRC-05).

A micro-batch is a DataFrame job. What it writes lies in a folder of its own attempt and counts only once the batch's entry stands in
the ledger, which is put there in one rename. Readers take the files that entries name. So a batch that fails before its entry leaves
nothing that is read, and a batch that runs again, with other files or partitions too, replaces its first run wholly. State is a
table like the others, of which the batch's successor reads the last version: it can't run ahead of the output or fall behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a micro-batch makes: tables to append to, and the new state; a function of (rows, state so far).
Step = Callable[[DataFrame, dict[str, DataFrame]], tuple[dict[str, DataFrame], dict[str, DataFrame]]]


class Ledger:
    """A folder with `entries/<batch>.json` and the files of attempts. One query writes to it at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Files of the ledger itself, by Hadoop's interface, which reaches every store that Spark reaches.
    def _fs(self):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs, folder.getFileSystem(conf)

    def _listed(self, folder: str) -> list[str]:
        hadoop, fs = self._fs()
        at = hadoop.Path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def batches(self) -> list[int]:
        """The committed batches, in order."""
        return sorted(int(n.removesuffix(".json")) for n in self._listed("entries") if n.endswith(".json"))

    def entry(self, batch: int) -> dict:
        """What the ledger says of a batch: batch, attempt, rows, offsets, tables and state (schema and files of each)."""
        hadoop, fs = self._fs()
        stream = fs.open(hadoop.Path(f"{self.path}/entries/{batch}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, batch: int, entry: dict) -> None:
        hadoop, fs = self._fs()
        new, final = hadoop.Path(f"{self.path}/entries/.{uuid.uuid4().hex}"), hadoop.Path(f"{self.path}/entries/{batch}.json")
        out = fs.create(new)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = hadoop.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._jvm.java.lang.reflect.Array.newInstance(hadoop.Options.Rename.OVERWRITE.getClass(), 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(new), fs.makeQualified(final), options)

    def _read(self, parts: list[dict]) -> DataFrame | None:
        if not parts:
            return None
        schema = T.StructType.fromJson(parts[-1]["schema"])
        files = [f"{self.path}/{f}" for p in parts for f in p["files"]]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def table(self, name: str) -> DataFrame | None:
        """The rows of all committed batches; None if no batch has the table."""
        return self._read([e["tables"][name] for e in map(self.entry, self.batches()) if name in e["tables"]])

    def state(self, before: int | None = None) -> dict[str, DataFrame]:
        """The state that the last committed batch, or the last one before a batch, left."""
        past = [b for b in self.batches() if before is None or b < before]
        return {name: self._read([part]) for name, part in (self.entry(past[-1])["state"] if past else {}).items()}

    def _write(self, df: DataFrame, folder: str) -> dict:
        df.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return {"schema": json.loads(df.schema.json()), "files": [f"{folder}/{n}" for n in self._listed(folder) if n.startswith("part-")]}

    def run(self, rows: DataFrame, batch: int, step: Step | None = None, offsets: tuple[str, str] | None = None, before_commit: Callable[[int], None] | None = None) -> dict:
        """Runs a batch and commits it; returns its entry. The rows are read once and kept while the batch's tables are made. offsets: the
        columns of source and offset, of which the entry keeps the smallest and largest offset by source."""
        rows = rows.persist()
        try:
            tables, state = step(rows, self.state(batch)) if step else ({"rows": rows}, {})
            attempt = f"attempts/{batch}-{uuid.uuid4().hex}"
            entry = {"batch": batch, "attempt": attempt, "rows": rows.count(), "tables": {}, "state": {}}
            for kind, found in (("tables", tables), ("state", state)):
                for name, df in found.items():
                    entry[kind][name] = self._write(df, f"{attempt}/{kind}-{name}")
            if offsets:
                source, offset = offsets
                edges = rows.groupBy(F.col(source).cast("string").alias("s")).agg(F.min(offset).alias("a"), F.max(offset).alias("b"))
                entry["offsets"] = {str(r["s"]): [r["a"], r["b"]] for r in edges.collect()}  # a row per source (partition of a topic)
        finally:
            rows.unpersist()
        if before_commit:
            before_commit(batch)
        self._put(batch, entry)
        return entry

    def sink(self, step: Step | None = None, **options) -> Callable[[DataFrame, int], None]:
        """A function for foreachBatch."""

        def write(rows: DataFrame, batch: int) -> None:
            self.run(rows, batch, step, **options)

        return write

    def vacuum(self) -> int:
        """Deletes the attempts that no entry names, while nothing is being written; returns their number."""
        hadoop, fs = self._fs()
        named = {self.entry(b)["attempt"] for b in self.batches()}
        spent = [n for n in self._listed("attempts") if f"attempts/{n}" not in named]
        for n in spent:
            fs.delete(hadoop.Path(f"{self.path}/attempts/{n}"), True)
        return len(spent)


def committed(stream: DataFrame, path: str, progress: str, step: Step | None = None, **options) -> Ledger:
    """Runs what there is of a stream through a ledger and returns it. A second call with the same folders goes on where the ledger
    stands: a batch that Spark repeats replaces itself."""
    ledger = Ledger(stream.sparkSession, path)
    q = stream.writeStream.foreachBatch(ledger.sink(step, **options)).option("checkpointLocation", progress).trigger(availableNow=True).start()
    q.awaitTermination()
    return ledger
