"""Helpers that the corpus operators share: shared tables, bounded Arrow slices, bit filters, links of similar sets, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: About how many members of a key are compared with as many others inside one task; larger groups are split into blocks.
BLOCK = 1024
#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}
#: Tables that written() made and that still stand, in order.
_STANDING: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session without it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="quaysight-")
    return _LOCAL[context.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _STANDING.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def delete(df: DataFrame) -> None:
    """Removes a table that written() made and that nothing reads any more."""
    for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, root)
        _STANDING[:] = [p for p in _STANDING if p.rsplit("/", 1)[-1] != root.rsplit("/", 1)[-1]]


def standing() -> int:
    """How many tables of written() stand: a mark for release()."""
    return len(_STANDING)


def release(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Removes the tables that were written after a mark, once what was computed from them has been saved; `keep` is a table that stays."""
    kept = {f.rsplit("/", 2)[-2] for f in keep.inputFiles()} if keep is not None else set()
    if keep is not None and not kept:
        raise ValueError("the table that stays must have been written")
    for path in _STANDING[since:]:
        if path.rsplit("/", 1)[-1] not in kept:
            _remove(spark, path)
    _STANDING[since:] = [p for p in _STANDING[since:] if p.rsplit("/", 1)[-1] in kept]


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, most: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that a slice holds about `most` bytes of the given text column, or one row. After the last one, memory
    that Arrow keeps goes back, since workers outlive their tasks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


def texts(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def bit_filter(hashes: DataFrame, column: str, log2_bits: int = 22) -> np.ndarray:
    """A bitmap of 2**log2_bits bits with one bit set for each hash. Its size is fixed, however many hashes there are."""
    place = F.col(column).bitwiseAND((1 << log2_bits) - 1)
    words = hashes.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    found = words.toArrow()  # 2**(log2_bits - 6) rows at most
    bits = np.zeros(1 << (log2_bits - 6), dtype=np.int64)
    bits[found["w"].to_numpy()] = found["b"].to_numpy()
    return bits


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.int64(len(bits) * 64 - 1)
    return (bits[place >> 6] >> (place & 63)) & 1 > 0


def forest(linked: np.ndarray) -> np.ndarray:
    """The smallest member that each member of a symmetric link matrix reaches."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bits_for(n: int) -> int:
    """log2 of the bits of a filter for n hashes: about eight bits a hash, from 2**22 to 2**27 bits (16 MB)."""
    return min(27, max(22, (8 * max(n, 1) - 1).bit_length()))


def passing(rows: DataFrame, keys: str, bits: np.ndarray) -> DataFrame:
    """The rows whose array column `keys` has a member in the filter. Rows without keys go."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)  # of a bounded size

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            sizes = pc.fill_null(column.value_lengths(), 0).to_numpy()
            hit = np.concatenate([[0], np.cumsum(in_filter(shared.value, column.flatten().to_numpy()))])
            ends = np.cumsum(sizes)
            yield batch.filter(pa.array(hit[ends] > hit[ends - sizes]))

    at = rows.columns.index(keys)
    return rows.mapInArrow(run, rows.schema)


def similar(items: list, least: float) -> np.ndarray:
    """Which sets of distinct hashes have a Jaccard similarity of at least `least`."""
    size = np.array(list(map(len, items)))
    _, column, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    row, several = np.repeat(np.arange(len(items)), size), count > 1
    shared = several[column]
    row, column = row[shared], (np.cumsum(several) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(items), len(items)))
    for start in range(0, int(several.sum()), 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        has = np.zeros((len(items), 4096), np.float32)
        has[row[lo:hi], column[lo:hi] - start] = 1
        both += has @ has.T
    return both >= least * (size[:, None] + size[None, :] - both) - 1e-9


def alike_in_keys(members: DataFrame, sizes: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between sets of one key and different components, without rows for all pairs.

    members has key, name, component and item (array of hashes); sizes has key, main (the component that most members are in), n
    and hashes (of all the members' sets together). What isn't in the main component is compared with all members. Members are
    dealt to blocks so that a cell has about `block` sets and 2**20 hashes on either side; per cell a spanning forest comes out.
    """
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("hashes") / (1 << 20))).cast("int")
    m = members.join(sizes.select("key", "main", blocks.alias("nb")), "key").withColumn("bl", F.pmod(F.xxhash64("name"), F.col("nb")).cast("int"))
    every = F.sequence(F.lit(0), F.col("nb") - 1)
    rest = m.where("component != main")
    others = rest.select("key", F.col("bl").alias("j")).distinct()
    left = m.join(others, "key").select("key", F.col("bl").alias("i"), "j", "name", "item")
    right = rest.select("key", F.explode(every).alias("i"), F.col("bl").alias("j"), "name", "item").where("i != j")
    cells = left.union(right).groupBy("key", "i", "j").agg(F.sort_array(F.collect_list(F.struct("name", "item"))).alias("members"))

    def links(batches):
        for batch in batches:
            a, b = [], []
            for cell in batch.column(0):
                names, items = cell.values.field(0).to_numpy(), cell.values.field(1)
                ends = items.offsets.to_numpy()
                flat = items.values.to_numpy()
                low = forest(similar([flat[x:y] for x, y in zip(ends[:-1], ends[1:])], least))
                apart = np.flatnonzero(low != np.arange(len(low)))
                a.append(names[low[apart]])
                b.append(names[apart])
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x + none)) for x in (a, b)], names=["a", "b"])

    few = cells.where(F.size("members") > 1).select("members")
    return few.mapInArrow(links, "a long, b long")


def near_sets(named: DataFrame, sets: Callable[[DataFrame], DataFrame], least: float, more: DataFrame | None = None) -> DataFrame:
    """(node, component) of the sets that link: they share a key, and their exact Jaccard similarity is `least` or more.

    named has a row for each set, with name (of its content), id (of a document that has it) and keys (array<long>); sets(wanted)
    gives (name, item array<long>) of the sets in wanted (name, id). `more` has further candidates (a, b). Each set is first compared with the smallest one under
    each of its keys, which takes rows in proportion to the keys; only under keys of three sets or more that lie in several
    components by then, the sets outside the largest are compared with all, block by block. So no pair that shares a key is lost.
    """
    keyed = named.select("name", F.explode("keys").alias("key")).distinct()
    multi = keyed.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("z"), F.count("*").alias("n")).where("a != z")
    multi = written(multi.select("key", "a", "n"), "keys")
    some = passing(named.select("name", "keys"), "keys", bit_filter(multi, "key", bits_for(multi.count())))
    under = written(some.select("name", F.explode("keys").alias("key")).distinct().join(multi, "key"), "under")
    pairs = under.where("a != name").select("a", F.col("name").alias("b"))
    pairs = written((pairs if more is None else pairs.union(more.select("a", "b"))).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    items = written(sets(written(named.select("name", "id").join(wanted, "name", "left_semi"), "wanted")), "items")
    a, b = (items.select(F.col("name").alias(x), F.col("item").alias(f"item_{x}")) for x in "ab")
    both = F.size(F.array_intersect("item_a", "item_b"))
    close = both >= least * (F.size("item_a") + F.size("item_b") - both) - 1e-9
    first = written(pairs.join(b, "b").join(a, "a").where(close).select("a", "b"), "links")
    delete(pairs)
    group = components(first)
    # Keys whose sets lie in several components still: those of two sets are settled.
    of = F.coalesce("component", "name").alias("component")
    placed = under.where("n > 2").join(group.withColumnRenamed("node", "name"), "name", "left").select("key", "name", of)
    counted = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = counted.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("several")).where("several > 1")
    placed = placed.join(written(mixed.select("key", "main"), "mixed"), "key").join(items, "name")
    placed = written(placed.select("key", "name", "component", "main", "item"), "placed")
    sizes = placed.groupBy("key", "main").agg(F.count("*").alias("n"), F.sum(F.size("item")).alias("hashes"))
    second = written(alike_in_keys(placed.drop("main"), sizes, least), "links")
    if not second.isEmpty():
        group = components(first.union(second))
    for table in (multi, under, items, placed):
        delete(table)
    return group


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps: (node, component), component the smallest node.

    Nodes without an edge aren't returned. Each round is written to the shared folder; the number of rounds grows with the
    logarithm of the longest path.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges")
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        star = small.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u > v").distinct()
        new = written(star, "edges")
        delete(e)
        e = new
        if e.groupBy("u").count().where("count > 1").isEmpty() and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
