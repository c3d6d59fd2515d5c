"""Embedding near-duplicates by a forest of random-projection trees.

Each tree splits the vectors at the median of a random projection, again and again, into small leaves; vectors near a split go down
both sides (spill). Only vectors of one label that share a leaf of some tree are compared, in blocks inside tasks, by cosine in double precision. A pair
that shares several leaves counts in the smallest one. Links are unioned into components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, written

BLOCK = 768


class Forest:
    """Trees over n vectors, of leaves of about `leaf` vectors at every n. A tree has a random direction per level. The thresholds of the
    upper levels are fitted node by node on the sample, until a node has 16 of its vectors; further down a node takes those of the
    vectors of its fitted ancestor, on the level's direction."""

    def __init__(self, sample: np.ndarray, n: float, trees: int, leaf: int, spill: float):
        self.depth = max(0, math.ceil(math.log(max(n, 1) / leaf) / math.log(2 / (1 + 2 * spill))))
        self.fitted = min(self.depth, max(0, math.floor(math.log2(max(len(sample), 16) / 16))))
        self.trees = [self._fit(sample, spill, np.random.default_rng(seed)) for seed in range(trees)]

    def _fit(self, sample: np.ndarray, spill: float, rng: np.random.Generator) -> tuple[np.ndarray, list[np.ndarray]]:
        directions = rng.standard_normal((self.depth, sample.shape[1])).astype(np.float32)
        p, node, bounds = sample @ directions.T, np.zeros(len(sample), np.int64), []
        for level in range(self.depth):
            size = 2 ** min(level, self.fitted)
            found = np.zeros((size, 3), np.float32)
            order = np.argsort(node, kind="stable")
            for k, rows in enumerate(np.split(order, np.searchsorted(node[order], np.arange(1, size)))):
                if len(rows):
                    found[k] = np.quantile(p[rows, level], [0.5 - spill, 0.5, 0.5 + spill])
            bounds.append(found)
            if level < self.fitted:
                node = 2 * node + (p[:, level] > found[node, 1])
        return directions, bounds

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each vector and each leaf it belongs to, of all trees. A vector near a split goes down both sides."""
        out = []
        for t, (directions, bounds) in enumerate(self.trees):
            p, rows, nodes = x @ directions.T, np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                low, _, high = bounds[level][nodes >> max(0, level - self.fitted)].T
                at = p[rows, level]
                left, right = at <= high, at >= low
                rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
            out.append((rows, nodes | t << 48))
        return tuple(np.concatenate(x) for x in zip(*out))


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of one width, of length 1; shorter ones end with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def compare(leaf: int, whole: bool, ids: np.ndarray, block: np.ndarray, mult: np.ndarray, vec: pa.ListArray, leaves: pa.ListArray, width: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links to other vectors that count here, smallest member reached) of the members of a cell: one block (whole) or two."""
    order = np.argsort(ids)
    ids, block, mult = ids[order], block[order], mult[order]
    x = padded(vec.take(pa.array(order)), width)
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    counted = linked if whole else linked & (block[:, None] != block[None, :])
    a, b = np.nonzero(np.triu(counted))
    links = np.zeros(len(ids), np.int64)
    if len(a):
        sizes = leaves.value_lengths().to_numpy()
        every = np.full((len(ids), int(sizes.max())), np.iinfo(np.int64).max)
        every[np.arange(every.shape[1])[None, :] < sizes[:, None]] = leaves.flatten().to_numpy()
        every = np.sort(every, axis=1)[order]
        for lo in range(0, len(a), 100_000):
            p, q = a[lo : lo + 100_000], b[lo : lo + 100_000]
            first = np.full(len(p), -1)
            for s in range(every.shape[1]):  # the smallest leaf that both have
                open_ = np.flatnonzero(first < 0)
                if not len(open_):
                    break
                value = every[p[open_], s]
                same = (every[q[open_]] == value[:, None]).any(axis=1) & (value != np.iinfo(np.int64).max)
                first[open_[same]] = value[same]
            own = first == leaf
            np.add.at(links, p[own], mult[q[own]])
            np.add.at(links, q[own], mult[p[own]])
    return ids, links, ids[forest(linked)]


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.93, trees: int = 4, spill: float = 0.06, leaf: int = 64, sample: int = 20_000) -> DataFrame:
    """(id_col, n_links, component_id, kept) of each vector.

    The trees are fitted on about `sample` vectors at most; every vector is indexed. Trees are so deep that a leaf has about
    `leaf` vectors of a label at every size of the table. Equal vectors of a label are one vector with its number of copies. Vectors whose
    label is null, and null, empty or zero ones or ones with null or non-finite components, link with nothing; so do vectors of
    different lengths. Each row counts as a vector, of repeated ids too. An empty table gives an empty one; other columns of the
    table, whatever their names, are not read.
    """
    finite = F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fit_for = F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite & F.exists(vec_col, lambda v: v != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"), F.coalesce(fit_for, F.lit(False)).alias("ok"))
    alike = written(rows.where("ok").groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("mult")), "vectors")
    by_label = alike.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("width"))
    found = by_label.agg(F.sum("n").alias("n"), F.max("width").alias("width"), F.sum(F.pow("n", F.lit(2)) / 1.0).alias("squares")).first()
    n, width = found["n"] or 0, found["width"] or 1
    rivals = (found["squares"] or 0) / max(n, 1)  # how many vectors have a vector's label, on the average
    share = min(1.0, sample / max(n, 1))
    chosen = alike.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20))).select("vec").limit(2 * sample).toArrow()["vec"].combine_chunks()
    x = padded(chosen, width).astype(np.float32) if len(chosen) else np.zeros((0, width), np.float32)
    shared = table.sparkSession.sparkContext.broadcast(Forest(x, rivals, trees, leaf, spill))  # of the size of the bounded sample

    def route(batches):
        for batch in batches:
            v = padded(batch.column(2), width).astype(np.float32)
            rows, nodes = shared.value.leaves(v)
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(v)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(nodes[np.argsort(rows, kind="stable")]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["label", "id", "vec", "mult", "leaves"])

    label, vec = (alike.schema[c].dataType.simpleString() for c in ("label", "vec"))
    routed = alike.select("label", F.col("rep").alias("id"), "vec", "mult").mapInArrow(route, f"label {label}, id long, vec {vec}, mult long, leaves array<long>")
    placed = written(routed.withColumn("leaf", F.explode("leaves")).withColumn("size", F.size("vec")), "leaves")
    keys = ["label", "size", "leaf"]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"))
    member = placed.join(counts, keys).withColumn("bl", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = member.groupBy(*keys, F.least("bl", "other").alias("i"), F.greatest("bl", "other").alias("j")).agg(*[F.collect_list(c).alias(c) for c in ("id", "bl", "vec", "mult", "leaves")])

    def links(batches):
        for batch in batches:
            for cell in range(batch.num_rows):
                leaf_, i, j = (batch.column(k)[cell].as_py() for k in range(3))
                ids, block, vec, mult, leaves = (batch.column(k)[cell].values for k in range(3, 8))
                ids, n_links, low = compare(leaf_, i == j, ids.to_numpy(), block.to_numpy(), mult.to_numpy(), vec, leaves, width, least)
                hit = (n_links > 0) | (ids != low)
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(n_links[hit]), pa.array(low[hit])], names=["id", "n", "low"])

    met = written(cells.select("leaf", "i", "j", "id", "bl", "vec", "mult", "leaves").mapInArrow(links, "id long, n long, low long"), "links")
    group = components(met.select(F.col("id").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep")
    degree = met.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n"))
    named = alike.join(degree, "rep", "left").join(group, "rep", "left").select(F.col("label").alias("label_"), F.col("vec").alias("vec_"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    out = rows.join(named, F.col("ok") & (F.col("label") == F.col("label_")) & (F.col("vec") == F.col("vec_")), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
