"""Merkle manifest of a table: a digest per row, a tree per group of rows, a tree over the groups, and proofs by octopus multiproof.

A row's digest is its leaf. The leaves of a group stand in order; runs of FAN consecutive nodes hash to their parent until one is
left, the subroot; the subroots in order of their groups make the root the same way. Leaves are dealt in order of group and id, so
that their places come from the sizes of the partitions, and fall into blocks of FAN**DEEP consecutive ones. A block is a leaf
partition: it computes the coordinates of all nodes that the proofs of its leaves need and that it can't derive, each once, fetches
them in one join, derives the nodes that its proofs share, and expands the proof of each leaf locally.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, written

FAN, DEEP = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The most nodes of the upper levels that are sent to all executors; nodes of lower levels are fetched by a shuffled join.
SENT = 32_768
TOP = "/"  # the tree over the groups; a group is named by "" (null) or "=" and its value, which sorts as the values do, null first
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """The leaf of a row: hex SHA-256 of its values in a row, each `-` if null, else its bytes, `:` and itself."""
    one = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[one(v.cast("string")) for v in values]), 256)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sizes(n: int) -> list[int]:
    """The number of nodes on each level of a tree over n leaves, the root's level last."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def missing(held: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of the held leaves need, but that don't follow from these leaves: each once."""
    out = []
    for level, size in enumerate(sizes(n)[:-1]):
        parents = np.unique(held // FAN)
        run = (parents[:, None] * FAN + np.arange(FAN)).ravel()
        out += [(level, at) for at in np.setdiff1d(run[run < size], held).tolist()]
        held = parents
    return out


def steps(at: int, n: int) -> list[tuple[int, int]]:
    """(own place, width) of the run on each level on the way from a leaf to the root."""
    out = []
    for size in sizes(n)[:-1]:
        out.append((at % FAN, min(FAN, size - at // FAN * FAN)))
        at //= FAN
    return out


def fold(leaf: str, siblings: str, way: list[tuple[int, int]]) -> str:
    """The root that a leaf and its siblings give: all that who checks a row needs, besides the root."""
    node, at = leaf, 0
    for own, width in way:
        mid, end = at + 64 * own, at + 64 * (width - 1)
        node, at = sha(siblings[at:mid] + node + siblings[mid:end]), end
    return node


class Shared:
    """What a leaf partition knows of a tree: held leaves, fetched nodes, and the interiors that follow from both."""

    def __init__(self, n: int, held: list[int], leaves: list[str], fetched: list[tuple[int, int, str]]):
        self.sizes = sizes(n)
        self.level: list[dict[int, str]] = [{} for _ in self.sizes]
        for level, at, node in fetched:
            self.level[level][at] = node
        self.level[0].update(zip(held, leaves))
        self.above: dict[tuple[int, int], str] = {(len(self.sizes) - 1, 0): ""}
        at = sorted(held)
        for k in range(len(self.sizes) - 1):
            at = [p for p, _ in groupby(at, lambda x: x // FAN)]
            self.level[k + 1].update((p, sha("".join(self.run(k, p)))) for p in at)

    def run(self, level: int, parent: int) -> list[str]:
        return [self.level[level][x] for x in range(parent * FAN, min(parent * FAN + FAN, self.sizes[level]))]

    def root(self) -> str:
        return self.level[-1][0]

    def siblings(self, level: int, at: int) -> str:
        """The siblings of a node and of those above it, up to the root; what lies above a parent is joined once."""
        known = self.above.get((level, at))
        if known is None:
            run = self.run(level, at // FAN)
            del run[at % FAN]
            known = "".join(run) + self.siblings(level + 1, at // FAN)
            if level:
                self.above[level, at] = known
        return known


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with at, the place within the group, and n, the group's rows. The table is dealt by ranges of (group, order), so that a
    hot group lies in many partitions; what a partition holds of a group is counted, and the counts before it are summed."""
    dealt = rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
    dealt = written(dealt.withColumn("number", F.monotonically_increasing_id()), "dealt")
    part = F.shiftright("number", 33)  # a partition's rows are numbered in order
    counts = dealt.groupBy("group", part.alias("part")).agg(F.min("number").alias("low"), F.count("*").alias("size"))
    of = Window.partitionBy("group")
    before = F.coalesce(F.sum("size").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("group", "part", (before - F.col("low")).alias("shift"), F.sum("size").over(of).alias("n"))  # a row per partition and group
    found = dealt.withColumn("part", part).join(counts, ["group", "part"])
    return found.withColumn("at", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def blocks_of(rows: DataFrame, *columns: str) -> DataFrame:
    """(group, block, n, rows): runs of FAN**DEEP consecutive nodes at most, in order."""
    block = F.shiftright("at", 3 * DEEP).alias("block")
    return rows.groupBy("group", block, "n").agg(F.sort_array(F.collect_list(F.struct("at", *columns))).alias("rows"))


def parents(blocks: DataFrame, level: int) -> DataFrame:
    """(group, level, at, n, node): the nodes of the DEEP levels above blocks of nodes of a level. n is the number of the tree's leaves."""

    def run(batches):
        for batch in batches:
            out = []
            for group, n, rows in zip(*(batch.column(k).to_pylist() for k in range(3))):
                at, nodes, size = rows[0]["at"], [r["node"].hex() for r in rows], -(-n // FAN**level)
                for up in range(1, DEEP + 1):
                    if size <= 1:
                        break
                    at, size = at // FAN, -(-size // FAN)
                    nodes = [sha("".join(nodes[x : x + FAN])) for x in range(0, len(nodes), FAN)]  # a block starts at a multiple of its size
                    out += [(group, level + up, at + x, n, bytes.fromhex(node)) for x, node in enumerate(nodes)]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, kinds)], names=["group", "level", "at", "n", "node"])

    return blocks.select("group", "n", "rows").mapInArrow(run, "group string, level int, at long, n long, node binary")


def tree(blocks: DataFrame) -> DataFrame:
    """(group, level, at, n, node): the nodes above the leaves of all groups, in rounds of DEEP levels; a round is a table."""
    most = blocks.agg(F.max("n")).first()[0] or 0
    nodes, level = written(parents(blocks, 0), "nodes"), DEEP
    below = nodes
    while most > FAN**level:
        below = written(parents(blocks_of(below.where(F.col("level") == level), "node"), level), "nodes")
        nodes, level = nodes.union(below), level + DEEP
    return nodes


@dataclass
class Manifest:
    """blocks: (group, block, n, rows of at, id, node, claim) of the leaves; nodes: (group, level, at, n, node) above them and over the
    groups; tops: (group, place, groups, subroot); root: hex, null if the table is empty."""

    blocks: DataFrame
    nodes: DataFrame
    tops: DataFrame
    root: str | None


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS, claim: Column | None = None) -> Manifest:
    """The manifest of docs. claim: the digest of the row as somebody presents it, where it isn't the row itself (null: it is).

    Nulls have a digest of their own, a null group is a group and comes first, rows of a null id come first in their group. Rows of
    equal ids are ordered by their digests; equal rows are equal leaves, which may change places. Empty and long texts are digested
    whole, within Spark's expressions. An empty table has no root. Only the named columns are read.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    claimed = F.lit(None).cast("binary") if claim is None else F.unhex(claim)
    leaves = docs.select(name.alias("group"), F.col(id_col).cast("long").alias("id"), F.unhex(digest(*[F.col(c) for c in fields])).alias("node"), claimed.alias("claim"))
    leaves = written(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")  # so that equal rows are dealt to several partitions
    dealt = placed(leaves, ["id", "node", "tie"])
    blocks = written(blocks_of(dealt, "id", "node", "claim"), "blocks")
    for table in (leaves, dealt):
        delete(table)
    nodes = tree(blocks)
    alone = blocks.where("n = 1").select("group", F.col("rows")[0]["node"].alias("subroot"))
    peaks = nodes.where(F.col("n") <= F.pow(F.lit(float(FAN)), "level")).select("group", F.col("node").alias("subroot")).union(alone)
    dealt = placed(peaks.select(F.lit(TOP).alias("group"), F.col("group").alias("name"), F.col("subroot").alias("node")), ["name"])
    tops = written(dealt, "tops")
    delete(dealt)
    over = tree(written(blocks_of(tops, "node"), "blocks"))
    subroots = tops.select("group", F.lit(0).alias("level"), "at", "n", "node")
    found = over.union(subroots).where(F.col("n") <= F.pow(F.lit(float(FAN)), "level")).select("node").first()
    tops = tops.select(F.col("name").alias("group"), F.col("at").alias("place"), F.col("n").alias("groups"), F.col("node").alias("subroot"))
    return Manifest(blocks, nodes.union(over).union(subroots), tops, found["node"].hex() if found else None)


def upper(nodes: DataFrame) -> Column:
    """Which nodes are sent to all executors: of the trees of groups and of the tree over them the upper levels of SENT nodes at most.
    A node of a lower level is asked for by few of all blocks."""
    counts = nodes.groupBy((F.col("group") == TOP).alias("top"), "level").count().collect()  # a row per level
    chosen = F.lit(False)
    for top in (False, True):
        least, total = None, 0
        for r in sorted((r for r in counts if r["top"] == top), key=lambda r: -r["level"]):
            total += r["count"]
            if total > SENT:
                break
            least = r["level"]
        if least is not None:
            chosen = chosen | (((F.col("group") == TOP) == F.lit(top)) & (F.col("level") >= least))
    return chosen


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """(id, place, leaf, subroot, root, siblings, folded) of all leaves, or of those whose id is in wanted (id).

    siblings: the hex digests that prove the leaf, level by level, left to right. folded: the root that they give with the claim, or
    with the leaf where there is none. A block's wanted leaves are its leaf partition: what of the block isn't wanted is fetched too.
    """
    blocks, nodes = m.blocks, m.nodes
    if wanted is not None:
        leaf = m.blocks.select("group", "n", "block", F.explode("rows").alias("r")).select("group", "n", "block", "r.*")
        chosen = leaf.join(wanted.select("id").distinct(), "id", "left_semi")
        blocks = written(chosen.groupBy("group", "block", "n").agg(F.sort_array(F.collect_list(F.struct("at", "id", "node", "claim"))).alias("rows")), "wanted")
        nodes = nodes.union(leaf.select("group", F.lit(0).alias("level"), "at", "n", "node"))

    def ask(batches):
        for batch in batches:
            out = []
            for group, block, n, held, place, groups in zip(*(batch.column(k).to_pylist() for k in range(6))):
                out += [(group, block, group, *x) for x in missing(np.array(held), n)]
                out += [(group, block, TOP, *x) for x in missing(np.array([place]), groups)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, kinds)], names=["group", "block", "tree", "level", "at"])

    def expand(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n, place, groups, rows, fetched = (batch.column(k)[i].as_py() for k in range(5))
                nodes = [(f["tree"] == TOP, f["level"], f["at"], f["node"].hex()) for f in fetched or ()]
                own = Shared(n, [r["at"] for r in rows], [r["node"].hex() for r in rows], [x[1:] for x in nodes if not x[0]])
                over = Shared(groups, [place], [own.root()], [x[1:] for x in nodes if x[0]])
                end, way = over.siblings(0, place), steps(place, groups)
                for start in range(0, len(rows), 512):
                    out = []
                    for r in rows[start : start + 512]:
                        leaf, siblings = r["node"].hex(), own.siblings(0, r["at"]) + end
                        claim = r["claim"].hex() if r["claim"] is not None else leaf
                        out.append((r["id"], r["at"], leaf, own.root(), over.root(), siblings, fold(claim, siblings, steps(r["at"], n) + way)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.string()] * 5))], names=["id", "place", "leaf", "subroot", "root", "siblings", "folded"])

    held = blocks.select("group", "block", "n", F.col("rows.at").alias("held")).join(m.tops, "group")
    asked = held.select("group", "block", "n", "held", "place", "groups").mapInArrow(ask, "group string, block long, tree string, level int, at long")
    sent = upper(m.nodes)
    given = nodes.select(F.col("group").alias("tree"), "level", "at", "node", sent.alias("sent"))
    on = ["tree", "level", "at"]
    got = asked.join(F.broadcast(given.where("sent").drop("sent")), on)  # SENT nodes of either kind of tree at most
    if not given.where("not sent").isEmpty():
        got = got.union(asked.join(given.where("not sent").drop("sent"), on).select(got.columns))
    got = got.groupBy("group", "block").agg(F.collect_list(F.struct("tree", "level", "at", "node")).alias("fetched"))
    whole = blocks.join(got, ["group", "block"], "left").join(m.tops, "group")
    return whole.select("n", "place", "groups", "rows", "fetched").mapInArrow(expand, "id long, place long, leaf string, subroot string, root string, siblings string, folded string")


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose text's A-Z were lower-cased, where 3 divides the CRC-32 of its id; else null."""
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, digest(*changed))
