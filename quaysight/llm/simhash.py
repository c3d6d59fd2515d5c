"""SimHash near-duplicates by a generalised pigeonhole search.

A document's fingerprint has the majority bits of the XXH64 hashes of its word shingles. To find all pairs of fingerprints
that differ in at most tau bits, the 64 bits are grouped into m parts (bits that go together share a part) and part i gets a
threshold t_i >= -1 with sum(t_i) = tau - m + 1: a pair within tau bits then differs in at most t_i bits in some part. The
number of parts and the thresholds are those of least estimated cost, found by dynamic programming over the parts on
estimated candidate counts. A part is probed by keys that grow linearly with its width: its value (t = 0), the value and, for
values of odd parity, its one-bit neighbours (t = 1), or the value and all its one-bit neighbours (t = 2). Pairs that meet in
a bucket are verified on the whole fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, bit_filter, bits_for, components, forest, in_filter, near_sets, slices, texts, written

SEED = 42
#: Keys of so many times the usual members are not joined with themselves.
COLD = 64
#: MinHash bands that meet a similarity of 0.8 with a chance of 1 - (1 - 0.8**ROWS)**BANDS = 0.9996.
BANDS, ROWS = 20, 5
MIX = 0x9E3779B97F4A7C15
_FACTORS = np.random.default_rng(SEED).integers(1, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of each k-word shingle; a shorter text is one shingle, a text without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64 majority bits of the hashes; a bit is 1 if it is set in over half of them."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def spread(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Further independent hashes from the first ones."""
    x = (hashes + np.uint64(MIX * lane % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long) of each document. Null and wordless texts get fingerprint 0."""

    def run(batches):
        for batch in slices(batches):
            fps = [majority(shingle_hashes(text, words)) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id long, fp long")


def set_name(shingles: np.ndarray) -> int:
    """The name of a sorted set of shingle hashes."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of BANDS MinHash bands of ROWS values each; a permutation of the hashes is a product with an odd number."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[i : i + 512, None] * _FACTORS).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        keys = spread(keys ^ row, 1)
    return keys


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, name, fp, keys array<long>): the name of each document's shingle set, its fingerprint and its band keys."""

    def run(batches):
        for batch in slices(batches):
            names, fps, keys = [], [], []
            for text in texts(batch):
                h = shingle_hashes(text, words)
                one = np.unique(h)
                names.append(set_name(one))
                fps.append(majority(h))
                keys.append(band_keys(one))
            long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) * BANDS + 1, BANDS, dtype=np.int32)), long(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column(0), long(names), long(fps), lists], names=["id", "name", "fp", "keys"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id long, name long, fp long, keys array<long>")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """(name, item array<long>): the sorted shingle hashes of the wanted sets (name, id of a document)."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, "id", bits_for(wanted.count())))  # of a bounded size

    def run(batches):
        for batch in batches:
            some = batch.filter(pa.array(in_filter(shared.value, batch.column(0).fill_null(0).to_numpy())))
            for part in slices([some]):
                sets = [np.unique(shingle_hashes(text, words)) for text in texts(part)]
                names = np.array([set_name(x) for x in sets], np.uint64).view(np.int64)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), items], names=["id", "name", "item"])

    found = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id long, name long, item array<long>")
    return found.join(wanted, ["name", "id"], "left_semi").select("name", "item")


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """Sums of products of the fingerprints' bits as -1 and 1, with a 65th bit that is always 1."""

    def run(batches):
        gram, n = np.zeros((65, 65)), 0
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
            one = np.hstack([bits, np.ones((len(bits), 1), np.float32)])
            gram += one.T @ one
            n += len(bits)
        if n:
            rows, cols = np.indices(gram.shape)
            yield pa.RecordBatch.from_arrays([pa.array((rows * 65 + cols).ravel().astype(np.int32)), pa.array(gram.ravel())], names=["k", "s"])

    found = fps.select("fp").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).toArrow()  # 65 x 65 rows
    gram = np.zeros(65 * 65)
    gram[found["k"].to_numpy()] = found["s"].to_numpy()
    return gram.reshape(65, 65)


def grouped(gram: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m parts of near-equal width, each grown from a free bit by the free bit that correlates most with the part."""
    n = max(gram[-1, -1], 1)
    mean = gram[:64, -1] / n
    sd = np.sqrt(np.maximum(1 - mean**2, 1e-9))
    corr = np.abs((gram[:64, :64] / n - np.outer(mean, mean)) / np.outer(sd, sd))
    free, parts = set(range(64)), []
    for i in range(m):
        width = (64 - sum(map(len, parts))) // (m - i)
        part = [min(free)]
        free.discard(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: corr[b, part].sum())
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def allocate(gram: np.ndarray, tau: int, most_parts: int = 5) -> list[tuple[int, int]]:
    """(bit mask, threshold) of each part that is probed, of the least estimated cost: keys written plus candidate pairs."""
    n = max(gram[-1, -1], 1)
    p = (1 + gram[:64, -1] / n) / 2
    agree = np.clip(p**2 + (1 - p) ** 2, 0.5, 1 - 1e-12)
    best: tuple[float, list[tuple[int, int]]] | None = None
    for m in range(1, most_parts + 1):
        parts, goal = grouped(gram, m), tau - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in parts:
            a = agree[bits]
            odds = (1 - a) / a
            one, two = odds.sum(), (odds.sum() ** 2 - (odds**2).sum()) / 2
            near = np.prod(a) * np.array([1, 1 + one, 1 + one + two])  # chance that two fingerprints are within 0, 1, 2 bits here
            keys = [1, 1 + len(bits) / 2, 1 + len(bits)]
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in table.items():
                for t in (-1, 0, 1, 2):
                    c = cost + (n * keys[t] + n * (n - 1) / 2 * near[t] if t >= 0 else 0)
                    if used + t not in new or c < new[used + t][0]:
                        new[used + t] = (c, [*chosen, t])
            table = new
        if goal in table and (best is None or table[goal][0] < best[0]):
            cost, chosen = table[goal]
            best = (cost, [(sum(1 << b for b in bits), t) for bits, t in zip(parts, chosen) if t >= 0])
    if best is None:
        raise ValueError(f"no allocation for tau={tau}")
    return best[1]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts_of(fps: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """(part, own, fp, id): the value of each fingerprint in each part."""
    own = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("own")) for i, (mask, _) in enumerate(plan)]
    return fps.select("fp", "id", F.explode(F.array(*own)).alias("k")).select("k.part", "k.own", "fp", "id")


def keyed(values: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """values (part, own, ...) with a row for each key `val` of the value: equal keys mean at most t bits apart in the part."""
    own, vals = F.col("own"), None
    for i, (mask, t) in enumerate(plan):
        near = F.array(own, *[own.bitwiseXOR(F.lit(signed(1 << b))) for b in range(64) if mask >> b & 1])
        keys = F.array(own) if t == 0 else near if t == 2 else F.when(F.bit_count(own) % 2 == 1, near).otherwise(F.array(own))
        here = F.col("part") == i
        vals = F.when(here, keys) if vals is None else vals.when(here, keys)
    return values.withColumn("val", F.explode(vals))


def links(parts: DataFrame, plan: list[tuple[int, int]], tau: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of ids that share a key of few members and have at most tau differing bits; and (part, own, cluster) of the values
    under keys of many members, whose pairs are left out. Values that share such a key are in one cluster.

    A key has many members if they are over COLD times what they would be, were all keys alike. Members are counted by value, so that
    copies of a value weigh nothing.
    """
    values = parts.groupBy("part", "own").agg(F.count("*").alias("m"))
    sizes = keyed(values, plan).groupBy("part", "val").agg(F.sum("m").alias("n"), F.min("own").alias("low"))
    widths = [mask.bit_count() for mask, _ in plan]
    usual = F.greatest(F.lit(1.0), F.avg("n"))
    even = {r["part"]: r["usual"] for r in sizes.groupBy("part").agg(usual.alias("usual")).collect()} if min(widths) < 40 else {}
    limit = F.lit(float(COLD))
    for part, mean in sorted(even.items()):
        limit = F.when(F.col("part") == part, COLD * mean).otherwise(limit)
    hot = written(sizes.where(F.col("n") > limit).select("part", "val", "low"), "hot")
    keys = keyed(parts, plan)
    cold = keys.join(hot.select("part", "val"), ["part", "val"], "left_anti")
    left, right = (cold.select(F.col("part").alias(f"part_{x}"), F.col("val").alias(f"val_{x}"), F.col("fp").alias(f"fp_{x}"), F.col("id").alias(x)) for x in "ab")
    close = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= tau
    met = left.join(right, (F.col("part_a") == F.col("part_b")) & (F.col("val_a") == F.col("val_b")) & (F.col("a") < F.col("b")) & close)
    if hot.isEmpty():
        return met.select("a", "b"), hot.select("part", F.col("val").alias("own"), F.col("low").alias("cluster"))
    name = lambda c: F.xxhash64("part", c)
    under = keyed(values, plan).join(hot, ["part", "val"]).select("part", "own", name("own").alias("a"), name("low").alias("b")).distinct()
    under = written(under, "under")
    same = components(under)
    clusters = under.select("part", "own", F.col("a").alias("node")).distinct().join(same, "node", "left").select("part", "own", F.coalesce("component", "node").alias("cluster"))
    return met.select("a", "b"), written(clusters, "clusters")


def stars(fps: DataFrame) -> DataFrame:
    """Links (a, b) within two bits among fingerprints. They are keyed by themselves and their one-bit neighbours: all that share
    such a key are within two bits of each other, so that a link to the smallest of them is enough."""
    variants = keyed(fps.select(F.lit(0).alias("part"), F.col("fp").alias("own"), "id"), [((1 << 64) - 1, 2)])
    centres = variants.groupBy("val").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("val", "a")
    return variants.join(centres, "val").select("a", F.col("id").alias("b")).where("a < b")


def cluster_links(parts: DataFrame, clusters: DataFrame, tau: int) -> DataFrame:
    """Links (a, b) of fingerprints at most tau bits apart among the members of each cluster, block by block in tasks."""
    member = parts.join(clusters, ["part", "own"]).select("part", "cluster", "fp", "id")
    blocks = member.groupBy("part", "cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    m = member.join(blocks, ["part", "cluster"]).withColumn("bl", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = m.groupBy("part", "cluster", F.least("bl", "other").alias("i"), F.greatest("bl", "other").alias("j")).agg(F.collect_list(F.struct("id", "fp")).alias("members"))

    def run(batches):
        for batch in batches:
            for cell in batch.column(0):
                ids, fps = (cell.values.field(k).to_numpy() for k in (0, 1))
                low = forest(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= tau)
                apart = np.flatnonzero(low != np.arange(len(low)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[low[apart]]), pa.array(ids[apart])], names=["a", "b"])

    return cells.select("members").mapInArrow(run, "a long, b long")


def near_fingerprints(distinct: DataFrame, tau: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp, and id, which is the same) that connect all that differ in at most tau bits."""
    plan = allocate(bit_statistics(distinct), tau)
    parts = parts_of(distinct, plan)
    near, clusters = links(parts, plan, tau)
    if clusters.isEmpty():
        return near
    # Stars hold for two bits; for another radius the members of large keys are compared block by block.
    return near.union(stars(parts.join(clusters, ["part", "own"], "left_semi").select("fp", "id").distinct()) if tau == 2 else cluster_links(parts, clusters, tau))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, tau: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id) of each document: documents link if their fingerprints differ in at most tau bits.

    Null, empty and wordless texts share fingerprint zero and link with each other. Repeated ids, ties and copies are one
    fingerprint each; an empty table gives an empty table; a very long text is one task's work and its memory grows with it;
    columns besides the two named are not read, so their names can't clash.
    """
    fps = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    alike = fps.groupBy("fp").agg(F.min("id").alias("first"))
    found = components(near_fingerprints(alike.select("fp", F.col("fp").alias("id")), tau))
    named = alike.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, tau: int = 2, least: float = 0.8) -> DataFrame:
    """docs without near-duplicates: of each group the document of the smallest id stays.

    Documents link if the exact Jaccard similarity of their five-word shingles is `least` or more. Candidates are documents whose
    fingerprints the pigeonhole search connects within tau bits, and, as a similarity of 0.8 leaves 64-bit fingerprints some ten bits
    apart, documents that share one of BANDS MinHash bands. Texts without words (null and empty ones too) are alike. Rows of one
    id stay or go together; copies and ties need no comparison; rows whose id is null stay. Columns and their names don't matter
    besides the two named.
    """
    found = written(signatures(docs.where(F.col(id_col).isNotNull()), id_col, text_col, words), "fingerprints")
    alike = written(found.groupBy("name").agg(F.min("id").alias("id"), F.min("fp").alias("fp"), F.min("keys").alias("keys")), "sets")
    # Of the sets of one fingerprint the smallest stands for all.
    same = alike.groupBy("fp").agg(F.min("name").alias("first"))
    near = written(near_fingerprints(same.select("fp", F.col("fp").alias("id")), tau), "near")
    first = lambda x: same.select(F.col("fp").alias(x), F.col("first").alias(f"{x}_name"))
    across = near.join(first("a"), "a").join(first("b"), "b").select(F.col("a_name").alias("a"), F.col("b_name").alias("b"))
    within = alike.join(same, "fp").where("name != first").select(F.col("first").alias("a"), F.col("name").alias("b"))
    group = near_sets(alike, lambda wanted: shingle_sets(docs, id_col, text_col, words, wanted), least, across.union(within))
    named = alike.select("name", "id").join(group.withColumnRenamed("node", "name"), "name", "left")
    kept = named.groupBy(F.coalesce("component", "name")).agg(F.min("id").alias("id")).select("id")
    # Ids are compared first and the rest written, so that texts needn't be shuffled where few ids go.
    gone = written(found.select("id").join(kept, "id", "left_anti").select(F.col("id").alias(id_col)).distinct(), "gone")
    return docs.join(gone, id_col, "left_anti")
