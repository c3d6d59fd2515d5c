"""Substring dedup: MinHash banding over paragraphs, and equal runs of words that lie anywhere.

Texts fall into paragraphs at line ends. A paragraph is MinHashed whole, with all its five-word shingles: with BANDS bands of ROWS
values a similarity of 0.8 is met with a chance of 1 - (1 - 0.8**3)**10 = 0.9992; those that collide in a band are compared by the
exact Jaccard similarity of their shingles, and linked ones form components. Besides, a document's words, across line ends, give
units of LEAST words: of each REACH + 1 consecutive places the one whose shingle has the smallest hash. That depends on the words of
the place only, so that two texts that share SPAN = LEAST + REACH words share a unit in them.

A shared run of SPAN words lies within REACH words of its unit. So a unit is counted with the words up to REACH before and behind
it, its surroundings. Where a unit has one kind of surroundings, all of them are shared; where it has several, the windows of SPAN
words in each kind are counted too, each under the smallest of its units. What comes out is exact: the words of each shared run of
SPAN or more.

Of a component, or of a window, the smallest document keeps its words; in the others they are repeats. This is decided word by word:
a word belongs to the smallest document that has one of the paragraphs (to 0.8) or windows that it lies in. What a near copy of a
paragraph says otherwise goes with the paragraph.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, bits_for, delete, in_filter, near_sets, slices, texts, written
from .simhash import spread
from .winnow import gram_hashes, winnowed, word_hashes

LEAST, SPAN, K = 40, 50, 5
REACH = SPAN - LEAST
BANDS, ROWS = 10, 3
_FACTORS = np.random.default_rng(K).integers(1, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def places(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where units start, a hash of each place by which they are chosen). doc: where each document starts, and the end of the last one."""
    if len(hashes) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (spread(gram_hashes(hashes, K).view(np.uint64), 7) >> np.uint64(1)).view(np.int64)[: len(hashes) - LEAST + 1]
    at = np.flatnonzero(winnowed(mixed, REACH + 1))
    return at[at + LEAST <= doc[np.searchsorted(doc, at, side="right").clip(max=len(doc) - 1)]], mixed


def led(mixed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) words before each place with which a window of REACH + 1 places has the place as its first smallest one."""
    left, right = np.full(len(at), REACH + 1), np.full(len(at), REACH + 1)
    for j in range(REACH, 0, -1):
        left[mixed[np.maximum(at - j, 0)] <= mixed[at]] = j
        right[mixed[np.minimum(at + j, len(mixed) - 1)] < mixed[at]] = j
    return REACH + 1 - right, left - 1


def names_of(grams: np.ndarray, at: np.ndarray, size: int, seed: np.ndarray | int, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
    """A hash of the `size` words from each place on, from the shingles that lie end to end in them; where lo and hi are given, of what
    of them lies between these places."""
    h = spread(np.zeros(len(at), np.uint64) + np.uint64(size), 3) ^ np.asarray(seed).astype(np.uint64)
    for i in range(0, size - K + 1, K):
        x = at + i
        h = spread(h ^ grams[x if lo is None else np.clip(x, lo, hi - K)], i + 1)
    return h.view(np.int64)


def band_keys(grams: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The band keys of the paragraphs whose shingles are grams[lo:hi]; a permutation of the hashes is a product with an odd number."""
    keys, edges = [], np.stack([lo, hi], axis=1).ravel()
    for b in range(BANDS):
        key = np.full(len(lo), 101 + b, np.uint64)
        for r in range(ROWS):
            mixed = np.append(grams * _FACTORS[b * ROWS + r], np.iinfo(np.uint64).max)
            key = spread(key ^ np.minimum.reduceat(mixed, edges)[::2], 5)
        keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


#: Sets of so many shingles or fewer are similar to 0.8 only if they are equal.
FEW = 3


def few_keys(grams: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A key of the set of shingles of each paragraph that has FEW at most, in any order and number."""
    sets = np.sort(grams[np.minimum(lo[:, None] + np.arange(FEW), hi[:, None] - 1)], axis=1)
    sets[:, 1:][sets[:, 1:] == sets[:, :-1]] = np.iinfo(np.uint64).max
    key = np.full(len(lo), 7, np.uint64)
    for column in np.sort(sets, axis=1).T:
        key = spread(key ^ column, 11)
    return key.view(np.int64)


def keys_of(grams: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys one paragraph after the other, their numbers): the bands of paragraphs of more than FEW shingles, else one key of the set; a
    paragraph that repeats FEW shingles at most has both."""
    many, number = hi - lo > FEW, np.ones(len(lo), np.int64)
    few = few_keys(grams, lo, np.minimum(hi, lo + FEW))  # of others overwritten below
    first = np.sort(grams[np.minimum(lo[:, None] + np.arange(FEW + 1), hi[:, None] - 1)], axis=1)
    odd = np.flatnonzero(many & (first[:, 1:] == first[:, :-1]).any(axis=1))
    both = np.zeros(len(lo), bool)
    for k in odd.tolist():
        own = np.unique(grams[lo[k] : hi[k]])
        if len(own) <= FEW:
            both[k] = True
            few[k] = few_keys(own, np.zeros(1, np.int64), np.array([len(own)]))[0]
    number[many] = BANDS + both[many]
    ends = np.cumsum(number)
    keys = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    keys[(ends - 1)[~many | both]] = few[~many | both]
    if many.any():
        at = (ends - number)[many]
        keys[(at[:, None] + np.arange(BANDS)).ravel()] = band_keys(grams, lo[many], hi[many]).ravel()
    return keys, number


class Slice:
    """Of a slice of documents: grams, the shingle hashes of all words; doc, where documents start; the units (at, name, around: a hash
    of the unit with its surroundings, before and behind: their words) and the paragraphs of at least `least` words (lo, hi of their
    shingles, name)."""

    def __init__(self, batch: pa.RecordBatch, least: int):
        words, para, doc = [], [0], [0]
        for text in texts(batch):
            for line in text.lower().split(b"\n"):
                if found := line.split():
                    words += found
                    para.append(len(words))
            doc.append(len(words))
        hashes, para, self.doc = word_hashes(words), np.array(para, np.int64), np.array(doc, np.int64)
        self.ids, self.grams = batch.column(0), gram_hashes(hashes, K).view(np.uint64)
        self.at, self.mixed = places(hashes, self.doc)
        of = self.of(self.at)
        lo, hi = self.doc[of], self.doc[of + 1]
        self.before, self.behind = np.minimum(self.at - lo, REACH), np.minimum(hi - self.at - LEAST, REACH)
        self.unit = names_of(self.grams, self.at, LEAST, 1)
        self.around = names_of(self.grams, self.at - REACH, SPAN + REACH, self.before * (REACH + 1) + self.behind, lo, hi)
        long = np.flatnonzero(np.diff(para) >= max(least, K))
        self.lo, self.hi = para[long], para[long + 1] - K + 1
        self.name = np.array([xxhash.xxh64_intdigest(self.grams[i:j].tobytes(), K) for i, j in zip(self.lo.tolist(), self.hi.tolist())], np.uint64).view(np.int64)

    def of(self, at: np.ndarray) -> np.ndarray:
        """The document of each place."""
        return np.searchsorted(self.doc, at, side="right") - 1

    def row(self, at: np.ndarray) -> pa.Array:
        return self.ids.take(pa.array(self.of(at)))


def _slices(batches, least: int):
    for batch in slices(batches, 1, 2_000_000):
        yield Slice(batch, least)


def unit_counts(docs: DataFrame, least: int) -> DataFrame:
    """(unit, around, before, behind, first, last, n): the smallest and the largest document and the number of places of each unit in each
    kind of surroundings, which have so many words before and behind the unit. Those that hold no window of SPAN words go."""

    def run(batches):
        for s in _slices(batches, least):
            room = np.flatnonzero(s.before + s.behind >= REACH)
            yield pa.RecordBatch.from_arrays([s.row(s.at[room]), *(pa.array(x[room]) for x in (s.unit, s.around, s.before.astype(np.int32), s.behind.astype(np.int32)))], names=["id", "unit", "around", "before", "behind"])

    return docs.mapInArrow(run, "id long, unit long, around long, before int, behind int").groupBy("unit", "around", "before", "behind").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))


def windows(docs: DataFrame, least: int, wanted: DataFrame) -> DataFrame:
    """(around, k, window): the names of the windows of SPAN words that start k words before the unit and have no unit before it in order,
    for the surroundings in wanted (around, first), each taken from its first document. So each window has one unit, which is the
    same wherever the window lies."""
    shared = docs.sparkSession.sparkContext.broadcast([bit_filter(wanted, c, bits_for(wanted.count())) for c in ("first", "around")])  # of a bounded size

    def run(batches):
        for batch in batches:
            ids, arounds = shared.value
            some = batch.filter(pa.array(in_filter(ids, batch.column(0).to_numpy())))
            for s in _slices([some], least):
                keep = np.flatnonzero(in_filter(arounds, s.around))
                keep = keep[np.unique(np.stack([s.of(s.at[keep]), s.around[keep]]), axis=1, return_index=True)[1]]
                low, high = led(s.mixed, s.at[keep]) if len(keep) else (keep, keep)
                for k in range(REACH + 1):
                    u = keep[(s.before[keep] >= k) & (s.behind[keep] >= REACH - k) & (low <= k) & (k <= high)]
                    yield pa.RecordBatch.from_arrays([s.row(s.at[u]), pa.array(s.around[u]), pa.array(np.full(len(u), k, np.int32)), pa.array(names_of(s.grams, s.at[u] - k, SPAN, 2))], names=["first", "around", "k", "window"])

    return docs.mapInArrow(run, "first long, around long, k int, window long").join(wanted, ["around", "first"], "left_semi").select("around", "k", "window")


def paragraphs(docs: DataFrame, least: int) -> DataFrame:
    """(id, name, keys): each paragraph's name and band keys."""

    def run(batches):
        for s in _slices(batches, least):
            if len(s.lo):
                keys, number = keys_of(s.grams, s.lo, s.hi)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(number)).astype(np.int32)), pa.array(keys))
                yield pa.RecordBatch.from_arrays([s.row(s.lo), pa.array(s.name), lists], names=["id", "name", "keys"])

    return docs.mapInArrow(run, "id long, name long, keys array<long>")


def shingle_sets(docs: DataFrame, least: int, wanted: DataFrame) -> DataFrame:
    """(name, item array<long>): the shingle sets of the wanted paragraphs (name, id of a document)."""
    shared = docs.sparkSession.sparkContext.broadcast([bit_filter(wanted, c, bits_for(wanted.count())) for c in ("id", "name")])  # of a bounded size

    def run(batches):
        for batch in batches:
            ids, names = shared.value
            some = batch.filter(pa.array(in_filter(ids, batch.column(0).to_numpy())))
            for s in _slices([some], least):
                keep = np.flatnonzero(in_filter(names, s.name))
                keep = keep[np.unique(np.stack([s.of(s.lo[keep]), s.name[keep]]), axis=1, return_index=True)[1]]
                sets = [np.unique(s.grams[i:j]) for i, j in zip(s.lo[keep].tolist(), s.hi[keep].tolist())]
                items = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([s.row(s.lo[keep]), pa.array(s.name[keep]), items], names=["id", "name", "item"])

    return docs.mapInArrow(run, "id long, name long, item array<long>").join(wanted, ["name", "id"], "left_semi").select("name", "item")


def name_filters(names: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit filters of the low and of the high halves of names."""
    log2 = bits_for(names.count())
    return bit_filter(names, "name", log2), bit_filter(names.select(F.shiftright("name", 32).alias("name")), "name", log2)


def spans_of(docs: DataFrame, least: int, names: DataFrame) -> DataFrame:
    """(id, at, words, name): the places of the units (by their surroundings, words 0) and paragraphs whose names pass the filters of
    `names`."""
    shared = docs.sparkSession.sparkContext.broadcast(name_filters(names))  # of a bounded size

    def passes(x: np.ndarray) -> np.ndarray:
        low, high = shared.value
        return in_filter(low, x) & in_filter(high, x >> np.int64(32))

    def run(batches):
        for s in _slices(batches, least):
            units, paras = np.flatnonzero(passes(s.around)), np.flatnonzero(passes(s.name))
            at = np.concatenate([s.at[units], s.lo[paras]])
            size = np.concatenate([np.zeros(len(units), np.int64), s.hi[paras] - s.lo[paras] + K - 1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([s.row(at), pa.array((at - s.doc[s.of(at)]).astype(np.int32)), pa.array(size), pa.array(np.concatenate([s.around[units], s.name[paras]]))], names=["id", "at", "words", "name"])

    return docs.mapInArrow(run, "id long, at int, words int, name long")


def labelled(start: np.ndarray, end: np.ndarray, owner: np.ndarray, n_places: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, end, owner, places, words of the whole stretch of repeats) of the runs of words of one owner. A word's owner is the smallest
    of the spans that it lies in."""
    none = np.iinfo(np.int64).max
    low, n = np.full(int(end.max()) + 1, none), np.zeros(int(end.max()) + 1, np.int64)
    for i in np.lexsort([-owner]).tolist():
        low[start[i] : end[i]] = owner[i]
        part = n[start[i] : end[i]]
        np.maximum(part, n_places[i], out=part)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(low)) + 1]).tolist()
    runs = [(i, j, int(low[i]), int(n[i:j].max())) for i, j in zip(edges, edges[1:]) if low[i] != none]
    first, stretch = 0, []
    for k, r in enumerate(runs):
        if k + 1 == len(runs) or runs[k + 1][0] != r[1]:
            stretch += [r[1] - runs[first][0]] * (k + 1 - first)
            first = k + 1
    return [(*r, x) for r, x in zip(runs, stretch)]


def passages(spans: DataFrame) -> DataFrame:
    """(id, start_word, end_word, owner, n_places, stretch) of the labelled runs of words of the spans (id, start, end, owner, n_places)."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(doc, *r) for r in labelled(*(found.values.field(k).to_numpy().astype(np.int64) for k in range(4)))]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "start_word", "end_word", "owner", "n_places", "stretch"])

    own = spans.groupBy("id").agg(F.collect_list(F.struct("start", "end", "owner", "n_places")).alias("spans"))  # of its own words only
    return own.mapInArrow(run, "id long, start_word long, end_word long, owner long, n_places long, stretch long")


def shared_runs(docs: DataFrame, least: int) -> DataFrame:
    """(name, spans): for surroundings of units that hold words of shared runs the spans (lo, hi, owner, n), relative to the unit."""
    units = written(unit_counts(docs, least), "units")
    kinds = units.groupBy("unit").agg(F.min("first").alias("low"), F.max("last").alias("high"), F.count("*").alias("kinds")).where("low != high")
    several = units.join(kinds.where("kinds > 1").select("unit"), "unit", "left_semi").select("around", "first", "last", "n")
    several = written(several, "several")
    seen = written(windows(docs, least, several.select("around", "first")).join(several, "around"), "windows")
    common = seen.groupBy("window").agg(F.min("first").alias("owner"), F.max("last").alias("high"), F.sum("n").alias("places")).where("owner != high")
    found = seen.select("around", "k", "window").join(common, "window")
    span = F.struct((-F.col("k")).alias("lo"), (SPAN - F.col("k")).alias("hi"), "owner", F.col("places").alias("n"))
    mixed = found.groupBy("around").agg(F.collect_list(span).alias("spans"))  # REACH + 1 at most
    alone = units.join(kinds.where("kinds = 1").select("unit"), "unit", "left_semi")
    whole = F.array(F.struct((-F.col("before")).alias("lo"), (LEAST + F.col("behind")).alias("hi"), F.col("first").alias("owner"), "n"))
    out = written(mixed.union(alone.select("around", whole)).withColumnRenamed("around", "name"), "runs")
    for table in (units, several, seen):
        delete(table)
    return out


def shared_paragraphs(docs: DataFrame, least: int) -> DataFrame:
    """(name, spans): for paragraphs of a component that lies in several documents the one span (0, 0, owner, n)."""
    each = written(paragraphs(docs, least).groupBy("name", "keys").agg(F.min("id").alias("id"), F.max("id").alias("last"), F.count("*").alias("n")), "paragraphs")
    group = near_sets(each.select("name", "id", "keys"), lambda wanted: shingle_sets(docs, least, wanted), 0.8)
    placed = each.select("name", F.col("id").alias("first"), "last", "n").join(group.withColumnRenamed("node", "name"), "name", "left").where("first != last or component is not null")
    placed = written(placed.select("name", F.coalesce("component", "name").alias("component"), "first", "last", "n"), "placed")
    delete(each)
    classes = placed.groupBy("component").agg(F.min("first").alias("owner"), F.max("last").alias("last"), F.max("n").alias("n")).where("owner != last")
    zero = F.lit(0)
    out = written(placed.select("name", "component").join(classes, "component").select("name", F.array(F.struct(zero.alias("lo"), zero.alias("hi"), "owner", "n")).alias("spans")), "classes")
    delete(placed)
    return out


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """docs (id, text) with ids that tell the rows apart, and (row, id, part) where ids had to be replaced: rows are numbered in the order
    of their ids then, and part numbers the rows of an id."""
    if docs.groupBy("id").count().where("count > 1").isEmpty():
        return docs, None
    dealt = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
    rows = written(dealt.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "rows")
    low = rows.groupBy("id").agg(F.min("row").alias("low"))
    return rows.select(F.col("row").alias("id"), "text"), rows.select("row", "id").join(low, "id").select("row", "id", (F.col("row") - F.col("low")).alias("part"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = K, shortest: int = 0) -> DataFrame:
    """(id_col, part, start_word, end_word, n_words, class_id, n_places, kept): the passages that other rows have too.

    Words are counted from 0 in the row's text, the end is exclusive. A word is a repeat if it lies in SPAN consecutive words that another
    row has too, or in a paragraph of at least `least` words (K at least) to which one of another row is similar, by links of 0.8. class_id
    is the id of the smallest row that has these words or such a paragraph, n_places the most places that one of them has; kept tells
    the row whose words stay. Where the owner changes a new passage starts. Passages in stretches of fewer than `shortest` repeated
    words are left out, so that stock lines aren't named where that isn't wanted; all are compared in any case.
    Null and empty texts, null ids and rows without repeats give no rows; what repeats inside one row only is none, as no other
    row has it. Copies of a document repeat each other wholly. part tells rows of one id apart (0 where ids are unique); equal
    rows of one id are copies of each other. A very long text is one task's work. Only the two named columns are read.
    """
    rows, ids = numbered(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null"))
    named = shared_runs(rows, least).union(shared_paragraphs(rows, least))
    spans = spans_of(rows, least, named.select("name")).join(named, "name").select("id", "at", "words", F.explode("spans").alias("s"))
    start = F.col("at") + F.col("s.lo")
    end = F.when(F.col("words") > 0, F.col("at") + F.col("words")).otherwise(F.col("at") + F.col("s.hi"))
    out = passages(spans.select("id", start.alias("start"), end.alias("end"), "s.owner", F.col("s.n").alias("n_places"))).where(F.col("stretch") >= shortest)
    out = out.withColumn("kept", F.col("id") == F.col("owner"))
    if ids is None:
        out = out.select(F.col("id").alias("_id"), F.lit(0).cast("long").alias("part"), F.col("owner").alias("class_id"), "start_word", "end_word", "n_places", "kept")
    else:
        own, first = ids.select(F.col("row").alias("_row"), F.col("id").alias("_id"), "part"), ids.select(F.col("row").alias("owner"), F.col("id").alias("class_id"))
        out = out.join(own, F.col("id") == F.col("_row")).join(first, "owner")
    return out.select(F.col("_id").alias(id_col), "part", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "class_id", "n_places", "kept")
