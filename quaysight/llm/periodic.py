"""Periodic runs of words by longest common extensions over a difference cover.

The texts of a slice stand in one array of word numbers, parted by numbers that occur once. A run of period p has at least
max(LEAST - p, 2 p) consecutive places whose words equal those p places on, so that a grid of that step meets it: the harmonic grid of
all periods has O(n log n) places. At a grid place where both words are equal, the equal stretch is extended both ways. The suffixes at
the places of a difference cover modulo V are sorted; two places reach such suffixes after the same 0 to V - 1 steps, word by word, and
from there the smallest of the common prefixes between their ranks is read from a sparse table. Extension backwards is extension
in the reversed array. Only texts in which some stretch reaches its sample are sorted.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

LEAST, TIMES = 24, 3
#: A perfect difference set, each distance modulo V once.
V, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Grid places that are looked at together.
TOGETHER = 1 << 20

#: _TO_SAMPLE[d]: a residue r of the cover with r + d in the cover too.
_TO_SAMPLE = np.zeros(V, np.int64)
for _a in COVER:
    for _b in COVER:
        _TO_SAMPLE[(_b - _a) % V] = _a
_IN_COVER = np.isin(np.arange(V), COVER)


def steps_to_sample(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least steps found after which both places are in the cover."""
    return (_TO_SAMPLE[(j - i) % V] - i) % V


class Samples:
    """The sorted suffixes at cover places of the wanted parts of an array whose separators occur once each and stand at both ends."""

    def __init__(self, words: np.ndarray, wanted: np.ndarray):
        at = np.flatnonzero(_IN_COVER[np.arange(len(words)) % V] & wanted)
        self.number = np.full(len(words) + V, -1, np.int64)
        self.number[at] = np.arange(len(at))
        padded = np.concatenate([words, np.zeros(V, words.dtype)])
        block = np.lib.stride_tricks.sliding_window_view(padded, V)[at]
        name = np.ascontiguousarray(block.astype(">u4")).view(f"V{4 * V}").ravel()  # bytes in the order of the words
        rank, jump = np.unique(name, return_inverse=True)[1].astype(np.int64), self.number[np.minimum(at + V, len(words))]
        ranks, jumps = [rank], [jump]
        while len(at) and rank.max() < len(at) - 1:  # names of twice the length
            key = rank * (len(at) + 1) + np.where(jump >= 0, rank[jump] + 1, 0)
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
            jump = np.where(jump >= 0, jump[jump], -1)
            ranks.append(rank)
            jumps.append(jump)
        self.rank = rank
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):  # whole blocks first
            same = ranks[level][a] == ranks[level][b]
            common += same * (V << level)
            a, b = np.where(same, jumps[level][a], a), np.where(same, jumps[level][b], b)
        common += (block[a] != block[b]).argmax(axis=1)
        self.least = [common]  # the sparse table
        while 2 << len(self.least) - 1 <= len(common):
            low, size = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(low[:-size], low[size:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The equal words from two different sampled places on."""
        a, b = self.rank[self.number[i]], self.rank[self.number[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.zeros(len(i), np.int64)
        for k in np.unique(level).tolist():
            of = np.flatnonzero(level == k)
            out[of] = np.minimum(self.least[k][lo[of]], self.least[k][hi[of] - (1 << k)])
        return out


def compared(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The equal words from i and j on, up to the first sample, and whether the sample was reached."""
    steps, equal = steps_to_sample(i, j), np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    for k in range(V):
        live = live[steps[live] > k]
        live = live[words[i[live] + k] == words[j[live] + k]]
        equal[live] += 1
        if not len(live):
            break
    return equal, equal == steps


def extents(words: np.ndarray, part: np.ndarray, gap: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The equal words from i and j on. part: the text that each place belongs to; gap: the smallest number of a separator."""
    equal, reached = compared(words, i, j)
    deep = np.flatnonzero(reached)
    if len(deep):
        wanted = np.zeros(int(part[-1]) + 1, bool)
        wanted[part[i[deep]]] = wanted[part[j[deep]]] = True
        x, y = i[deep] + equal[deep], j[deep] + equal[deep]
        wanted[part[x]] = wanted[part[y]] = True
        inside = wanted[part]
        inside[1:] |= inside[:-1] & (words[1:] >= gap)  # and the separator behind each text, so that all suffixes differ
        equal[deep] += Samples(words, inside).common(x, y)
    return equal


def grid(n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the harmonic grid over n places, for periods up to `most`, some TOGETHER at a time."""
    period = np.arange(1, most + 1)
    step = np.maximum(LEAST - period, (TIMES - 1) * period)
    count = -(-np.maximum(n - period, 0) // step)
    ends = np.cumsum(count)
    first = 0
    while first < most:
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, side="right")))
        c = count[first:last]
        p = np.repeat(period[first:last], c)
        yield (np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)) * np.repeat(step[first:last], c), p
        first = last


def find_runs(words: np.ndarray, part: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs, by start and period. words: numbers of the words, with separators before, between and behind
    the texts, which are larger than all words and ascend; part: a number of the text for each place, ascending; longest: the words of the longest text."""
    found, size = [np.zeros((0, 3), np.int64)], len(words)
    back, back_part, gap = words[::-1], part[-1] - part[::-1], int(words[0])
    for i, p in grid(size, longest // TIMES):
        same = words[i] == words[i + p]
        i, p = i[same], p[same]
        # What needs the samples is put off until it is known which grid places have a stretch that is long enough.
        ahead, far = compared(words, i, i + p)
        behind, far_back = compared(back, size - i - p, size - i)
        some = far | far_back | (ahead + behind + p >= np.maximum(LEAST, TIMES * p))
        i, p, ahead, behind, far, far_back = (x[some] for x in (i, p, ahead, behind, far, far_back))
        if len(i):
            ahead[far] = extents(words, part, gap, i[far], i[far] + p[far])
            behind[far_back] = extents(back, back_part, gap, size - i[far_back] - p[far_back], size - i[far_back])
            ok = ahead + behind + p >= np.maximum(LEAST, TIMES * p)
            found.append(np.unique(np.stack([(i - behind)[ok], (i + p + ahead)[ok], p[ok]], axis=1), axis=0))
    every = np.concatenate(found)
    every = every[np.lexsort([every[:, 2], every[:, 1], every[:, 0]])]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)  # a stretch of several periods has the smallest, of which the others are multiples
    every = every[first]
    return every[np.lexsort([every[:, 2], every[:, 0]])]


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The (start, length, period) of greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, runs, best, collapsed): the maximal stretches of words whose smallest period occurs three times or more, over
    24 words or more.

    runs: array of (start, length, period) by start and period; best: the one of greatest length / period, or null; collapsed: the
    text's words, joined by a space, without those that a run holds after its first period. Words are what ASCII white space parts.
    Null, empty and blank texts have no words. Rows are independent, so that repeated and null ids give a row each; an empty table
    gives an empty one. Only the two named columns are read. A very long text is one task's work, in n log n steps at most.
    """

    def run(batches):
        for batch in slices(batches):
            numbers: dict[bytes, int] = {}
            split = [t.split() for t in texts(batch)]
            size = np.array([len(w) for w in split], np.int64)
            start = np.cumsum(np.append(1, size + 1))
            words = np.zeros(int(start[-1]), np.int64)
            for at, ws in zip(start.tolist(), split):
                words[at : at + len(ws)] = [numbers.setdefault(w, len(numbers)) for w in ws]
            gaps = np.append(0, start[1:] - 1)
            words[gaps] = len(numbers) + np.arange(len(gaps))
            part = np.repeat(np.arange(len(size) + 1), np.append(1, size + 1))
            found = find_runs(words, part, int(size.max()))
            of = part[found[:, 0]] - 1
            lo, hi = np.searchsorted(of, np.arange(len(size))), np.searchsorted(of, np.arange(len(size)), side="right")
            listed, best, collapsed = [], [], []
            for d, ws in enumerate(split):
                here = [(s - int(start[d]), e - s, p) for s, e, p in found[lo[d] : hi[d]].tolist()]
                if here:
                    keep = np.ones(len(ws), bool)
                    for s, length, p in here:
                        keep[s + p : s + length] = False
                    ws = [ws[k] for k in np.flatnonzero(keep).tolist()]
                listed.append([dict(zip(("start", "length", "period"), r)) for r in here])
                best.append(dict(zip(("start", "length", "period"), best_of(here))) if here else None)
                collapsed.append(b" ".join(ws))
            one = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(listed, pa.list_(one)), pa.array(best, one), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "best", "collapsed"])

    one = "struct<start: bigint, length: bigint, period: bigint>"
    found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, runs array<{one}>, best {one}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document, by the CRC-32 h of its id, the words from place a on go round the p words there; g is
    h / 10, a is g % n and p is 1 + (n - a) / (3 + g % 8), rounded down. Texts without words and rows without id stay."""

    def run(batches):
        for batch in slices(batches):
            ids, out = batch.column(0).to_pylist(), texts(batch)
            for k, i in enumerate(ids):
                g, tenth = divmod(zlib.crc32(str(i).encode()), 10)
                if i is not None and tenth == 0 and (words := out[k].split()):
                    a = g % len(words)
                    rest = len(words) - a
                    p = 1 + rest // (3 + g % 8)
                    out[k] = b" ".join(words[:a] + (words[a : a + p] * -(-rest // p))[:rest])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string")
