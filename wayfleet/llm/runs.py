"""Periodic runs of words: branching tandem repeats found over an enhanced suffix array, rotated and merged into runs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfleet.llm.common import without

#: Least words of a run, least copies of its period, words that are searched at once (a longer text is searched by itself).
LEAST, COPIES, BATCH = 6, 4, 200_000
NAMES = ("n_words", "runs", "collapsed")


class SuffixArray:
    """Suffixes of a sequence of whole numbers in order, with the ranks of all prefixes of 1, 2, 4, ... symbols.

    Negative numbers are borders: no two of them are equal. The sequence ends with one.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.n = n
        symbols = symbols.astype(np.int64, copy=True)
        borders = np.flatnonzero(symbols < 0)
        symbols[borders] = -1 - np.arange(len(borders))
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = self._starts(symbols[order], np.arange(n))
        #: ``levels[k][i]``: number of suffixes whose first 2^k symbols are less than those of suffix i.
        self.levels = [rank.astype(np.int32)]
        width = 1
        while True:
            # only suffixes that share all symbols so far with another one are looked at again
            shared = np.bincount(rank, minlength=n)[rank] > 1
            active = np.flatnonzero(shared)
            if not active.size:
                break
            key = rank[active] * n + rank[np.minimum(active + width, n - 1)]
            order = np.argsort(key, kind="stable")
            ordered, place = key[order], active[order]
            group = rank[place]
            first = np.r_[True, group[1:] != group[:-1]]
            inside = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
            rank = rank.copy()
            rank[place] = self._starts(ordered, group + inside)
            self.levels.append(rank.astype(np.int32))
            width *= 2
        self.inverse = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    @staticmethod
    def _starts(ordered: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each of the sorted keys the place of the first that equals it."""
        first = np.r_[True, ordered[1:] != ordered[:-1]]
        return places[np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that suffixes a and b, different ones, have in common from the start."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, last = self.levels[k], self.n - 1
            length += (level[np.minimum(a + length, last)] == level[np.minimum(b + length, last)]).astype(np.int64) << k
        return length

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols in common before places a < b, counted backwards: a rotation to the left by 2^k at a time."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            x, y = a - length - step, b - length - step
            same = (x >= 0) & (level[np.maximum(x, 0)] == level[np.maximum(y, 0)])
            length += same.astype(np.int64) << k
        return length

    def neighbours(self) -> np.ndarray:
        """Longest common prefix of each suffix with the one before it in order; -1 at the ends."""
        return np.r_[-1, self.common(self.order[:-1], self.order[1:]), -1]


class NearestLess:
    """Nearest smaller values in a sequence whose two ends are smaller than all others, by minima of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.minima = [values.astype(np.int32)]
        width = 1
        while 2 * width < self.n:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def before(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Last place before ``at`` with a value under ``limit``."""
        at = at.copy()
        for k in range(len(self.minima) - 1, -1, -1):
            low, step = self.minima[k], 1 << k
            start = at - step
            skip = (start >= 0) & (low[np.maximum(start, 0)] >= limit)
            at -= skip.astype(np.int64) << k
        return at - 1

    def after(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """First place after ``at`` with a value under ``limit``."""
        at = at + 1
        for k in range(len(self.minima) - 1, -1, -1):
            low, step = self.minima[k], 1 << k
            fits = at + step <= self.n
            skip = fits & (low[np.minimum(at, len(low) - 1)] >= limit)
            at += skip.astype(np.int64) << k
        return at


def smaller_children(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every suffix of all but one largest child of every LCP interval: its place in the order, the depth of the interval
    and the interval's first and last place."""
    at = np.flatnonzero(lcp > 0)
    if not at.size:
        none = np.empty(0, np.int64)
        return none, none, none, none
    depth, near = lcp[at], NearestLess(lcp)
    low, high = near.before(at, depth), near.after(at, depth) - 1
    left, right = near.before(at, depth + 1), near.after(at, depth + 1) - 1
    # a child on the left of every border of equal depth, and one on the right of the last border
    last = right == high
    start, end = np.r_[left, at[last]], np.r_[at - 1, right[last]]
    low, high, depth = np.r_[low, low[last]], np.r_[high, high[last]], np.r_[depth, depth[last]]
    size = end - start + 1
    order = np.lexsort((size, high, low))
    largest = np.r_[(low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1]), True]
    chosen = order[~largest]
    size = size[chosen]
    place = np.repeat(start[chosen], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return place, np.repeat(depth[chosen], size), np.repeat(low[chosen], size), np.repeat(high[chosen], size)


def tandem_runs(symbols: np.ndarray, least: int, copies: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run of a sequence whose negative numbers are borders.

    A square of two equal halves of length d, not followed by its own first symbol, starts at i where i and i + d lie in
    different children of an LCP interval of depth d; one of the two is in a child other than the largest. Turned
    to the left as far as its symbols repeat it is a run; of runs with the same ends the smallest period counts.
    """
    array = SuffixArray(symbols)
    place, depth, low, high = smaller_children(array.neighbours())
    suffix, last = array.order[place], array.n - 1
    found = []
    for start in (suffix, suffix - depth):
        other = np.where(start == suffix, suffix + depth, start)
        inside = (start >= 0) & (start + depth <= last)
        rank = array.inverse[np.clip(other, 0, last)]
        inside &= (low <= rank) & (rank <= high)
        s, d = start[inside], depth[inside]
        after = symbols[np.minimum(s + 2 * d, last)]
        branching = (after < 0) | (after != symbols[s + d])
        found.append(np.stack([s[branching], d[branching]]))
    start, period = np.concatenate(found, axis=1)
    turned = array.common_before(start, start + period)
    begin, end = start - turned, start + 2 * period
    long = end - begin >= np.maximum(least, copies * period)
    begin, end, period = begin[long], end[long], period[long]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])] if len(begin) else np.empty(0, bool)
    return begin[first], end[first], period[first]


def _reduced(owner: np.ndarray, word: np.ndarray, least: int, copies: int) -> np.ndarray:
    """Places that a run can hold: each of its words is there ``copies`` times in its text, in stretches of ``least`` words."""
    places = np.arange(len(word))
    while places.size:
        key = owner[places] * (int(word.max()) + 1) + word[places]
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        kept = places[times[back] >= copies]
        if not kept.size:
            return kept
        new = np.r_[True, (np.diff(kept) != 1) | (np.diff(owner[kept]) != 0)]
        stretch = np.cumsum(new) - 1
        kept = kept[np.bincount(stretch)[stretch] >= least]
        if len(kept) == len(places):
            break
        places = kept
    return places


def runs_of(texts: list[list], least: int = LEAST, copies: int = COPIES) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of every list of words, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    number: defaultdict = defaultdict(count().__next__)
    lengths = np.array([len(t) for t in texts], np.int64)
    word = np.fromiter((number[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(texts)), lengths)
    begins = np.cumsum(lengths) - lengths
    kept = _reduced(owner, word, least, copies)
    if not kept.size:
        return found
    # a border after every stretch; equal words of different texts are different symbols
    new = np.r_[True, (np.diff(kept) != 1) | (np.diff(owner[kept]) != 0)]
    at = np.arange(len(kept)) + np.cumsum(new) - 1
    symbols = np.full(int(at[-1]) + 2, -1, np.int64)
    symbols[at] = owner[kept] * len(number) + word[kept]
    place = np.zeros(len(symbols), np.int64)
    place[at] = kept
    begin, end, period = tandem_runs(symbols, least, copies)
    for b, length, p in zip(place[begin].tolist(), (end - begin).tolist(), period.tolist(), strict=True):
        text = owner[b]
        found[text].append((b - int(begins[text]), length, p))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


def find_runs(docs: DataFrame, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """Periodic runs in the words of every whole ``text``, which goes; adds ``n_words``, ``runs`` and ``collapsed``.

    Words are what white space (space, tab to carriage return) parts. A run is a stretch of words of smallest period q, at
    least ``copies`` times q and ``least`` words long, that no neighbouring word extends. ``runs`` holds ``start`` (word
    number from 0), ``length`` and ``period``, by start, then period. ``collapsed`` is the text without the words that
    any run holds after its first period, joined by single spaces.

    One narrow stage: the texts of a task are searched in batches of 200,000 words, a longer text by itself, in N log N
    steps whatever they repeat. Null and empty texts have no words and no runs; repeated rows get the same result;
    columns of the result's names, whatever their case, are replaced, other columns stay.
    """
    if least < 2 or copies < 2:
        raise ValueError("a run holds at least two copies and two words")
    docs = without(docs, NAMES)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    types += ", n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(texts: list[list[bytes]]) -> Iterator[tuple[list, bytes]]:
        for words, runs in zip(texts, runs_of(texts, least, copies), strict=True):
            yield runs, b" ".join(collapse(words, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "text"]
            counts, made, waiting, held = [], [], [], 0
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").split()  # bytes are split at exactly the six characters above
                if waiting and held + len(words) > BATCH:
                    made += search(waiting)
                    waiting, held = [], 0
                waiting.append(words)
                held += len(words)
                counts.append(len(words))
            made += search(waiting)
            runs = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in made], run_type)
            collapsed = pa.array([c for _, c in made], pa.binary()).cast(pa.string())
            columns = [*[batch.column(n) for n in kept], pa.array(counts, pa.int64()), runs, collapsed]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *NAMES])

    return docs.mapInArrow(run, types)
