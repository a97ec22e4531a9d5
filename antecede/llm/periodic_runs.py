"""Runs of words that repeat with a period, by branching tandem repeats over an enhanced suffix array.

A run is a stretch of words in which words ``q`` apart are equal, ``q`` being the smallest such
period, and which no neighbouring word extends. Its last square (``2 q`` words) branches: what
follows its first half differs from what follows its second. So the suffixes at the two halves
have a common prefix of exactly ``q`` words and lie on different sides of a boundary of depth ``q``
in the suffix array. For every boundary of an interval of common prefixes, the suffixes ``i`` of
the smaller side are taken, and the inverse suffix array says whether ``i + depth`` or
``i - depth`` is on the other side. Each square found is rotated to the left as long as it stays a
square, which gives the run. Intervals are ranges of the array; no tree is made.

Documents are handled in blocks of whole texts, about ``BLOCK_WORDS`` words each, at a hundred
bytes or so a word. A word of one document is a symbol of its own, so no common prefix leaves a
document. Everything happens where the text is, without a shuffle.

Defined results: a null, empty or blank text has no runs and an empty collapsed text; rows are
handled each on its own, so repeated rows and null ids change nothing; overlapping runs are all
returned, by start and then period; an empty table gives an empty result. Other columns stay
unless their name is that of the column added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BLOCK_WORDS = 1 << 18
_CELLS = 1 << 20
RUNS = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


class _Minima:
    """Minima of blocks of 1, 2, 4, ... neighbouring values."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while len(values) > 1:
            odd = values[-1:] if len(values) % 2 else values[:0]
            values = np.concatenate((np.minimum(values[0 : len(values) - 1 : 2], values[1::2]), odd))
            self.levels.append(values)

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least value of each range ``[low, high)``, none of which is empty."""
        low, high = low.copy(), high.copy()
        out = np.full(len(low), np.iinfo(np.int64).max)
        at = np.arange(len(low))
        for level in self.levels:
            a, b = low[at], high[at]
            odd = a % 2 == 1
            out[at[odd]] = np.minimum(out[at[odd]], level[a[odd]])
            last = b % 2 == 1
            out[at[last]] = np.minimum(out[at[last]], level[b[last] - 1])
            low[at], high[at] = (a + 1) >> 1, b >> 1
            at = at[low[at] < high[at]]
            if not len(at):
                break
        return out

    def last_before(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """For each place the last one before it with a value of ``limit`` or less; there is one."""
        block, found = at.copy(), np.full(len(at), -1)
        open_ = np.arange(len(at))
        for height, level in enumerate(self.levels):
            b = block[open_]
            odd = b % 2 == 1
            hit = np.zeros(len(b), bool)
            hit[odd] = level[b[odd] - 1] <= limit[open_[odd]]
            found[open_[hit]] = height
            block[open_] = np.where(hit, b - 1, b >> 1)
            open_ = open_[~hit]
            if not len(open_):
                break
        return self._down(block, found, limit, 1)

    def first_after(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """For each place the first one after it with a value below ``limit``; there is one."""
        block, found = at + 1, np.full(len(at), -1)
        open_ = np.arange(len(at))
        for height, level in enumerate(self.levels):
            b = block[open_]
            odd = b % 2 == 1
            hit = np.zeros(len(b), bool)
            hit[odd] = level[b[odd]] < limit[open_[odd]]
            found[open_[hit]] = height
            block[open_] = np.where(hit, b, (b + 1) >> 1)
            open_ = open_[~hit]
            if not len(open_):
                break
        return self._down(block, found, limit - 1, 0)

    def _down(self, block: np.ndarray, height: np.ndarray, limit: np.ndarray, side: int) -> np.ndarray:
        """From a block to its outermost place on that side with a value of ``limit`` or less."""
        for level in range(int(height.max(initial=0)), 0, -1):
            at = np.flatnonzero(height >= level)
            child = 2 * block[at] + side
            values = self.levels[level - 1]
            inside = np.minimum(child, len(values) - 1)
            fits = (child < len(values)) & (values[inside] <= limit[at])
            block[at] = np.where(fits, child, child ^ 1)
        return block


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the rank of each, and the common prefix of each with the one before it
    (-1 at both ends, so one more), by doubling: only groups that are not told apart are sorted
    again, and a boundary's depth comes from those known before."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    new = np.ones(n + 1, bool)
    new[1:n] = ordered[1:] != ordered[:-1]
    depth = np.full(n + 1, np.iinfo(np.int64).max)
    depth[new] = 0
    heads = np.flatnonzero(new[:n])
    rank = np.full(n + 1, -1)  # the last: beyond the end
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    step = 1
    slots = np.flatnonzero(~(new[:n] & new[1:]))
    while len(slots):
        places = order[slots]
        group, following = rank[places], rank[np.minimum(places + step, n)]
        by = np.lexsort((following, group))
        places, group, following = places[by], group[by], following[by]
        order[slots] = places
        cut = np.ones(len(slots), bool)
        cut[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        fresh = np.flatnonzero(cut & ~new[slots])
        low, high = following[fresh - 1], following[fresh]
        inner = low >= 0
        depths = np.full(len(fresh), step)
        if inner.any():
            depths[inner] += _Minima(depth).between(low[inner] + 1, high[inner] + 1)
        depth[slots[fresh]] = depths
        new[slots[fresh]] = True
        heads = np.flatnonzero(cut)
        rank[places] = np.repeat(slots[heads], np.diff(np.append(heads, len(slots))))
        slots = slots[~(new[slots] & new[slots + 1])]
        step *= 2
    depth[0] = depth[n] = -1
    return order, rank[:n], depth


def _branching(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every branching square."""
    order, rank, depth = suffix_array(symbols)
    n = len(symbols)
    at = np.flatnonzero(depth > 0)
    minima, d = _Minima(depth), depth[at]
    low, high = minima.last_before(at, d), minima.first_after(at, d)
    left = at - low <= high - at  # the smaller side
    begin, size = np.where(left, low, at), np.where(left, at - low, high - at)
    other_low, other_high = np.where(left, at, low), np.where(left, high, at)
    starts, periods = [], []
    ends = np.cumsum(size)
    for a, b in _lots(size, _CELLS):
        count = size[a:b]
        node = np.repeat(np.arange(a, b), count)
        i = order[begin[node] + np.arange(len(node)) - np.repeat(ends[a:b] - count - (ends[a] - count[0]), count)]
        far = d[node]
        for j, first in ((i + far, i), (i - far, i - far)):
            inside = np.flatnonzero((j >= 0) & (j < n))
            r, m = rank[j[inside]], node[inside]
            hit = inside[(r >= other_low[m]) & (r < other_high[m])]
            starts.append(first[hit])
            periods.append(far[hit])
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _lots(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of about ``most`` in all."""
    lot = (np.cumsum(sizes) - sizes) // most
    cut = np.append(np.flatnonzero(np.diff(lot, prepend=-1)), len(sizes))
    yield from zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)


def _rotations(symbols: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How often each square can be moved one word to the left and stay one."""
    out = np.zeros(len(start), np.int64)
    open_, width = np.arange(len(start)), 4
    while len(open_):
        width = max(4, min(width, _CELLS // len(open_)))
        going = []
        for k in range(0, len(open_), _CELLS // 4):
            some = open_[k : k + _CELLS // 4]
            left = (start[some] - out[some])[:, None] - np.arange(1, width + 1)
            right = np.maximum(left + period[some][:, None], 0)
            same = (left >= 0) & (symbols[np.maximum(left, 0)] == symbols[right])
            steps = np.where(same.all(1), width, same.argmin(1))
            out[some] += steps
            going.append(some[steps == width])
        open_, width = np.concatenate(going), width * 2
    return out


def runs_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of at least two periods."""
    start, period = _branching(symbols)
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    found = []
    while len(start):
        # The smallest period of each end is a run's; its multiples inside that run are not.
        first = np.append(True, end[1:] != end[:-1])
        length = 2 * period[first] + _rotations(symbols, start[first], period[first])
        found.append((end[first] - length, length, period[first]))
        of = np.cumsum(first) - 1
        keep = ~first & ((period % period[first][of] != 0) | (2 * period > length[of]))
        start, period, end = start[keep], period[keep], end[keep]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


@dataclass
class _Block:
    """Runs and kept words of some texts."""

    words: list[list[bytes]]

    def rows(self, min_length: int, min_periods: int) -> Iterator[tuple[list[dict], str]]:
        symbols, sizes, base = [], np.fromiter(map(len, self.words), np.int64, len(self.words)), 0
        for words in self.words:
            known: dict[bytes, int] = {}
            symbols += [base + known.setdefault(w, len(known)) for w in words]
            base += len(known)
        start, length, period = runs_of(np.array(symbols, np.int64))
        long = length >= np.maximum(min_length, min_periods * period)
        start, length, period = start[long], length[long], period[long]
        cover = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(cover, start + period, 1)
        np.add.at(cover, start + length, -1)
        gone = np.cumsum(cover) > 0
        firsts = np.cumsum(sizes) - sizes
        cut = np.searchsorted(start, np.append(firsts, len(symbols)))
        for k, (words, first) in enumerate(zip(self.words, firsts.tolist(), strict=True)):
            some = slice(cut[k], cut[k + 1])
            rows = zip((start[some] - first).tolist(), length[some].tolist(), period[some].tolist(), strict=True)
            if cut[k] < cut[k + 1]:
                words = [w for w, g in zip(words, gone[first : first + len(words)].tolist(), strict=True) if not g]
            yield [{"start": s, "length": n, "period": p} for s, n, p in rows], b" ".join(words).decode("utf-8", "surrogatepass")


def _blocks(texts: pd.Series) -> Iterator[_Block]:
    held, size = [], 0
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split() if text is not None else []
        if held and size + len(words) > BLOCK_WORDS:
            yield _Block(held)
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield _Block(held)


def periodic_runs(text: Column, min_length: int = 6, min_periods: int = 4) -> Column:
    """A struct of ``runs`` (those of at least ``min_length`` words and ``min_periods`` periods,
    which is two at least) and ``collapsed``: the words that are in no run, or among the first
    ``period`` words of every run they are in, with a blank between. Words are runs of anything but
    ASCII white space."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")

    @pandas_udf(RUNS)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [row for block in _blocks(texts) for row in block.rows(min_length, min_periods)]
        return pd.DataFrame({"runs": [r for r, _ in rows], "collapsed": [c for _, c in rows]})

    return found(text)


def add_runs(docs: DataFrame, text_col: str = "text", into: str = "periodic", min_length: int = 6, min_periods: int = 4) -> DataFrame:
    """``docs`` with the struct of ``periodic_runs`` in a new column."""
    return docs.withColumn(into, periodic_runs(F.col(text_col), min_length, min_periods))


def longest(runs: Column) -> Column:
    """The run of greatest length, of equal ones that of least start, then of least period; null if
    there is none."""
    key = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(key)
    return F.when(
        best.isNotNull(),
        F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")),
    )


def listed(runs: Column) -> Column:
    """All runs as text, a line ``start,length,period`` each."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(lines, "")
