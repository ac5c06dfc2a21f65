"""Periodic runs of words in texts, found through the LCP intervals of an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import slices, texts_of

# A run has at least so many words and repeats its period so often.
LEAST_WORDS = 6
LEAST_TURNS = 4
SLICE_BYTES = 3_000_000

# From the ids of some texts and their numbers of words: for each text None, or for each word of it the place whose word it takes.
Rearrange = Callable[[list, np.ndarray], list]


class SuffixArray:
    """Suffix array, its inverse and LCP of texts laid end to end; no two texts share a symbol.

    ``levels[j]`` numbers the classes of suffixes with the same first 2^j symbols in their sorted order, so a class
    of one is never touched again and the last level is the inverse of the suffix array. ``ends`` holds for each place the end of its text.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        self.size, self.ends = len(symbols), ends
        order = np.argsort(symbols, kind="stable")
        ranks = np.empty(self.size, np.int64)
        ranks[order] = _first_of_equals(symbols[order])
        self.levels = [ranks]
        width = 1
        while True:
            open_ = np.flatnonzero(np.bincount(ranks, minlength=self.size)[ranks] > 1)
            if not len(open_):
                break
            next_ = open_ + width
            inside = next_ < ends[open_]
            second = np.where(inside, ranks[np.where(inside, next_, 0)] + 1, 0)
            keys = ranks[open_] * (self.size + 1) + second
            order = np.argsort(keys, kind="stable")
            first = ranks[open_][order]
            group_start = _first_of_equals(first)
            ranks = ranks.copy()
            ranks[open_[order]] = first + (_first_of_equals(keys[order]) - group_start)
            self.levels.append(ranks)
            width *= 2
        self.inverse = ranks
        self.places = np.empty(self.size, np.int64)
        self.places[ranks] = np.arange(self.size)
        self.lcp = np.zeros(self.size + 1, np.int64)
        if self.size:
            self.lcp[1:-1] = self.common(self.places[:-1], self.places[1:])

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of symbols the suffixes at ``left`` and ``right`` begin with alike."""
        left, right, found = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        left_end, right_end = self.ends[left], self.ends[right]
        for level in range(len(self.levels) - 1, -1, -1):
            ranks = self.levels[level]
            rows = np.flatnonzero((left < left_end) & (right < right_end))
            rows = rows[ranks[left[rows]] == ranks[right[rows]]]
            for moved in (left, right, found):
                moved[rows] += 1 << level
        return found

    def rotated(self, starts: np.ndarray, periods: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """How far squares can be rotated to the left: the least start with the same period up to the given one."""
        starts = starts.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            ranks, step = self.levels[level], 1 << level
            rows = np.flatnonzero(starts - step >= floors)
            left = starts[rows] - step
            starts[rows[ranks[left] == ranks[left + periods[rows]]]] -= step
        return starts


def _first_of_equals(ordered: np.ndarray) -> np.ndarray:
    """For each entry of sorted values the index of the first one equal to it."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def _nearest_smaller(values: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """For each of ``places`` the nearest one before (step -1) or behind (step 1) it whose value is smaller.

    Widens by doubled blocks of a minimum table, then narrows down; the value at both ends of ``values`` is below all asked for.
    """
    tables = [values]
    at = places + step
    wanted = values[places]
    level = np.zeros(len(places), np.int64)
    active = np.arange(len(places))
    height = 0
    while len(active):  # widen: blocks of 2^height values, all of them large enough
        table, size = tables[height], 1 << height
        low = at[active] if step > 0 else at[active] - size + 1
        fits = (low >= 0) & (low < len(table))
        ok = np.zeros(len(active), bool)
        ok[fits] = table[low[fits]] >= wanted[active[fits]]
        level[active[~ok]] = height
        active = active[ok]
        at[active] += step * size
        height += 1
        if len(active) and height == len(tables):
            half = 1 << (height - 1)
            last = tables[-1]
            tables.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last[:0])
    for height in range(int(level.max(initial=0)) - 1, -1, -1):
        table, size = tables[height], 1 << height
        rows = np.flatnonzero(level > height)
        low = at[rows] if step > 0 else at[rows] - size + 1
        fits = (low >= 0) & (low < len(table))
        rows, low = rows[fits], low[fits]
        rows = rows[table[low] >= wanted[rows]]
        at[rows] += step * size
    return at


def branching_squares(index: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of each square whose period does not go on behind it.

    An LCP interval of depth d holds the suffixes that share their first d symbols, its child intervals and single
    suffixes those that share one more. Two suffixes i and i + d of one interval but of different children are such
    a square. Of each pair one is outside the largest child, so only the suffixes of smaller children are asked,
    in both directions; each suffix is in at most log n of these.
    """
    none = np.empty(0, np.int64)
    lcp, size = index.lcp, index.size
    cuts = np.flatnonzero(lcp > 0)
    if not len(cuts):
        return none, none
    lows = _nearest_smaller(lcp, cuts, -1)
    highs = _nearest_smaller(lcp, cuts, 1) - 1
    _, first, interval_of_cut = np.unique(lows * (size + 1) + highs, return_index=True, return_inverse=True)
    low, high, depth = lows[first], highs[first], lcp[cuts[first]]
    interval_at = np.full(size + 1, -1, np.int64)
    interval_at[cuts] = interval_of_cut

    # Children: the intervals themselves, then single suffixes next to a cut. Each lies in the interval of its deeper border.
    single = np.flatnonzero((lcp[:-1] > 0) | (lcp[1:] > 0))
    child_low, child_high = np.concatenate([low, single]), np.concatenate([high, single])
    before, behind = lcp[child_low], lcp[child_high + 1]
    inner = (before > 0) | (behind > 0)
    child_low, child_high, before, behind = child_low[inner], child_high[inner], before[inner], behind[inner]
    parent = np.where(before >= behind, interval_at[child_low], interval_at[child_high + 1])
    # The largest child of each interval is left out, the first one of several.
    order = np.lexsort((child_low, -(child_high - child_low), parent))
    smaller = order[_first_of_equals(parent[order]) != np.arange(len(order))]
    child_low, child_high, parent = child_low[smaller], child_high[smaller], parent[smaller]

    lengths = child_high - child_low + 1
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ranks = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + child_low[owner]
    places, up = index.places[ranks], parent[owner]
    starts, periods = [], []
    for sign in (1, -1):
        other = places + sign * depth[up]
        fits = (other >= 0) & (other < size)
        rank = index.inverse[np.where(fits, other, 0)]
        fits &= (rank >= low[up]) & (rank <= high[up]) & ((rank < child_low[owner]) | (rank > child_high[owner]))
        starts.append(np.minimum(places, other)[fits])
        periods.append(depth[up][fits])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs by place and period; ``words`` are numbers, ``texts`` the rising number of the text of each word.

    A run repeats each of its words at least four times without another word between, so the words around which
    this fails are taken out first, again and again, which cuts the texts into pieces no run goes beyond.
    """
    kept = np.arange(len(words))
    pieces = texts.astype(np.int64)
    while len(kept):
        symbols = _numbered(pieces, words[kept])
        often = (np.bincount(symbols) >= LEAST_TURNS)[symbols]
        cut = np.ones(len(kept), bool)
        cut[1:] = (np.diff(kept) > 1) | (np.diff(pieces) > 0)
        # Pieces of words that are frequent in their former piece and stand side by side.
        starts = np.flatnonzero(often & (cut | ~np.concatenate([[False], often[:-1]])))
        piece = np.cumsum(np.bincount(starts, minlength=len(kept)))
        long_ = (np.bincount(piece[often], minlength=piece[-1] + 1) >= LEAST_WORDS)[piece]
        stays = often & long_
        if stays.all():
            break
        kept, pieces = kept[stays], piece[stays]
    if not len(kept):
        none = np.empty(0, np.int64)
        return none, none, none
    floors = _first_of_equals(pieces)
    ends = np.concatenate([np.flatnonzero(np.diff(pieces)) + 1, [len(pieces)]])
    ends = ends[np.searchsorted(ends, floors, "right")]
    index = SuffixArray(symbols, ends)
    starts, periods = branching_squares(index)
    stops = starts + 2 * periods
    starts = index.rotated(starts, periods, floors[starts])
    # Squares of one run end at one place, those of its multiple periods as well: the smallest period is the run's.
    order = np.lexsort((periods, stops, starts))
    starts, stops, periods = starts[order], stops[order], periods[order]
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1]) | (stops[1:] != stops[:-1])
    lengths = stops - starts
    new &= (lengths >= LEAST_TURNS * periods) & (lengths >= LEAST_WORDS)
    starts, lengths, periods = kept[starts[new]], lengths[new], periods[new]
    order = np.lexsort((periods, starts))
    return starts[order], lengths[order], periods[order]


def _numbered(pieces: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number for each (piece, word)."""
    keys = pieces * (int(words.max(initial=0)) + 1) + words
    return np.unique(keys, return_inverse=True)[1]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batch(batch: pa.RecordBatch, rearrange: Rearrange | None) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(texts_of(batch.column("text")))
    rows = batch.num_rows
    words = split.flatten()
    owners = pc.list_parent_indices(split).to_numpy()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words, owners = words.filter(pa.array(full)), owners[full]
    sizes = np.bincount(owners, minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if rearrange is not None:
        source = np.arange(len(owners))
        for row, places in enumerate(rearrange(batch.column("id").to_pylist(), sizes)):
            if places is not None:
                source[offsets[row]:offsets[row + 1]] = offsets[row] + places
        words = words.take(pa.array(source))
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    starts, lengths, periods = find_runs(codes, owners)

    dropped = np.zeros(len(codes) + 1, np.int64)
    np.add.at(dropped, starts + periods, 1)
    np.add.at(dropped, starts + lengths, -1)
    stays = np.cumsum(dropped[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(np.bincount(owners[stays], minlength=rows))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(kept), words.filter(pa.array(stays)))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    run_rows = owners[starts] if len(starts) else np.empty(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(run_rows, minlength=rows))]).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array(starts - offsets[run_rows]), pa.array(lengths), pa.array(periods)], fields=list(_RUN))
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), runs), collapsed.cast(pa.string())],
        names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rearrange: Rearrange | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, runs (array of start, length, period by start and period) and collapsed.

    Words are the stretches without blanks and U+0009 to U+000D, numbered from 0. A run is a stretch whose words
    ``period`` apart are identical, with the smallest such period, at least 6 words and 4 periods long, that no
    neighbour extends. ``collapsed`` holds the words of no run and the first period of each run, joined by one blank;
    a word that another run drops goes all the same. ``rearrange`` may give each word of a text another word's place first.

    NULL counts as empty text, which has no words and no runs. Each of several equal rows has its own row, ids may be NULL,
    other columns are ignored. No rows in, no rows out. Nothing is shuffled; texts are read whole in slices of a few MB,
    a longer one alone.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            yield _batch(batch, rearrange)

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    found = read.mapInArrow(
        find, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
