"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words that has a period (words that far apart are identical),
is at least twice that period and ``min_length`` words long, and can't be extended to either side.

1. The words of the texts of a piece of work become integers, one sequence for all of
   them with a symbol of its own between texts, so nothing ever matches across texts.
2. ``Grammar``: recompression. Block compression replaces each maximal repetition a^k by a symbol
   (a, k); pair compression deals the symbols to two sides by a hash and replaces each pair of a left and
   a right symbol by one symbol. The two alternate. Equal stretches get equal symbols, whatever is around them,
   but for a few symbols at their edges. Levels are built when a query needs them.
3. Candidates: for period p, a run makes at least ``need`` = max(p, min_length - p) consecutive words equal to those p
   further on, so one of them lies on the grid of multiples of ``need``. Over all p the grids are a harmonic sum:
   n log n places. A place whose word differs from that p further on is no candidate.
4. From a candidate, the exact extension to the right and to the left is the longest common
   extension of the two places (``Grammar.extend``): it climbs the levels while the symbols agree and goes
   down again at the first difference, a constant number of steps a level. All candidates move together.
5. A stretch that is found with several periods keeps the smallest.

``drop`` marks the words that a run repeats: all of it but its first period.

Edge cases: null, empty and blank texts have no words and no runs. Rows are taken one by one, so
repeated rows, null and repeated ids each give a row. Very long texts are looked at whole; memory
follows the longest text (all grid places are taken in chunks of ``CHUNK``). An empty table gives an empty result. Columns beside
``id_col`` and ``text_col`` aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, utf8

MIN_LENGTH = 12
#: Bytes of text that are looked at together.
PIECE = 1 << 21
#: Grid places that are looked at together.
CHUNK = 1 << 20

RUNS = "array<struct<start: long, length: long, period: long>>"

# The white space that separates words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Level:
    """A string of symbols; ``start`` says where each begins in the level below, ``parent`` which one holds each symbol of that level."""

    def __init__(self, symbols: np.ndarray, names: int, start: np.ndarray | None = None, parent: np.ndarray | None = None, blocks: bool = False):
        self.symbols, self.names, self.start, self.parent, self.blocks = symbols, names, start, parent, blocks

    def _named(self, start: np.ndarray, parent: np.ndarray, made: np.ndarray, keys: np.ndarray, blocks: bool) -> Level:
        """The next level: symbols at ``made`` get a new name for each different key, the others stay."""
        symbols = self.symbols[start[:-1]]
        different, which = np.unique(keys, return_inverse=True)
        symbols[made] = self.names + which
        return Level(symbols, self.names + len(different), start.astype(np.int32), parent.astype(np.int32), blocks)

    def compress_blocks(self) -> Level:
        s = self.symbols
        start = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]])
        times = np.diff(start)
        made = np.flatnonzero(times > 1)
        keys = (s[start[made]].astype(np.int64) << 32) | times[made]
        return self._named(start, np.repeat(np.arange(len(times)), times), made, keys, True)

    def compress_pairs(self, salt: int) -> Level:
        s = self.symbols
        mixed = (s.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        left = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 0
        second = np.concatenate([[False], left[:-1] & ~left[1:]])
        first = np.flatnonzero(~second)
        start = np.append(first, len(s))
        made = np.flatnonzero(np.diff(start) > 1)
        keys = (s[first[made]].astype(np.int64) << 32) | s[first[made] + 1]
        return self._named(start, np.cumsum(~second) - 1, made, keys, False)


class Grammar:
    """Levels of a sequence whose first and last symbol occur once."""

    def __init__(self, symbols: np.ndarray):
        self.levels = [Level(symbols.astype(np.int32), int(symbols.max(initial=0)) + 1)]

    def level(self, k: int) -> Level:
        while len(self.levels) <= k:
            top = self.levels[-1]
            self.levels.append(top.compress_blocks() if len(self.levels) % 2 else top.compress_pairs(len(self.levels)))
        return self.levels[k]

    def extend(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from x and from y on (x < y), to the right (step 1) or to the left (step -1)."""
        begin, which = x, np.arange(len(x))
        out = np.zeros(len(x), np.int64)
        stopped: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        edge = step < 0
        # up: a query stays while its symbols agree
        while len(which):
            k = len(stopped)
            s = self.level(k).symbols
            same = s[x] == s[y]
            stopped.append([(which[~same], x[~same], y[~same])])
            which, x, y = which[same], x[same], y[same]
            if not len(which):
                break
            up = self.level(k + 1)
            of_x, of_y = up.parent[x], up.parent[y]
            edge_x, edge_y = up.start[of_x + edge] - edge, up.start[of_y + edge] - edge  # where a whole symbol would begin in our direction
            whole = (x == edge_x) & (y == edge_y)
            if up.blocks:  # inside a block the shorter rest decides
                rest_x, rest_y = (np.abs(up.start[of + (not edge)] - (not edge) - at) + 1 for of, at in ((of_x, x), (of_y, y)))
                ends = ~whole & (rest_x != rest_y)
                go = step * np.minimum(rest_x, rest_y)[ends]
                stopped[k].append((which[ends], x[ends] + go, y[ends] + go))
                of_x, of_y, whole, which = of_x[~ends], of_y[~ends], whole[~ends], which[~ends]
            go = np.where(whole, 0, step)
            x, y = of_x + go, of_y + go
        # down: the symbols differ; what they have in common lies in their first parts
        which, x, y = (np.zeros(0, np.int64) for _ in range(3))
        for k in reversed(range(len(stopped))):
            which, x, y = (np.concatenate(parts) for parts in zip((which, x, y), *stopped[k]))
            if k == 0:
                break
            here, s = self.levels[k], self.levels[k - 1].symbols
            size = np.minimum(here.start[x + 1] - here.start[x], here.start[y + 1] - here.start[y]) if here.blocks else 1
            x, y = here.start[x + edge] - edge, here.start[y + edge] - edge
            go = np.where(s[x] == s[y], step * size, 0)
            x, y = x + go, y + go
        out[which] = np.abs(x - begin[which])
        return out


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, in this order, from the words (integers) of texts of the given sizes."""
    order = np.argsort(-sizes, kind="stable")  # long texts first: those that can hold a period are in front
    size = sizes[order]
    begin = np.concatenate([[0], np.cumsum(sizes)])[order]
    offset = 1 + np.concatenate([[0], np.cumsum(size + 1)])  # place 0 and the one after each text are symbols of their own
    n = int(offset[-1])
    text_of = np.repeat(np.arange(len(size)), size + 1)
    symbols = np.empty(n, np.int64)
    top = int(words.max(initial=-1)) + 1
    symbols[0] = top
    symbols[offset[1:] - 1] = top + 1 + np.arange(len(size))
    inside = np.ones(n, bool)
    inside[0] = False
    inside[offset[1:] - 1] = False
    symbols[inside] = words[np.repeat(begin - (offset[:-1] - 1 - np.arange(len(size))), size) + np.arange(len(words))]
    text_of = np.concatenate([[-1], text_of])
    grammar = Grammar(symbols)
    symbols = grammar.levels[0].symbols

    found = []
    longest = int(size[0]) if len(size) else 0
    periods = np.arange(1, longest // 2 + 1 if longest >= min_length else 1)
    need = np.maximum(periods, min_length - periods)
    texts = np.searchsorted(-size, -np.maximum(min_length, 2 * periods), "right")  # texts that are long enough
    places = -(-(offset[texts]) // need)
    until = np.cumsum(places)
    at = 0
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + CHUNK, "right")))
        p, step = (np.repeat(v[at:to], places[at:to]) for v in (periods, need))
        x = (np.arange(len(p)) - np.repeat(until[at:to] - places[at:to] - (until[at - 1] if at else 0), places[at:to])) * step
        some = x + p < n
        some[some] = symbols[x[some]] == symbols[(x + p)[some]]
        x, p, step = x[some], p[some], step[some]
        some = text_of[x] == text_of[x + p]
        x, p, step = x[some], p[some], step[some]
        right = grammar.extend(x, x + p, 1)
        left = grammar.extend(x - 1, x + p - 1, -1)
        some = (left + right >= step) & (left < step)  # else too short, or the grid's place before is in this run too
        found.append(np.stack([(x - left)[some], (p + left + right)[some], p[some]]))
        at = to
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])  # the smallest period of a stretch
    start, length, period = start[first], length[first], period[first]
    text = text_of[start]
    start = start - offset[text]
    text = order[text]
    by = np.lexsort((period, start, text))
    return text[by], start[by], length[by], period[by]


def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, one after the other; size of each word; number of words of each text)."""
    solid = ~_SPACE[raw]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    start[cuts] = solid[cuts]
    places = np.flatnonzero(start)
    data = raw[solid]
    begin = (np.cumsum(solid) - 1)[places]
    return data, np.diff(np.append(begin, len(data))), np.diff(np.searchsorted(places, offsets))


def word_numbers(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return words.dictionary_encode().indices.to_numpy()


def _joined(data: np.ndarray, sizes: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """Per text its kept words, joined by one space."""
    spaced = np.full(len(data) + len(sizes), 0x20, np.uint8)
    places = np.ones(len(spaced), bool)
    places[np.cumsum(sizes + 1) - 1] = False
    spaced[places] = data
    if not keep.all():
        spaced = spaced[np.repeat(keep, sizes + 1)]
    ends = np.concatenate([[0], np.cumsum((sizes + 1) * keep)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [spaced[a:max(a, b - 1)].tobytes() for a, b in zip(ends, ends[1:])]


def _row_groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows that are taken together: at most about ``most`` bytes, or one longer text."""
    row = 0
    while row < len(offsets) - 1:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, to
        row = to


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, runs (in order of start and period) and collapsed (the text's words without what runs repeat)."""
    kind = docs.select(F.col(id_col).alias(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch, "__text")
            for row, to in _row_groups(offsets, PIECE):
                data, sizes, counts = split_words(raw[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row])
                text, start, length, period = find_runs(word_numbers(data, sizes), counts, min_length)
                first = np.concatenate([[0], np.cumsum(counts)])[text]
                change = np.zeros(len(sizes) + 1, np.int64)
                np.add.at(change, first + start + period, 1)
                np.add.at(change, first + start + length, -1)
                keep = np.cumsum(change)[:-1] == 0
                fields = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start, length, period)], ["start", "length", "period"])
                ends = np.searchsorted(text, np.arange(to - row + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), pa.array(counts, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields),
                     pa.array(_joined(data, sizes, counts, keep), pa.binary()).cast(pa.string())],
                    names=[id_col, "n_words", "runs", "collapsed"])

    return small_batches(docs).select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, runs {RUNS}, collapsed string")
