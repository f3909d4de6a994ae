"""Many patterns looked up in many texts at once.

Spark's ``contains`` compares one pattern with one text.  The kernel below gets the patterns of a block once and the
texts as Arrow batches: per length of a pattern, the windows of that many bytes become 64-bit keys, a small table sorts
out nearly all of them, and what is left is compared byte by byte.  Its cost grows with the texts and the hits, not with
patterns times texts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The kernels travel with their tasks: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = 8
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of texts whose windows are formed together.
_CHUNK = 1 << 20
#: Rows of a batch of results.
_ROWS = 1 << 16


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings one after the other, and the edges between them."""
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


def _words(held: np.ndarray) -> np.ndarray:
    """The eight bytes at every place, as a view; zeros follow the end."""
    padded = np.concatenate([held, np.zeros(_WORD, np.uint8)])
    return np.ndarray((len(held),), "<u8", padded, strides=(1,))


def _levels(held: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Windows of 8 bytes as whole numbers, of 16, 32 ... bytes as their hashes, at every place."""
    out, size = {_WORD: _words(held).astype(np.uint64)}, _WORD
    while 2 * size <= longest:
        half = out[size]
        behind = np.zeros(len(half), np.uint64)
        behind[:-size] = half[size:]
        size *= 2
        out[size] = (half * _ODD ^ half >> np.uint64(29)) + behind * _ODD2
    return out


def _keys(levels: dict[int, np.ndarray], length: int, at: np.ndarray | slice) -> np.ndarray:
    """Key of the window of ``length`` bytes at each place; up to 8 bytes equal keys are equal bytes."""
    word = levels[_WORD]
    if length <= _WORD:
        return (word[at] & np.uint64((1 << 8 * length) - 1)) * _ODD
    size = _WORD << ((length // _WORD).bit_length() - 1)
    own = levels[size]
    return own[at] * _ODD + own[np.minimum(at + (length - size), len(own) - 1)] * _ODD2


class _Keyed:
    """Patterns by key, behind a table of the keys' leading bits."""

    def __init__(self, keys: np.ndarray, patterns: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.patterns = patterns[order]
        bits = min(max(len(keys) * 32, 1 << 10).bit_length(), 22)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.keys >> self.shift] = True

    def likely(self, keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[keys >> self.shift])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the keys, and the pattern found there; patterns that share a key all come."""
        at = self.likely(keys)
        wanted = keys[at]
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[place] == wanted
        at, place = at[hit], place[hit]
        count = self.count[place]
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(at, count), self.patterns[np.repeat(self.first[place], count) + nth]


class Finder:
    """Finds every one of its patterns in texts."""

    def __init__(self, patterns: pa.Array):
        held, edges = _bytes_of(patterns)
        self.size, sizes = len(patterns), np.diff(edges)
        self.starts, self.longest = edges[:-1], int(sizes.max(initial=0))
        self.words, self.short, self.long = _words(held), {}, {}
        for length in np.unique(sizes[sizes > 0]).tolist():
            own = np.flatnonzero(sizes == length)
            keys = [
                _keys(_levels(held[self.starts[some][:, None] + np.arange(length)].ravel(), length), length, np.arange(len(some)) * length)
                for some in np.array_split(own, -(-len(own) * length // _CHUNK))
            ]
            (self.short if length <= _WORD else self.long)[length] = _Keyed(np.concatenate(keys), own)
        own = np.flatnonzero(sizes > _WORD)
        # what is longer than a word is looked for only where its first eight bytes may stand
        self.heads = _Keyed(_keys({_WORD: self.words}, _WORD, self.starts[own]), own) if len(own) else None

    def _same(self, words: np.ndarray, at: np.ndarray, pattern: np.ndarray, length: int) -> np.ndarray:
        inside = np.flatnonzero(at + length <= len(words))
        for step in [*range(0, length - _WORD, _WORD), length - _WORD]:
            inside = inside[words[at[inside] + step] == self.words[self.starts[pattern[inside]] + step]]
        return inside

    def _hits(self, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        levels = _levels(held, self.longest)
        for length, keyed in self.short.items():
            yield *keyed.find(_keys(levels, length, slice(None))), length
        if self.heads is None:
            return
        likely = self.heads.likely(_keys(levels, _WORD, slice(None)))
        for length, keyed in self.long.items():
            found, pattern = keyed.find(_keys(levels, length, likely))
            at = likely[found]
            same = self._same(levels[_WORD], at, pattern, length)
            yield at[same], pattern[same], length

    def pairs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of texts and of patterns that occur in them, each pair once."""
        if not self.size or not len(texts):
            return
        held, edges = _bytes_of(texts)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + _CHUNK, "right")) - 1)
            own = edges[first : last + 1] - edges[first]
            codes = [np.zeros(0, np.int64)]
            for at, pattern, length in self._hits(held[edges[first] : edges[last]]):
                text = np.searchsorted(own, at, "right") - 1
                inside = at + length <= own[text + 1]
                codes.append(np.unique(text[inside] * self.size + pattern[inside]))
            # a pattern has one length, so the lists share no pair
            code = np.concatenate(codes)
            yield first + code // self.size, code % self.size
            first = last


def _edges(batch: pa.RecordBatch, keys: Sequence[str]) -> list[int]:
    """Rows at which a key differs from that of the row before, the first and the end included."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for c in keys:
        new |= pc.not_equal(batch.column(c)[1:], batch.column(c)[:-1]).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]


def finder_of_runs(keys: Sequence[str], pattern: str, text: str, block: Sequence[str], take: Sequence[str]) -> Callable:
    """For ``mapInArrow``: rows sorted by ``keys``, in each run first those with a pattern, then those with a text.

    Gives ``block`` and ``pattern`` of the pattern's row and ``take`` of the text's row.  A run's patterns are held, its texts pass by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, finder = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = _edges(batch, keys)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows = batch.slice(a, b - a)
                key = tuple(rows.column(c)[0].as_py() for c in keys)
                if key != current:
                    current, held, finder = key, [], None
                is_pattern = pc.is_valid(rows.column(pattern))
                some = rows.filter(is_pattern)
                if some.num_rows:
                    held.append(some.select([*block, pattern]))
                texts = rows.filter(pc.invert(is_pattern))
                if not held or not texts.num_rows:
                    continue
                if finder is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    finder = Finder(table.column(pattern).combine_chunks())
                for of_text, of_pattern in finder.pairs(texts.column(text)):
                    for i in range(0, len(of_text), _ROWS):
                        found, where = table.take(pa.array(of_pattern[i : i + _ROWS])), pa.array(of_text[i : i + _ROWS])
                        columns = [*found.columns, *(texts.column(c).take(where) for c in take)]
                        yield from pa.table(columns, names=[*block, pattern, *take]).combine_chunks().to_batches()

    return run
