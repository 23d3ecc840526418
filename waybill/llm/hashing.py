"""Hashed words and lines of whole Arrow batches of texts, with numpy over their bytes.

Nothing here makes Python objects per word: texts stay the bytes of the Arrow buffer, words are
positions in it, and their hashes are 64-bit sums over byte positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about this many bytes (one text at least), which bounds the memory.
RUN_BYTES = 1 << 19
U = np.uint64
_BASE, _K1, _K2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

_bytes = np.arange(256)
_BLANK = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
_UPPER = (_bytes >= 0x41) & (_bytes <= 0x5A)
_LOWERED = np.where(_UPPER, _bytes + 32, _bytes).astype(np.uint8)
_WORD = (_bytes >= 0x80) | ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A))
_NOT_WORD = ~_WORD

_powers = np.ones(1, dtype=U)


def powers(count: int) -> np.ndarray:
    """The first `count` powers of an odd base, modulo 2**64."""
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 1 << 10, 2 * len(_powers)), _BASE, dtype=U)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> U(30))) * _K1
    h = (h ^ (h >> U(27))) * _K2
    return h ^ (h >> U(31))


def salted(h: np.ndarray, salt: int) -> np.ndarray:
    return mixed(h + U(0x9E3779B97F4A7C15 * (salt + 1) % 2**64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges `starts:ends`; ranges are disjoint and in order."""
    out = np.zeros(len(starts), dtype=U)
    lengths = ends - starts
    full = np.flatnonzero(lengths)
    if len(full):
        at, size = starts[full], lengths[full]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        values = data[place + np.repeat(at, size)].astype(U) + U(1)
        out[full] = np.add.reduceat(values * powers(int(size.max()))[place], first)
    return mixed(out + lengths.astype(U))


@dataclass
class Run:
    """Some texts in a row: their bytes and where each begins and ends."""

    data: np.ndarray
    begins: np.ndarray
    lowered: bool
    breaks: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.begins) - 1

    @cached_property
    def _word_edges(self) -> tuple[np.ndarray, np.ndarray]:
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~self.breaks[self.data]
        steps = np.diff(inside)
        starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        # Texts that touch without a break between them: cut the word there.
        cuts = self.begins[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(self.data))])
        if len(cuts):
            cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
            if len(cuts):
                starts = np.sort(np.concatenate([starts, cuts]))
                ends = np.sort(np.concatenate([ends, cuts]))
        return starts, ends

    @property
    def word_starts(self) -> np.ndarray:
        return self._word_edges[0]

    @property
    def word_ends(self) -> np.ndarray:
        return self._word_edges[1]

    @cached_property
    def word_text(self) -> np.ndarray:
        """Which text each word is of."""
        return np.searchsorted(self.begins, self.word_starts, side="right") - 1

    @cached_property
    def byte_text(self) -> np.ndarray:
        """Which text each byte is of."""
        return np.repeat(np.arange(self.texts), np.diff(self.begins))

    @cached_property
    def lowered_data(self) -> np.ndarray:
        return _LOWERED[self.data] if self.lowered else self.data

    @cached_property
    def word_hash(self) -> np.ndarray:
        return hash_spans(self.lowered_data, self.word_starts, self.word_ends)

    @cached_property
    def exact_word_hash(self) -> np.ndarray:
        """Hashes of the words as they stand, whether the run is `lowered` or not."""
        return hash_spans(self.data, self.word_starts, self.word_ends) if self.lowered else self.word_hash

    @cached_property
    def words(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.word_text, minlength=self.texts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Set flags (one per byte) in each text."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.begins[1:]] - sums[self.begins[:-1]]

    def windows(self, n: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `n` words from each word on, and the first words of those inside one text.

        With `exact`, words are told apart by case in a `lowered` run as well.
        """
        h = self.exact_word_hash if exact else self.word_hash
        last = len(h) - n + 1
        if last <= 0:
            return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
        total = np.zeros(last, dtype=U)
        for i in range(n):
            total = total * _K1 + h[i : i + last]
        inside = np.flatnonzero(self.word_text[:last] == self.word_text[n - 1 :])
        return mixed(total[inside]), inside


def gathered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    """All batches of a task in one table; for bounded samples."""
    every = list(batches)
    return pa.Table.from_batches(every) if every else schema.empty_table()


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's lower-cased words, as in runs of `lowered` words of digits and letters."""
    found = list(runs(pa.array([text]), lowered=True, blank_words=False))
    return found[0][1].word_hash


def runs(column: pa.Array, lowered: bool, blank_words: bool) -> Iterator[tuple[int, Run]]:
    """The texts of a string column in runs, each with the row of its first text; null is empty.

    Words are what white space (U+0009 to U+000D, U+0020) parts or, without `blank_words`, digits,
    lower-case letters and everything from U+0080 on, after lower-casing when `lowered`.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    breaks = _BLANK if blank_words else _NOT_WORD[_LOWERED] if lowered else _NOT_WORD
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + RUN_BYTES, side="right")) - 1)
        end = min(end, len(column))
        part = offsets[row : end + 1]
        yield row, Run(data[part[0] : part[-1]], part - part[0], lowered, breaks)
        row = end
