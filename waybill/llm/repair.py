"""Re-Pair grammars over shards of token ids, with numpy.

A round counts adjacent pairs, turns the most frequent ones into rules and replaces them all; rounds
repeat until no pair is frequent or the symbols are used up. After a round that took all frequent pairs
only pairs with a symbol of that round can be frequent, and the next one counts no others. Pairs never reach across documents, so
every document stays a run of whole symbols, and the rules' expansion lengths locate any token.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

#: A pair becomes a rule from this many occurrences on: a rule takes 12 bytes, and saves a symbol of 2
#: or 4 bytes an occurrence. Rules of a round at most.
LEAST_COUNT, RULES_PER_ROUND = 8, 4096
_BUCKET_BITS = 20


def _rules(pairs: np.ndarray, places: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(pairs that become rules, most frequent first, where they stand, which of them stands there, whether
    these are all frequent ones) of the pairs at `places`.

    Many pairs are first counted by hash bucket; those of the fullest buckets, twice as many as there can
    be rules, are counted exactly.
    """
    whole = True
    if len(pairs) > 1 << _BUCKET_BITS - 4:
        bits = pairs.dtype.itemsize * 8
        bucket = (pairs * pairs.dtype.type(0x9E3779B97F4A7C15 >> (64 - bits) | 1)) >> pairs.dtype.type(bits - _BUCKET_BITS)
        bucket = bucket.astype(np.int32)
        sizes = np.bincount(bucket, minlength=1 << _BUCKET_BITS)
        often = np.flatnonzero(sizes >= LEAST_COUNT)
        whole = len(often) <= 2 * most
        if not whole:
            often = often[np.argsort(-sizes[often], kind="stable")[: 2 * most]]
        full = np.zeros(1 << _BUCKET_BITS, dtype=bool)
        full[often] = True
        inside = np.flatnonzero(full[bucket])
        pairs, places = pairs[inside], places[inside]
    of, codes = pd.factorize(pairs)
    counts = np.bincount(of, minlength=len(codes))
    frequent = np.flatnonzero(counts >= LEAST_COUNT)
    chosen = frequent[np.lexsort((codes[frequent], -counts[frequent]))][:most]
    number = np.full(len(codes), -1, dtype=np.int64)
    number[chosen] = np.arange(len(chosen))
    of = number[of]
    return codes[chosen], places[of >= 0], of[of >= 0], whole and len(chosen) == len(frequent)


def compress(ids: np.ndarray, firsts: np.ndarray, vocabulary: int, symbols: int):
    """(symbols, firsts, rules): `firsts` marks the first symbol of each document.

    Rule k is symbol `vocabulary + k` and stands for its two symbols, each of them older than itself.
    """
    kind, half = (np.uint32, 16) if symbols <= 1 << 16 else (np.uint64, 32)
    sequence, rules = ids.astype(kind), np.zeros((0, 2), dtype=np.int64)
    places = np.flatnonzero(~firsts[1:])
    while True:
        room = min(RULES_PER_ROUND, symbols - vocabulary - len(rules))
        if room <= 0 or not len(places):
            break
        codes, at, of, whole = _rules(sequence[places] << kind(half) | sequence[places + 1], places, room)
        if not len(codes):
            break
        # Of overlapping occurrences, every second one from the left is replaced, which ends the others too.
        place = np.arange(len(at))
        opens = np.concatenate([[True], np.diff(at) > 1])
        use = (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
        at, of = at[use], of[use]
        sequence[at] = vocabulary + len(rules) + of
        keep = np.ones(len(sequence), dtype=bool)
        keep[at + 1] = False
        sequence, firsts = sequence[keep], firsts[keep]
        rules = np.concatenate([rules, np.stack([codes >> kind(half), codes & kind((1 << half) - 1)], axis=1).astype(np.int64)])
        inside = ~firsts[1:]
        if whole:
            # Each replaced pair before it moved a symbol one place to the left.
            new = at - np.arange(len(at))
            near = np.zeros(len(sequence), dtype=bool)
            near[new] = near[np.maximum(new - 1, 0)] = True
            inside &= near[:-1]
        places = np.flatnonzero(inside)
    return sequence, firsts, rules


def expansion_lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """Tokens that each rule stands for."""
    lengths = np.ones(vocabulary + len(rules), dtype=np.int64)
    for k, (left, right) in enumerate(rules.tolist()):
        lengths[vocabulary + k] = lengths[left] + lengths[right]
    return lengths[vocabulary:]


class Decoder:
    """Expands symbols by a table of all expansions, one after the other."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, vocabulary: int):
        self.lengths = np.concatenate([np.ones(vocabulary, dtype=np.int64), lengths])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.zeros(int(self.lengths.sum()), dtype=np.uint32)
        self.table[:vocabulary] = np.arange(vocabulary)
        # Rules of which both sides are done are expanded together, until all are.
        done = np.concatenate([np.ones(vocabulary, dtype=bool), np.zeros(len(rules), dtype=bool)])
        while not done.all():
            ready = np.flatnonzero(~done[vocabulary:] & done[rules[:, 0]] & done[rules[:, 1]])
            whole = self._gather(rules[ready].ravel())
            lengths_of = self.lengths[vocabulary + ready]
            self.table[ranges(self.starts[vocabulary + ready], lengths_of)] = whole
            done[vocabulary + ready] = True

    def _gather(self, symbols: np.ndarray) -> np.ndarray:
        return self.table[ranges(self.starts[symbols], self.lengths[symbols])]

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        return self._gather(symbols)

    def part(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Tokens `start` to `stop` of what the symbols stand for, expanding only those that hold them."""
        ends = np.cumsum(self.lengths[symbols])
        first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[first - 1]) if first else 0
        return self._gather(symbols[first:last])[start - before : stop - before]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
