"""Byte-level word kernels in numpy, shared by the operators that run in Arrow batches.

Texts are handled as UTF-8 bytes: lower-casing A-Z and the word classes used here only
concern ASCII bytes, so nothing needs decoding.  Batches are cut into groups of about a
megabyte, so the temporary arrays stay small whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Words between white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n-1, modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * GROUP_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        _powers[int(base)] = have = np.multiply.accumulate(steps)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about ``most`` bytes, each with its first row number."""
    first, size, run = 0, 0, []
    for row, value in enumerate(column):
        text = value.as_py() or b""
        if run and size + len(text) > most:
            yield first, run
            first, size, run = row, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield first, run


class Words:
    """The words of some texts: byte positions, owner, and one 64-bit hash each."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        joined = b"\n".join(texts) + b"\n"
        self.raw = np.frombuffer(joined, dtype=np.uint8)
        self.bytes = LOWER[self.raw]
        inside = np.zeros(len(joined) + 1, dtype=np.int8)
        inside[1:] = is_word[self.bytes]
        edge = np.diff(inside)
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate(([0], np.cumsum(sizes)))
        #: words of text i are first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, self.text_starts)

    def word(self, i: int) -> str:
        return self.bytes[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")

    def span(self, a: int, b: int) -> list[str]:
        return [self.word(i) for i in range(a, b)]

    def hashes(self) -> np.ndarray:
        """Equal words have equal hashes; computed from prefix sums of byte * odd**position."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(self.starts):
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + GROUP_BYTES, "right")))
            stop = self.ends[to - 1]
            n = int(stop - base)
            terms = (self.bytes[base:stop].astype(np.uint64) + np.uint64(1)) * _power_table(_ODD, n)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            a, b = self.starts[at:to] - base, self.ends[at:to] - base
            out[at:to] = (sums[b] - sums[a]) * _power_table(_ODD_INVERSE, n)[a]
            at = to
        return mixed(out)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every ``size`` consecutive words; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for j in range(size):
        total = total * _ODD + words[j:j + n]
    return mixed(total)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, in log2 steps."""
    step = 1
    while step * 2 <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[:-rest], values[rest:]) if rest else values


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of some window of ``width`` neighbours (all of a tie)."""
    if len(values) < width:
        return np.empty(0, dtype=np.int64)
    least = _sliding(values, width, np.minimum)
    edge = np.zeros(width - 1, dtype=values.dtype)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), width, np.maximum) == values)
