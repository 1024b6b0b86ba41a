"""Hashes of words and word windows of many texts at once (numpy)."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TOP = _U(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), _U)
    done, factor = 1, base
    while done < n:  # doubling: out[k:2k] = out[:k] * base**k
        k = min(done, n - done)
        out[done : done + k] = out[:k] * _U(factor)
        factor = factor * factor % (1 << 64)
        done += k
    return out


class _Powers:
    """base**i and base**-i modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


_P1 = _Powers(_BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sums(values: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end]."""
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


class Words:
    """The words of a list of UTF-8 texts, split at ASCII white space.

    hashes: one 64-bit hash for each word; counts, starts: words of each text
    and the place of its first; doc: the text of each word.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[raw]
        begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        self.hashes = mixed(_sums(raw.astype(_U) + _U(1), _P1, begin, end) + (end - begin).astype(_U))
        edges = np.cumsum([1] + [len(t) + 1 for t in texts])
        self.starts = np.searchsorted(begin, edges[:-1])
        self.counts = np.diff(np.append(self.starts, len(begin)))
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def place(self) -> np.ndarray:
        """Each word's number in its text."""
        return np.arange(len(self.hashes)) - np.repeat(self.starts, self.counts)

    def valid(self, k: int) -> np.ndarray:
        """Whether a window of k words that starts at a word lies in its text."""
        return np.repeat(self.starts + self.counts, self.counts) - np.arange(len(self.hashes)) >= k

    def windows(self, k: int, at: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the windows of k words at ``at`` (all places: those past the end are meaningless)."""
        n = len(self.hashes)
        at = np.arange(n) if at is None else at
        return mixed(_sums(self.hashes, _P1, at, np.minimum(at + k, n)))


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over x[i:i+width], cut off at the end."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = pick(out[:-step], out[step:]) if step < len(out) else out[:-step]
        have += step
    return out


def least(words: Words, k: int, whole: int) -> np.ndarray:
    """For each place the smallest hash of the windows of k words inside the window of
    ``whole`` words that starts there; the largest number where that would leave the text."""
    x = np.minimum(words.windows(k), _TOP - _U(1))
    return np.where(words.valid(whole), sliding(x, whole - k + 1, np.minimum), _TOP)


def anchors(words: Words, k: int, whole: int, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: places and hashes of the windows of k words that are the smallest
    inside some window of ``whole`` words of those that start where ``of`` is true.

    Equal windows of ``whole`` words have equal smallest ones, wherever they are.
    """
    x = np.minimum(words.windows(k), _TOP - _U(1))
    # a window is chosen if it is the least of some place up to the span before it
    chosen = sliding(np.where(of, least(words, k, whole), _U(0))[::-1], whole - k + 1, np.maximum)[::-1]
    at = np.flatnonzero((chosen == x) & (chosen > 0))
    return at, x[at]
