"""Sets of word shingles of whole texts, hashed to 64 bits with numpy.

Words are runs without ASCII white space, A-Z lower-cased. A word's hash is a
polynomial of random byte values modulo 2^64, taken from running sums over the
UTF-8 bytes of many texts at once; a shingle mixes the hashes of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (a common finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    def __init__(self, size: int = 5, seed: int = 77) -> None:
        rng = np.random.default_rng(seed)
        self.size = size
        value = rng.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
        value[65:91] = value[97:123]  # A-Z as a-z
        self._value = value
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self._space = space
        self._base = int(rng.integers(1, 1 << 62)) * 2 + 1
        self._inverse = pow(self._base, -1, 1 << 64)
        self._factors = rng.integers(1, 1 << 62, size, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self._short = rng.integers(1, 1 << 62, size + 1, dtype=np.int64).astype(np.uint64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n + 1:
            for name, base in (("_powers", self._base), ("_inverses", self._inverse)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the words, byte where each begins); ``starts``: where texts begin."""
        n = len(data)
        if not n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        self._grow(n)
        inside = ~self._space[data]
        edge = np.zeros(n + 1, bool)
        edge[starts] = True
        edge[n] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        at, to = np.flatnonzero(first), np.flatnonzero(last)
        sums = np.cumsum(self._value[data] * self._powers[:n], dtype=np.uint64)
        before = np.where(at > 0, sums[at - 1], np.uint64(0))
        word = (sums[to] - before) * self._inverses[at]
        return _mixed(word + (to - at).astype(np.uint64)), at

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        word, at = self._words(data, starts[lengths > 0])
        bounds = np.searchsorted(at, np.append(starts, len(data)))
        return self._sets(word, bounds)

    def _sets(self, word: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        k, out = self.size, []
        full = np.zeros(max(0, len(word) - k + 1), np.uint64)
        for j in range(k if len(full) else 0):
            full += word[j : j + len(full)] * self._factors[j]
        full = _mixed(full)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            n = b - a
            if n >= k:
                s = np.sort(full[a : b - k + 1])
                out.append(s[np.append(True, s[1:] != s[:-1])])
            elif n:
                out.append(_mixed((word[a:b] * self._factors[:n]).sum(keepdims=True, dtype=np.uint64) + self._short[n]))
            else:
                out.append(np.empty(0, np.uint64))
        return out

    def _long(self, text: bytes) -> np.ndarray:
        """The set of one long text, whose words are hashed a segment at a time."""
        parts, lo = [], 0
        while lo < len(text):
            hi = min(len(text), lo + SEGMENT)
            while hi < len(text) and not self._space[text[hi]]:
                hi += 1
            parts.append(self._words(np.frombuffer(text, np.uint8, hi - lo, lo), np.zeros(1, np.int64))[0])
            lo = hi
        word = np.concatenate(parts)
        return self._sets(word, np.array([0, len(word)]))[0]

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of each text, in order; null has none."""
        group, size = [], 0
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            if len(raw) > SEGMENT:
                yield from self._group(group) if group else ()
                group, size = [], 0
                yield self._long(raw)
                continue
            group.append(raw)
            size += len(raw)
            if size >= SEGMENT:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingles."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
