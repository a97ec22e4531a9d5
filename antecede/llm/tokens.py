"""Words of many texts at once, as arrays: positions and 64-bit hashes, without a Python step
per word."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_VALUES = np.random.Generator(np.random.Philox(42)).integers(1, 1 << 63, 1 << 16, np.uint64, endpoint=False) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``symbols[start:end]`` for each span: a polynomial over random values of
    the symbols (bytes or code points), modulo 2**64."""
    power, inverse = _powers(len(symbols) + 1)
    with np.errstate(over="ignore"):
        values = _VALUES[symbols.astype(np.uint16)]
        if symbols.dtype.itemsize > 2:
            values = values + (symbols >> 16).astype(np.uint64) * np.uint64(_INVERSE)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * power[: len(symbols)], dtype=np.uint64)))
        return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of anything but ASCII white space, A-Z lower-cased) in order, and
    for each text the position where its words begin (one more at the end)."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    first = np.concatenate(([0], np.searchsorted(starts, text_ends)))
    return span_hashes(data, starts, ends), first
