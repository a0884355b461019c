"""Content-defined anchors: places that equal stretches of text choose alike."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, up to the longest text seen."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up = _powers(_BASE, n)
            self.down = _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_codes(raw: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """A 64-bit code of the ``size`` bytes from each place on."""
    n = len(raw) - size + 1
    up, down = powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + 1) * up[:-1], out=sums[1:])
    code = (sums[size:] - sums[:n]) * down[:n]
    code ^= code >> 32
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> 29
    code *= np.uint64(0x94D049BB133111EB)
    code ^= code >> 32
    return code


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` consecutive values."""
    n = len(values) - size + 1
    if size == 1:
        return values.copy()
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[size - 1 : size - 1 + n])


def anchored(raw: np.ndarray, window: int, gram: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: its code, its place, the first and the last window.

    The anchor of a window is its ``gram`` bytes of smallest code, the first of
    equal ones. Equal windows have it at the same distance from their start.
    """
    if len(raw) < window:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    codes = gram_codes(raw, gram, powers)
    places = np.arange(len(codes), dtype=np.uint64)
    keyed = (codes & np.uint64(0xFFFFFFFF00000000)) | places
    anchor = (sliding_minimum(keyed, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    firsts = np.append(0, np.flatnonzero(np.diff(anchor)) + 1)
    lasts = np.append(firsts[1:], len(anchor)) - 1
    return codes[anchor[firsts]], anchor[firsts], firsts, lasts
