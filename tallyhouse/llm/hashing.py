"""64-bit hashes of many byte ranges at once, the same in every process."""

from __future__ import annotations

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def range_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the ranges of bytes ``data[start : start + length]``, none empty, in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(int(lengths.max()), _BASE))
        values = _BYTE[data[place + np.repeat(starts, lengths)]] * power[place]
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def joined(texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array of bytes with ``gap`` around each; where each starts, and ends."""
    lengths = np.array([len(x) for x in texts], np.int64)
    starts = np.cumsum(lengths + len(gap)) - lengths
    return np.frombuffer(gap.join([b"", *texts, b""]), np.uint8), starts, starts + lengths
