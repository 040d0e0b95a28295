"""Vectorised helpers over the bytes of many texts: words, window hashes, stable orders.

All hashes are 64-bit.  Equal hashes count as equal strings; callers say so.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1            # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SLICE = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_up, _down = powers(BASE, SLICE), powers(INVERSE, SLICE)
_byte = np.random.default_rng(20).integers(1, 2 ** 63, 256, dtype=U) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + U((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64)))


def prefix_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For ascending positions: the sum of byte codes times powers over all bytes before."""
    out, total, lead = np.empty(len(at), U), U(0), U(1)
    step = U(pow(BASE, SLICE, 1 << 64))
    for a in range(0, len(data) + 1, SLICE):
        piece = data[a:a + SLICE]
        sums = np.zeros(len(piece) + 1, U)
        np.cumsum(_byte[piece] * _up[:len(piece)], out=sums[1:])
        lo, hi = np.searchsorted(at, [a, a + SLICE])
        out[lo:hi] = total + sums[at[lo:hi] - a] * lead
        total = total + sums[-1] * lead
        lead = lead * step
    return out


def down_power(at: np.ndarray) -> np.ndarray:
    far = powers(pow(INVERSE, SLICE, 1 << 64), int(at.max(initial=0)) // SLICE + 1)
    return _down[at % SLICE] * far[at // SLICE]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair; starts ascend, and so do ends."""
    with np.errstate(over="ignore"):
        if (start[1:] >= end[:-1]).all():       # spans one after the other: all places in one pass
            both = prefix_at(data, np.column_stack([start, end]).ravel())
            raw = (both[1::2] - both[::2]) * down_power(start)
        else:
            raw = (prefix_at(data, end) - prefix_at(data, start)) * down_power(start)
        return mix(raw + mix((end - start).astype(U)))


def window_hash(items: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of `width` consecutive item hashes."""
    n = len(items) - width + 1
    if n <= 0:
        return np.empty(0, U)
    factor = powers(0xD6E8FEB86659FD93, width)
    with np.errstate(over="ignore"):
        total = items[:n] * factor[0]
        for j in range(1, width):
            total += items[j:j + n] * factor[j]
        return seeded(total, seed + width)


def joined(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with `gap` after each, and where each begins (and the end)."""
    data = np.frombuffer(gap.join(texts) + gap, np.uint8) if texts else np.empty(0, np.uint8)
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    return data, np.concatenate([[0], np.cumsum(sizes)])


_gap = np.zeros(256, bool)
_gap[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without blank and control white space (a gap ends the data)."""
    gap = _gap[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def order_of(values: np.ndarray) -> np.ndarray:
    """A stable ascending order of unsigned 64-bit values, by all bits a packed sort can hold.

    Values that agree in their upper 64 - log2(n) bits stay in their given order.
    """
    bits = U(max(1, int(len(values)).bit_length()))
    packed = (values >> bits << bits) | np.arange(len(values), dtype=U)
    packed.sort()
    return (packed & ((U(1) << bits) - U(1))).astype(np.int64)


def groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group of each ordered place, first place of each group) of equal values.

    Equal values may rarely be dealt over several groups; unequal ones never share one.
    """
    order = order_of(values)
    sorted_values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)
