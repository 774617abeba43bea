"""CRC-32C of many byte ranges at once, in NumPy.

The checksum is linear over bits: a block's value is the exclusive or of one table entry per byte, chosen by the byte and its
distance from the block's end, and a block is appended by shifting the state over its length with four tables.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the checksum: reflected polynomial, start and end value, mask added to stored checksums.
POLYNOMIAL = 0x82F63B78
ONES = np.uint32(0xFFFFFFFF)
MASK_DELTA = np.uint32(0xA282EAD8)

BLOCK = 128


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


_BYTE = _byte_table()


def _over_zero(state: np.ndarray) -> np.ndarray:
    return _BYTE[state & 255] ^ (state >> 8)


def _places() -> np.ndarray:
    rows = [_BYTE]
    for _ in range(BLOCK - 1):
        rows.append(_over_zero(rows[-1]))
    return np.stack(rows[::-1])


def _shifts() -> np.ndarray:
    states = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for _ in range(BLOCK):
        states = _over_zero(states)
    return states


_PLACE, _SHIFT = _places(), _shifts()


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums of data[starts[i]:ends[i]]; ``data`` are bytes, each range has at least four."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint32)
    sizes = ends - starts
    blocks = -(-sizes // BLOCK)
    stops = np.cumsum(blocks) * BLOCK
    first = np.cumsum(blocks) - blocks
    filled = np.zeros(int(stops[-1]), np.uint8)  # the first block of a range is filled up with zeros in front
    for a, b, size, stop in zip(starts.tolist(), ends.tolist(), sizes.tolist(), stops.tolist()):
        filled[stop - size:stop] = data[a:b]
    filled[(stops - sizes)[:, None] + np.arange(4)] ^= np.uint8(255)  # the start value
    sums = np.zeros(len(filled) // BLOCK, np.uint32)
    for table, column in zip(_PLACE, np.ascontiguousarray(filled.reshape(-1, BLOCK).T)):
        sums ^= table.take(column, mode="clip")  # a byte is always in range; clipping skips the check

    order = np.argsort(-blocks, kind="stable")
    state = np.zeros(n, np.uint32)
    for k in range(int(blocks.max())):
        some = order[:np.searchsorted(-blocks[order], -k, "left")]  # those with more than k blocks
        s = state[some]
        state[some] = _SHIFT[0, s & 255] ^ _SHIFT[1, s >> 8 & 255] ^ _SHIFT[2, s >> 16 & 255] ^ _SHIFT[3, s >> 24] ^ sums[first[some] + k]
    return state ^ ONES


def masked(crc: np.ndarray) -> np.ndarray:
    """Stored form: rotated by 15 bits and shifted by a constant, so that a checksum of checksums isn't a trap."""
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + MASK_DELTA
