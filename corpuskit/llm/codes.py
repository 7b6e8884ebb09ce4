"""Directly addressable codes: variable-length numbers with random access to each.

A number is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every number and a bit that says whether the number
goes on; level 1 holds the next chunk of those that do, and so on. The place of a number on the next level is the count of
set bits before it, read from a directory of counts per block of 512 bits and one block of the bitmap: no other number is decoded.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 512

Level = tuple[bytes, bytes, bytes]  # chunks, continuation bitmap, rank directory


def pack(numbers: np.ndarray) -> list[Level]:
    rest, levels = numbers.astype(np.uint64), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(bits), 1) // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), np.uint8)
        padded[: len(bits)] = bits
        counts = np.bitwise_count(padded.reshape(-1, BLOCK_BITS // 8)).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4")
        levels.append(((rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        if not more.any():
            return levels
        rest = rest[more] >> np.uint64(8)


def unpack(levels: list[Level]) -> np.ndarray:
    """All numbers."""
    chunks, bits, _ = levels[0]
    out = np.frombuffer(chunks, np.uint8).astype(np.uint64)
    places = np.arange(len(out))
    for depth, (chunks, _, _) in enumerate(levels[1:], 1):
        more = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(places), bitorder="little").astype(bool)
        places, bits = places[more], levels[depth][1]
        out[places] |= np.frombuffer(chunks, np.uint8).astype(np.uint64) << np.uint64(8 * depth)
    return out


def at(levels: list[Level], place: int) -> int:
    """One number, read directly."""
    value = 0
    for depth, (chunks, bits, ranks) in enumerate(levels):
        value |= chunks[place] << 8 * depth
        if not bits[place >> 3] >> (place & 7) & 1:
            return value
        block = place // BLOCK_BITS
        first = block * BLOCK_BITS // 8
        before = int.from_bytes(bits[first : (place >> 3) + 1], "little") & ((1 << (place - first * 8)) - 1)
        place = int.from_bytes(ranks[4 * block : 4 * block + 4], "little") + before.bit_count()
    raise ValueError("the last level goes on")
