"""Sorted runs of strings of one length: front coding, and a merge that never compares a known prefix again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings that agree up to `start`."""
    n = min(len(a), len(b))
    if a[start : start + 16] != b[start : start + 16]:
        n = min(n, start + 16)
    differ = int.from_bytes(a[start:n]) ^ int.from_bytes(b[start:n])
    return n - (differ.bit_length() + 7) // 8


def prefixes(keys: list[bytes]) -> list[int]:
    """Common prefix of each sorted key with the one before it."""
    return [0, *(common(a, b) for a, b in zip(keys, keys[1:], strict=False))][: len(keys)]


def encode(keys: list[bytes], shared: list[int]) -> bytes:
    """Front-coded: what each key shares with the last, and the rest of it."""
    head = np.array(shared, "<u2").tobytes()
    body = b"".join([len(keys).to_bytes(4, "little"), head, *(k[s:] for k, s in zip(keys, shared, strict=True))])
    return zstandard.compress(body, 1)


def decode(data: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(shared, key) one after the other; all keys have `width` bytes."""
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    at, key = 4 + 2 * n, b""
    for shared in np.frombuffer(raw, "<u2", n, 4).tolist():
        end = at + width - shared
        key = key[:shared] + raw[at:end]
        at = end
        yield shared, key


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(shared with the last key, key, run) over all runs in order: a loser tree that keeps common prefixes.

    Each loser keeps the length of the prefix it shares with the winner that passed it, which is the key given out last. Of two such keys
    the one that shares more comes first, without looking at either; only if both share the same are bytes compared, from there on. A
    key that comes after its run's last key brings that length along from the front coding.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [None] * size
    shared = [-1] * size  # of a run that has ended: below all others

    def pull(i: int) -> None:
        item = next(runs[i], None) if i < len(runs) else None
        shared[i], heads[i] = item if item else (-1, None)

    def first(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length then counts from the winner."""
        a, b = shared[i], shared[j]
        if a != b:
            return (i, j) if a > b else (j, i)
        if a < 0:
            return i, j
        x, y = heads[i], heads[j]
        c = common(x, y, a)
        if x[c : c + 1] < y[c : c + 1] or (c == len(x) and i < j):
            shared[j] = c
            return i, j
        shared[i] = c
        return j, i

    for i in range(size):
        pull(i)
        if heads[i] is not None:
            shared[i] = 0
    losers, winners = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = first(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if size > 1 else 0
    while heads[top] is not None:
        yield shared[top], heads[top], top
        pull(top)
        node = (top + size) // 2
        while node:
            top, losers[node] = first(top, losers[node])
            node //= 2
