"""A seeded permutation of 0 .. n - 1 by arithmetic: the place of an entry is computed, so no list is sorted or held.

Numbers are cells of a grid of `a` by `b`, and four rounds move a coordinate by a hash of the other one; each round can be undone, so
all of them are a permutation of the grid. A grid holds a few cells more than n, fewer than its shorter side: a number that lands on
one of those moves on, and gets back below n after at most as many steps as there are such cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.hashing import draw_hex

ROUNDS = 4


def grid(n: int) -> tuple[int, int]:
    """The sides of a grid near a square with the fewest cells from n on."""
    side = max(2, math.isqrt(n))
    return min(((a, -(-n // a)) for a in range(side, max(1, side // 2), -1)), key=lambda g: g[0] * g[1])


def round_keys(seed: str, *keys: str | Column) -> Column:
    """Four 32-bit numbers drawn from the seed and a row's key."""
    digits = draw_hex(seed, *keys)
    return F.array(*[F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(ROUNDS)])


def _step(number: Column, keys: Column, a: int, b: int) -> Column:
    sides, size = [F.floor(number / b).cast("bigint"), number % b], (a, b)
    for i in range(ROUNDS):
        moved, by = i % 2, 1 - i % 2
        # Bits 9 to 39 of a product below 2^63.
        hashed = F.shiftright((sides[by] + 1) * keys[i].bitwiseOR(F.lit(1)), 9).bitwiseAND(F.lit(0x7FFFFFFF))
        sides[moved] = (sides[moved] + hashed) % size[moved]
    return sides[0] * b + sides[1]


def permuted(number: Column, keys: Column, n: int) -> Column:
    """Where a whole number below n goes; `keys` are the row's round keys."""
    a, b = grid(n)
    first = _step(number.cast("bigint"), keys, a, b)
    beyond = a * b - n
    if not beyond:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(beyond)), first, lambda x, _: F.when(x < n, x).otherwise(_step(x, keys, a, b)))


def permuted_sql(table: str, seed: str, key: str, n: int) -> str:
    """The same in DuckDB: a table with a column x below n, which the result has moved."""
    a, b = grid(n)
    keys = f"list_transform(range({ROUNDS}), lambda j: ('0x' || substr(md5(concat_ws(':', '{seed}', {key})), 8 * j + 1, 8))::BIGINT)"
    out = f"(SELECT *, {keys} AS k FROM {table})"
    for walk in range(a * b - n + 1):
        out = f"(SELECT * EXCLUDE (x), x AS was, x // {b} AS l, x % {b} AS r FROM {out})"
        for i in range(ROUNDS):
            moved, by, size = ("l", "r", a) if i % 2 == 0 else ("r", "l", b)
            out = f"(SELECT * REPLACE (({moved} + (((({by} + 1) * (k[{i + 1}] | 1)) >> 9) & 2147483647)) % {size} AS {moved}) FROM {out})"
        to = f"l * {b} + r"
        out = f"(SELECT * EXCLUDE (was, l, r), {f'CASE WHEN was < {n} THEN was ELSE {to} END' if walk else to} AS x FROM {out})"
    return out
