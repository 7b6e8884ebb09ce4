"""Pre-tokens of byte-level BPE for a whole batch of texts at once: where each match of the split pattern starts.

The pattern has seven contractions, runs of letters, of numbers and of other signs, each with at most one blank before, and runs
of white space that leave their last character to what follows. All of that can be read off the classes of neighbouring
characters, so a batch is classified and cut with array operations instead of one search per token.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

SPACE, LETTER, NUMBER, OTHER, END = 0, 1, 2, 3, 4
STOP = 0x110000  # stands after each text; no character has this number
#: Characters with the Unicode property White_Space (fixed values).
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
BLANK, APOSTROPHE = 0x20, 0x27


@functools.cache
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1
    )
    table[list(WHITE_SPACE)] = SPACE
    return np.append(table, np.uint8(END))


def cut(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(UTF-8 of all texts, bounds of all tokens in it, tokens of each text). Token i is bytes[bounds[i]:bounds[i + 1]]."""
    stop = STOP.to_bytes(4, "little")
    codes = np.frombuffer(b"".join(part for t in texts for part in (t.encode("utf-32-le"), stop)), np.uint32)
    kind = classes()[codes]
    before = np.empty_like(kind)
    before[:1], before[1:] = END, kind[:-1]
    start = kind != before
    start[kind == END] = False
    # White space before a run: its last character is cut off, and a blank joins the run.
    after = np.flatnonzero(start & (before == SPACE))
    start[after - 1] = True
    start[after[codes[after - 1] == BLANK]] = False
    # Contractions: an apostrophe that starts a token takes the letters with it.
    mark = np.flatnonzero(start & (codes == APOSTROPHE))
    if len(mark):
        padded = np.concatenate([codes, np.full(3, STOP, np.uint32)])
        one, two = padded[mark + 1], padded[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros_like(short)
        for first, second in ("re", "ve", "ll"):
            long |= (one == ord(first)) & (two == ord(second))
        for found, length in ((mark[short], 2), (mark[long], 3)):
            start[found + 1] = False
            rest = found + length
            start[rest[kind[rest] == LETTER]] = True
    width = np.ones(len(codes), np.uint8)
    width += codes >= 0x80
    width += codes >= 0x800
    width += codes >= 0x10000
    ends = kind == END
    width[ends] = 0
    place = np.cumsum(width, dtype=np.int64) - width
    at = np.flatnonzero(start)
    total = int(place[-1]) if len(place) else 0
    bounds = np.append(place[at], total)
    counts = np.diff(np.searchsorted(at, np.flatnonzero(ends)), prepend=0)
    return b"".join(t.encode() for t in texts), bounds, counts
