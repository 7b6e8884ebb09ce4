"""Column helpers on text. All stay on the JVM side."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that Python's str.strip() removes, as a Java character class.
BLANK_CLASS = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"



def _ranges(test) -> str:
    """Character-class ranges of all code points that pass the test."""
    out: list[str] = []
    start = None
    for point in range(sys.maxunicode + 2):
        inside = point <= sys.maxunicode and test(chr(point))
        if inside and start is None:
            start = point
        elif not inside and start is not None:
            out.append(rf"\x{{{start:x}}}-\x{{{point - 1:x}}}")
            start = None
    return "".join(out)


# Every character that Python's str.isdigit() accepts: decimal digits of all scripts, then superscripts, circled digits etc.
DIGIT_CLASS = rf"[\p{{Nd}}{_ranges(lambda ch: ch.isdigit() and not ch.isdecimal())}]"

# Page-number lines, removed in this order together with both newlines.
PAGE_NUMBER_LINES = [
    r"\n- \p{Nd}+ - *\n",
    r"\n— \p{Nd}+ — *\n",
    r"\n\p{Nd}+ *\n",
    r"\nI+ *\n",
]

# Characters deleted from extracted text, then a two-line heading, then newlines.
JUNK_CHARACTERS = "\xa0\t\u3000 \ufeff\u2002\u200b"
CONTENTS_HEADING = "目\n录\n"

# Defaults of the sentence filters.
CHAPTER_PREFIX = "第"
CHAPTER_MARKERS = "章节篇"
TITLE_PHRASES = ("国民经济和社会发展", "五年规划")
TITLE_MAX_LENGTH = 45
SENTENCE_LENGTHS = (8, 1000)


def strip(c: Column) -> Column:
    """Remove blanks of every Unicode kind at both ends."""
    return F.regexp_replace(c, rf"\A{BLANK_CLASS}+|{BLANK_CLASS}+\z", "")


def remove_page_numbers(c: Column) -> Column:
    return reduce(lambda acc, p: F.regexp_replace(acc, p, ""), PAGE_NUMBER_LINES, c)


def remove_junk(
    c: Column, singles: str = JUNK_CHARACTERS, heading: str = CONTENTS_HEADING, newlines: bool = True
) -> Column:
    """Delete single characters, then the heading, then (optionally) all newlines."""
    out = F.replace(F.translate(c, singles, ""), F.lit(heading), F.lit(""))
    return F.translate(out, "\n", "") if newlines else out


def sentences(c: Column, extra_marks: str = ";；", mark: str = "。") -> Column:
    """Array of the pieces between sentence marks; empty pieces stay, as in a plain split."""
    return F.split(c, rf"[\Q{mark}{extra_marks}\E]", -1)


def remove_parenthesised(c: Column, opening: str = "（", closing: str = "）") -> Column:
    """Drop the shortest spans between the two marks, within a line."""
    return F.regexp_replace(c, rf"\Q{opening}\E.*?\Q{closing}\E", "")


def has_digit(c: Column) -> Column:
    """True for any character with a digit value, in any script. Texts without any kind of number fail the cheap test."""
    return c.rlike(r"\p{N}") & c.rlike(DIGIT_CLASS)


def length_within(c: Column, lo: int = SENTENCE_LENGTHS[0], hi: int = SENTENCE_LENGTHS[1]) -> Column:
    return F.length(c).between(lo, hi)


def not_heading(c: Column, prefix: str = CHAPTER_PREFIX, markers: str = CHAPTER_MARKERS, head: int = 5) -> Column:
    """False for chapter headings: the prefix first and a marker in the first few characters."""
    pattern = rf"(?s)\A{BLANK_CLASS}*+\Q{prefix}\E"
    if not any(m in prefix for m in markers):
        allowed = "".join(rf"\Q{m}\E" for m in markers)
        pattern += f".{{0,{head - len(prefix) - 1}}}[{allowed}]"
    return ~c.rlike(pattern)


def not_title(c: Column, phrases: tuple[str, ...] = TITLE_PHRASES, max_length: int = TITLE_MAX_LENGTH) -> Column:
    """False for short texts that hold every phrase."""
    holds = reduce(lambda a, b: a & b, [F.contains(c, F.lit(p)) for p in phrases])
    return ~((F.length(c) <= max_length) & holds)


def has_character_in(c: Column, first: int = 0x4E00, last: int = 0x9FFF) -> Column:
    """True when any code point lies in the range (the default is the common CJK block)."""
    return c.rlike(rf"[\x{{{first:x}}}-\x{{{last:x}}}]")


def characters_in(c: Column, first: int, last: int) -> Column:
    """All characters of the range, in text order."""
    return F.regexp_extract_all(c, F.lit(rf"[\x{{{first:x}}}-\x{{{last:x}}}]"), F.lit(0))


def contains_text(c: Column, part: str) -> Column:
    """A null text holds nothing."""
    return F.coalesce(F.contains(c, F.lit(part)), F.lit(False))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def match_key(c: Column) -> Column:
    """Form under which two titles count as equal."""
    return F.translate(F.lower(strip(c)), "-:：", "")


def zero_pad(c: Column, width: int = 4) -> Column:
    """Pad on the left with zeros, after a sign; longer values stay whole."""
    s = c.cast("string")
    sign = F.regexp_extract(s, r"^[+-]?", 0)
    padded = F.concat(sign, F.lpad(F.substring(s, F.length(sign) + 1, F.length(s)), width - F.length(sign), F.lit("0")))
    return F.when(F.length(s) < width, padded).otherwise(s)


def slice_text(c: Column, start: Column, end: Column) -> Column:
    """Code points from `start` up to but without `end`, both counted from 0; below zero they count from the end of the text."""
    first, last = (F.when(place < 0, F.greatest(F.length(c) + place, F.lit(0))).otherwise(place) for place in (start, end))
    return F.substring(c, first + 1, F.greatest(last - first, F.lit(0)))


def find_text(c: Column, part: Column) -> Column:
    """Struct of start and end of the first occurrence, both -1 when there is none."""
    start = F.position(part, c) - 1
    return F.struct(
        start.cast("int").alias("start"),
        F.when(start < 0, -1).otherwise(start + F.length(part)).cast("int").alias("end"),
    )


def file_stem(c: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(F.substring_index(c, "/", -1), ".", 1)


def last_number(c: Column) -> Column:
    """The last blank-separated token as an integer, 0 when it is none."""
    token = F.regexp_extract(c, r"(\S+)\s*\z", 1)
    return F.coalesce(token.try_cast("bigint"), F.lit(0))


def words(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1)


def html_fields(c: Column) -> dict[str, Column]:
    """Title, first link and text of the first paragraph, each with 'N/A' when absent."""

    def first(pattern: str) -> Column:
        value = F.regexp_extract(c, pattern, 1)
        bare = strip(F.regexp_replace(value, r"<[^>]*>", ""))
        return F.when(bare == "", F.lit("N/A")).otherwise(bare)

    return {
        "title": first(r"(?s)<title>(.*?)</title>"),
        "link": first(r'<a href="([^"]*)"'),
        "snippet": first(r"(?s)<p>(.*?)</p>"),
    }
