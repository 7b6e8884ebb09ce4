"""Porter's stemmer for English words, as SQL expressions: one CASE per step, each over the result of the step before.

The text of an expression is the same for Spark and DuckDB but for the name of the function that matches a pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letter classes, suffixes and replacements of the published algorithm.
CONSONANTS, VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
ENDINGS_2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate "
    "alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
)
ENDINGS_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
ENDINGS_4 = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize"
DOUBLES = "bb cc dd ff gg hh jj kk mm nn pp qq rr tt vv ww xx"

SOME = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}"  # at least one vowel-consonant sequence
ONE = f"{SOME}({VOWELS})?$"
SEVERAL = f"{SOME}{VOWELS}{CONSONANTS}"
VOWEL = f"^({CONSONANTS})?[aeiouy]"
SHORT = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def steps(match: str) -> list[str]:
    """Expressions over the column w; `match(text, pattern)` is the engine's search for a pattern."""

    def has(pattern: str, text: str = "w") -> str:
        return f"{match}({text}, '{pattern}')"

    def table(endings: str) -> str:
        pairs = sorted((p.split(":") for p in endings.split()), key=lambda p: -len(p[0]))
        cases = [f"WHEN {has(a + '$')} THEN CASE WHEN {has(SOME, _cut(len(a)))} THEN {_cut(len(a))} || '{b}' ELSE w END" for a, b in pairs]
        return f"CASE {' '.join(cases)} ELSE w END"

    plural = f"CASE WHEN {has('(ss|i)es$')} THEN {_cut(2)} WHEN {has('[^s]s$')} THEN {_cut(1)} ELSE w END"
    # The mark tells the next step that an ending has been cut off.
    past = f"""CASE WHEN {has('eed$')} THEN CASE WHEN {has(SOME, _cut(3))} THEN {_cut(1)} ELSE w END
      WHEN {has('ed$')} AND {has(VOWEL, _cut(2))} THEN {_cut(2)} || '*' WHEN {has('ing$')} AND {has(VOWEL, _cut(3))} THEN {_cut(3)} || '*' ELSE w END"""
    doubles = DOUBLES.replace(" ", "|")
    mended = f"""CASE WHEN NOT {has('[*]$')} THEN w WHEN {has('(at|bl|iz)[*]$')} THEN {_cut(1)} || 'e' WHEN {has(f'({doubles})[*]$')} THEN {_cut(2)}
      WHEN {has(SHORT, _cut(1))} THEN {_cut(1)} || 'e' ELSE {_cut(1)} END"""
    last_y = f"CASE WHEN {has('y$')} AND {has(VOWEL, _cut(1))} THEN {_cut(1)} || 'i' ELSE w END"
    fourth = [f"WHEN {has(a + '$')} THEN CASE WHEN {has(SEVERAL, _cut(len(a)))} THEN {_cut(len(a))} ELSE w END" for a in sorted(ENDINGS_4.split(), key=lambda a: -len(a))]
    fourth.append(f"WHEN {has('[st]ion$')} AND {has(SEVERAL, _cut(3))} THEN {_cut(3)}")
    last_e = f"""CASE WHEN {has('e$')} AND ({has(SEVERAL, _cut(1))} OR ({has(ONE, _cut(1))} AND NOT {has(SHORT, _cut(1))})) THEN {_cut(1)} ELSE w END"""
    last_l = f"CASE WHEN {has('ll$')} AND {has(SEVERAL)} THEN {_cut(1)} ELSE w END"
    first_y = f"CASE WHEN {has('^y')} THEN 'Y' || substr(w, 2) ELSE w END"
    small_y = f"CASE WHEN {has('^Y')} THEN 'y' || substr(w, 2) ELSE w END"
    return [first_y, plural, past, mended, last_y, table(ENDINGS_2), table(ENDINGS_3), f"CASE {' '.join(fourth)} ELSE w END", last_e, last_l, small_y]


def stemmed(words: DataFrame, word: str = "token", name: str = "stem", longer_than: int = 2) -> DataFrame:
    """Add the stem of a lower-case word; words of up to `longer_than` letters are their own stems. Meant for a table of distinct words.

    Each step is a lambda over an array of one word, so that the word is a variable of the step and not its text again: steps put into
    one another would double with each use of the word.
    """
    held = F.array(F.when(F.length(word) > longer_than, F.col(word)))
    text = "__held"
    for step in steps("regexp_like"):
        text = f"transform({text}, w -> {step})"
    return words.withColumn("__held", held).withColumn(name, F.coalesce(F.expr(text)[0], F.col(word))).drop("__held")


def stemmed_sql(table: str, longer_than: int = 2) -> str:
    """A DuckDB table (token, stem) of a table of tokens."""
    out = f"(SELECT token, CASE WHEN length(token) > {longer_than} THEN token END AS w FROM {table})"
    for step in steps("regexp_matches"):
        out = f"(SELECT token, {step} AS w FROM {out})"
    return f"(SELECT token, coalesce(w, token) AS stem FROM {out})"
