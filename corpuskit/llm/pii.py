"""Personal data: expressions propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) follow fixed definitions and are always reported. Three more kinds are reported only if
they are sure enough: `iban` (mod-97 must hold), `ssn` (no checksum exists, so it needs a context word before or behind it) and `secret`:
access keys and tokens of published forms, armoured private keys, and values with letters and digits that are assigned to a name such as
`password` (the name is their context).

Null and empty texts have no spans. The work is one pass over the rows, without a shuffle; a text is read as a whole, and
each search takes time in proportion to its length.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from corpuskit.llm.frames import beside, whole

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
THRESHOLD = 0.6  # spans of the added kinds need this score
REACH = 48  # code points before and behind a span that are searched for context words

PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.85, "ssn": 0.4, "secret": 0.7}
NEAR = 0.25
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "appel", "llamar"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "secret": ("key", "token", "secret", "password", "credential", "credentials", "api"),
}
_CONTEXT = {kind: re.compile(r"(?<![^\W\d_])(?:" + "|".join(words) + r")(?![^\W\d_])", re.I) for kind, words in CONTEXT.items()}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is taken whole or not at all, so no search starts inside one: that keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
# What follows these four by its length, up to the end of a group.
_IBAN_REST = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])") for n in range(11, 31)}
# Lengths of whole numbers by the registry; for other countries all lengths are tried, the longest first.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_REST_OF = {country: n - 4 for n, countries in _IBAN_LENGTHS.items() for country in countries.split()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# The published forms of access keys and tokens.
_KEY = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[opsur]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{40,}+|glpat-[A-Za-z0-9_-]{20,}+"
    r"|xox[abeoprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}+|sk-[A-Za-z0-9_-]{20,}+"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"
)
_ARMOUR = re.compile(r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----")
_ARMOUR_END = re.compile(r"-----END (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----")
_ASSIGNED = re.compile(
    r"""(?<![a-z0-9])(?:password|passwd|pwd|secret|(?:api|access|secret)[_-]?key|(?:access|auth)[_-]?token|token)["']?[ ]{0,3}[:=][ ]{0,3}["']?([^\s"',;]{8,}+)""",
    re.I,
)
_DIGIT = re.compile("[0-9]")
_LETTER = re.compile("[A-Za-z]")
_MARKS = str.maketrans("", "", " -().+")

SPAN = StructType(
    [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())]
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod_97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: the longest run before it that the last match has left, and a dotted name."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            free = domain.end()
            at = text.find("@", free)
        else:
            # The run after this @ is not shared with the next search, so the scan back stays linear in total.
            free = max(free, at + 1)
            at = text.find("@", at + 1)
    return found


def _ibans(text: str) -> list[tuple[int, int]]:
    """From each start, the number of the length of its country, whatever follows it after a blank."""
    found, free = [], 0
    for m in _IBAN.finditer(text):
        if m.start() < free:
            continue
        n = _REST_OF.get(m[0][:2])
        for size in (n,) if n else range(30, 10, -1):
            rest = _IBAN_REST[size].match(text, m.end())
            if rest and mod_97((m[0] + rest[0]).replace(" ", "")):
                free = rest.end()
                found.append((m.start(), free))
                break
    return found


def _secrets(text: str) -> list[tuple[int, int]]:
    """Keys of known forms and armoured keys (to the end of the text if the armour does not end), then assigned values apart from those."""
    known, free = [], 0
    for m in _ARMOUR.finditer(text):
        if m.start() >= free:
            end = _ARMOUR_END.search(text, m.end())
            free = end.end() if end else len(text)
            known.append((m.start(), free))
    armoured = len(known)
    found = known + [m.span() for m in _KEY.finditer(text) if not _inside(known, armoured, *m.span())]
    found.sort()
    values = [m.span(1) for m in _ASSIGNED.finditer(text) if _DIGIT.search(m[1]) and _LETTER.search(m[1])]
    return sorted(found + [v for v in values if not _inside(found, len(found), *v)])


def _inside(spans: list[tuple[int, int]], n: int, start: int, end: int) -> bool:
    """Whether a span meets one of the first n, which are in order and apart."""
    at = bisect.bisect_left(spans, (end, 0), 0, n)
    return at > 0 and spans[at - 1][1] > start


def _digits(text: str, start: int, end: int) -> str:
    return text[start:end].translate(_MARKS)


def propose(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans (kind, start, end) in code points, end exclusive, by kind and then by start."""
    found = [("email", *span) for span in _emails(text)] if "@" in text else []
    secrets = [("secret", *span) for span in _secrets(text)]
    if not _DIGIT.search(text):
        return found + secrets
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) < 4 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(text, *m.span())) <= 19 and luhn(d)]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(text, *m.span())) <= 15]
    found += [("iban", *span) for span in _ibans(text)]
    found += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    return found + secrets


def score(text: str, kind: str, start: int, end: int | None = None) -> float:
    """How sure a span is; words behind it count where its end is given."""
    near = _CONTEXT[kind].search(text[max(0, start - REACH) : start]) or (end is not None and _CONTEXT[kind].search(text[end : end + REACH]))
    return min(1.0, PRIOR[kind] + (NEAR if near else 0.0))


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    scored = [(kind, start, end, score(text, kind, start, end)) for kind, start, end in propose(text)]
    return [s for s in scored if s[0] in BASE_KINDS or s[3] >= THRESHOLD]


@F.arrow_udf(returnType=ArrayType(SPAN))
def _find(texts: pa.Array) -> pa.Array:
    rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)] for t in texts.to_pylist()]
    return pa.array(rows, _SPANS)


def spans(df: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Add an array of (kind, start, end, score). Null and empty texts give an empty array."""
    return beside(df, F.struct(_find(whole(df, text)).alias(name)), [name])


def count_of(column: Column, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s.kind == kind)).cast("bigint")


def written(column: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def mask(text: str) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans, one bracket for all."""
    out, free, held = [], 0, None
    for kind, start, end, _ in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        if held is not None and start < free:
            free = max(free, end)
            continue
        out += [text[free:start], f"[{kind.upper()}]"]
        held, free = kind, end
    return "".join([*out, text[free:]])


@F.arrow_udf(returnType=StringType())
def _mask(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else mask(t) for t in texts.to_pylist()], pa.string())


def masked(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets. A null text stays null."""
    return df.withColumn(text, _mask(df[text]))
