"""Licence scan by canonical digests, in DataFrame functions only.

A text becomes canonical: lines of copyright go, A-Z become small letters, punctuation and white space become single blanks, and
equivalent spellings become one. Its SHA-256 is then looked up among the digests of known licence texts, for the whole text by a
hash join, and for each line that speaks of a licence among the digests of known notices (a constant of the plan, as they are few).

Null and empty texts have the digest of the empty text and match nothing. A text is read whole. The table of known
texts is a parameter with some dozens of rows (`MOST_KNOWN` at most, checked), so that it may be broadcast; of texts with
the same digest the name that sorts first counts.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_KNOWN = 5000

# Notices and licence texts as published, and spellings that mean the same.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
]
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_FREE_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
TEXTS = [
    ("MIT", _MIT + _WARRANTY),
    ("MIT", "MIT License " + _MIT + _WARRANTY),
    ("MIT", "The MIT License (MIT) " + _MIT + _WARRANTY),
    ("ISC", f"{_FREE_USE}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}"),
    ("ISC", f"ISC License {_FREE_USE}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}"),
    ("0BSD", f"{_FREE_USE}. {_ISC_WARRANTY}"),
]
# Digests of longer texts as published (Debian's common licences; BSD from packages): of the whole text and, where it ends its terms with a line
# that says so, of the text up to that line with and without it; of the BSD texts with numbers or bullets, with and without a title.
DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("BSD-3-Clause-UC", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
]
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("merchantibility", "merchantability"),
    ("https", "http"),
]
# A notice holds a year, a mark or the place of one; a wrapped line of a licence that begins with "copyright notice" or "(c)" is none.
COPYRIGHT_LINE = (
    r"(?im)^[ \t]*(copyright[ \t]*(\(c\)|©|\[|<)[^\n]*|(copyright[^a-z\n]|\(c\))[^\n]*(19|20)[0-9][0-9][^\n]*|©[^\n]*|all rights reserved[ \t\r.]*)$"
)
# A notice is looked for on lines that hold this, as every notice above does.
CUE = "(?i)licen[cs]e"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")
    words = F.trim(F.regexp_replace(F.translate(kept, UPPER, LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    for other, usual in SPELLINGS:
        words = F.replace(words, F.lit(other), F.lit(usual))
    return words


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(digest, license) of a list of (name, text)."""
    if len(texts) > MOST_KNOWN:
        raise ValueError("join that many licence texts from a table")
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in texts])).alias("k")
    table = spark.range(1).select(rows).select(digest(F.col("k.text")).alias("digest"), F.col("k.name").alias("license"))
    return table.groupBy("digest").agg(F.min("license").alias("license"))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]], digests: list[tuple[str, str]]) -> DataFrame:
    """(digest, license) of a list of (name, text) and a list of (name, digest)."""
    if len(texts) + len(digests) > MOST_KNOWN:
        raise ValueError("join that many licence texts from a table")
    if not digests:
        return known(spark, texts)
    rows = F.explode(F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(n).alias("license")) for n, d in digests])).alias("k")
    both = known(spark, texts).unionByName(spark.range(1).select(rows).select("k.digest", "k.license"))
    return both.groupBy("digest").agg(F.min("license").alias("license"))


def scan(df: DataFrame, text: str = "text", texts=tuple(TEXTS + NOTICES), notices=tuple(NOTICES), digests=tuple(DIGESTS)) -> DataFrame:
    """Add text_digest, license (of the whole text, null if unknown) and notices (names of licences on single lines, in order)."""
    spark = df.sparkSession
    names = {r["digest"]: r["license"] for r in known(spark, list(notices)).collect()}  # as many as `notices`
    table = F.create_map(*chain.from_iterable((F.lit(d), F.lit(n)) for d, n in sorted(names.items()))) if names else None
    whole = F.coalesce(df[text], F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(CUE))
    found = F.array_compact(F.transform(lines, lambda line: table[digest(line)])) if names else F.array().cast("array<string>")
    outer = df.drop(*[c for c in ("text_digest", "license", "notices") if c != text])
    marked = outer.withColumns({"text_digest": digest(df[text]), "notices": F.when(whole.rlike(CUE), found).otherwise(F.array().cast("array<string>"))})
    lookup = known_digests(spark, list(texts), list(digests)).withColumnRenamed("digest", "text_digest")
    return marked.join(F.broadcast(lookup), "text_digest", "left")
