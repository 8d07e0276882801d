"""Licence scan by canonical digests (DataFrame functions only)."""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table

# Licence texts and the usual one-line notices, with their SPDX names.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", "Released under the ISC License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]
# Every known text holds one of these, and no rule below makes one out of other letters.
HINTS = "licen|permission"
# Spellings that count as one, after lower-casing.
SPELLINGS = [("licence", "license"), ("licencing", "licensing"), ("organisation", "organization"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"), ("merchantibility", "merchantability")]
# Lines that begin so go if they have a year, a sign, a place for a name, or a holder with a
# capital. Lines of wrapped prose ("copyright notice and this ...") and items (c) stay.
COPYRIGHT = (
    r"(?m)^[ \t]*(?:©|(?i:copyright)(?=[^\n]*(?:\([cC]\)|©|\b(?:19|20)\d\d\b|[<\[{]))"
    r"|(?i:copyright)[ \t:]+(?:by[ \t]+)?(?!(?i:notice|holder|owner|law|licen[cs]e|statement|interest|permission|disclaimer|treat|and\b|or\b|in\b|on\b|of\b|is\b))[A-Z]"
    r"|\([cC]\)(?![ \t]+(?i:you|the|to|a|an|any|if|in|all)\b))[^\n]*$"
)
PARAGRAPH = r"\n[ \t\r]*\n"
# The disclaimer and the two clauses of BSD-2-Clause hold none of HINTS.
BSD_HINT = "redistribution"


def _bsd(clauses: int) -> list[str]:
    """The text by holder or owner, with numbers or other marks, and with and without blank lines between clauses."""
    head = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    items = [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ][:clauses]
    end = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
    out = []
    for holder in ("HOLDER", "OWNER"):
        for mark in ("{}. ", "* "):
            marked = [mark.format(i + 1) + item for i, item in enumerate(items)]
            for gaps in (["\n\n", "\n\n"], ["\n\n", "\n"], ["\n", "\n"]):
                out.append(head + gaps[0] + gaps[1].join(marked) + "\n\n" + end.format(holder))
    return out


def whole_texts() -> list[tuple[str, str]]:
    """Names and texts of whole licences: those of KNOWN, and with their usual titles the files
    in ``texts`` and the BSD texts. Texts with an appendix are also held without it."""
    out = [(name, text) for name, text in KNOWN if "\n\n" in text]
    for name, title, clauses in (("BSD-2-Clause", "BSD 2-Clause License", 2), ("BSD-3-Clause", "BSD 3-Clause License", 3)):
        out += [(name, start + text) for text in _bsd(clauses) for start in ("", title + "\n\n")]
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-2.0-only", "GPL-2"), ("GPL-3.0-only", "GPL-3"), ("MPL-2.0", "MPL-2.0"), ("BSD-3-Clause", "BSD")):
        text = resources.files("tidelog.llm").joinpath("texts", f"{file}.txt").read_text()
        terms = re.match(r"(?s).*END OF TERMS AND CONDITIONS[^\n]*", text)
        out += [(name, text)] + ([(name, terms[0])] if terms else [])
    return out


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, single blanks for all else but letters and digits."""
    out = F.lower(F.regexp_replace(text, COPYRIGHT, " "))
    for old, new in SPELLINGS:
        out = F.regexp_replace(out, old, new)
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def _paragraphs(text: Column) -> Column:
    """Digests of the canonical paragraphs that are not empty, in order."""
    made = F.filter(F.transform(F.split(text, PARAGRAPH), canonical), lambda p: p != "")
    return F.transform(made, lambda p: F.sha2(p, 256))


def runs(spark: SparkSession) -> DataFrame:
    """``digest, license, part, j, size``: every paragraph of the whole texts of several paragraphs."""
    texts = spark.createDataFrame(whole_texts(), "license string, text string")
    parted = texts.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license", _paragraphs(F.col("text")).alias("parts")).distinct()
    cut_ = parted.filter(F.size("parts") > 1).select("digest", "license", F.size("parts").alias("size"), F.xxhash64("parts").alias("way"), F.posexplode("parts").alias("j", "part"))
    return cut_.select("digest", "license", "part", "way", "j", "size")


def digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``digest, license``, one row per digest, of ``known`` and the whole texts."""
    rows = spark.createDataFrame([*known, *whole_texts()], "license string, text string")
    return rows.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame, hints: str = HINTS) -> DataFrame:
    """``doc_id, whole, n_hits, licenses`` of every row.

    The whole text, its paragraphs and its lines are made canonical and joined to the known
    digests; ``n_hits`` counts the different units that match, ``whole`` tells whether the
    entire text does, ``licenses`` names what was found, in order. Rows that share a ``doc_id``
    (or have none) are judged by their own texts; repeated rows alike. Null and empty texts
    have no hits, very long ones are searched whole, other columns are ignored, no rows give
    no rows.
    A licence of several paragraphs counts as one unit wherever all its paragraphs follow one
    another. Texts without any of ``hints`` can't hold a known text and aren't cut up.
    """
    hints = f"{hints}|{BSD_HINT}"
    text = F.col("text")
    key = F.struct(F.col("doc_id"), F.xxhash64(text).alias("of")).alias("key")
    cuts = F.concat(F.split(text, r"\n[ \t]*\n"), F.split(text, "\n"))
    units = F.concat(
        F.array(F.struct(text.alias("unit"), F.lit(True).alias("whole"))),
        F.transform(F.array_distinct(F.filter(cuts, lambda u: u != text)), lambda u: F.struct(u.alias("unit"), F.lit(False).alias("whole"))),
    )
    parts = (
        docs.filter(F.lower(text).rlike(hints))
        .select(key, F.explode(units).alias("u"))
        .filter(F.lower(F.col("u.unit")).rlike(hints))
        .select("key", "u.whole", F.sha2(canonical(F.col("u.unit")), 256).alias("digest"))
    )
    # The list of known texts is a parameter of some hundred rows at most, not data.
    found = parts.join(F.broadcast(known), "digest").select("key", "whole", "digest", "license")
    pieces = docs.filter(F.lower(text).rlike(hints)).select(key, F.posexplode(_paragraphs(text)).alias("at", "part"))
    inside = pieces.join(F.broadcast(runs(docs.sparkSession)), "part").groupBy(
        "key", "digest", "license", "way", "size", (F.col("at") - F.col("j")).alias("start")
    ).agg(F.count_distinct("j").alias("held")).filter("held = size")
    found = found.union(inside.select("key", F.lit(False).alias("whole"), "digest", "license"))
    hits = found.groupBy("key").agg(
        F.max("whole").alias("whole"), F.count_distinct("digest").alias("n_hits"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
    )
    rows = docs.select(key)
    return rows.join(hits, "key", "left").select(
        "key.doc_id", F.coalesce("whole", F.lit(False)).alias("whole"), F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), digests(spark))


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '(?m)^[ \\t]*(copyright|\\(c\\)|©)[^\\n]*$', ' ', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
SQL = f"""
WITH known AS (
  SELECT sha256({_sql_canonical("text")}) AS digest, min(license) AS license FROM (VALUES {_VALUES}) k(license, text) GROUP BY 1),
units AS (
  SELECT doc_id, text, text AS unit, true AS whole FROM documents
  UNION SELECT doc_id, text, u, false FROM (SELECT doc_id, text, unnest(list_concat(regexp_split_to_array(text, '\\n[ \\t]*\\n'), string_split(text, chr(10)))) AS u FROM documents) WHERE u <> text),
hits AS (
  SELECT doc_id, text, bool_or(whole) AS whole, count(DISTINCT digest)::BIGINT AS n_hits, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
  FROM (SELECT doc_id, text, whole, sha256({_sql_canonical("unit")}) AS digest FROM units WHERE regexp_matches(lower(unit), '{HINTS}')) JOIN known USING (digest) GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(whole, false) AS whole, coalesce(n_hits, 0)::BIGINT AS n_hits, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN hits h ON d.doc_id IS NOT DISTINCT FROM h.doc_id AND d.text = h.text
"""
