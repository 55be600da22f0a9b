"""Licence texts by canonical digest, in SQL functions only.

A text is brought to a canonical form (ASCII letters in lower case, copyright signs spelled out, runs of
everything but letters and digits one space, copyright lines left out unless they are wrapped lines of a licence's
body such as "copyright notice and", equivalent spellings alike), and
its SHA-256 is looked up among the digests of known licences in the same form. The whole text is looked
up, and every paragraph and line as a text of its own, so a notice inside a document is found as well.
Only texts of a known licence's length are digested; others can't be equal.

Null or empty text matches nothing. Repeated rows are each reported. An empty table gives no rows, an
empty list of licences no matches. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.staging import small, stage

#: Rows up to which known licences are broadcast.
BROADCAST_LICENSES = 50_000
#: Distinct lengths of known licences up to which other lengths are passed over; beyond, all are digested.
MANY_SIZES = 5_000

#: Equivalent spellings, after all else of the canonical form.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sub license", "sublicense"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"),
    ("non commercial", "noncommercial"), ("whilst", "while"), ("https", "http"),
)

#: How lines of a licence's body go on that begin with "copyright" by the way they are wrapped.
BODY = r"notices?\b|(?:holders?|owners?)(?: ?$| (?:be|and|or)\b)"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD0 = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
""" + _ISC.split("\n")[1]
#: Known texts: identifier and text. Notices are those by which a work names its licence.
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC), ("0BSD", _BSD0),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "license string, text string")


def canonical_lines(text: Column) -> Column:
    """Lines of the canonical form; empty ones part paragraphs."""
    t = F.lower(text)
    t = F.regexp_replace(t, r"©|\(c\)", " copyright ")
    t = F.regexp_replace(t, r"[^a-z0-9\n]+", " ")
    t = F.regexp_replace(t, rf"(?m)^ ?copyright (?!{BODY})[^\n]*$|^ ?all rights reserved ?$", "")
    plain = t
    for old, new in SPELLINGS:
        t = F.regexp_replace(t, rf"\b{old}\b", new)
    has = plain.rlike("\\b(" + "|".join(old for old, _ in SPELLINGS) + ")\\b")
    return F.transform(F.split(F.when(has, t).otherwise(plain), "\n"), lambda x: F.trim(x))


def _whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def _paragraphs(lines: Column) -> Column:
    return F.transform(F.split(F.array_join(lines, "\n"), "\n\n+"), lambda p: F.trim(F.translate(p, "\n", " ")))


def find_licenses(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, whole_license, notices, n_notices`` of every document.

    ``whole_license`` is the licence that the whole text is, ``notices`` the licences of its paragraphs
    and lines in order of their names, ``n_notices`` the number of such paragraphs and lines.
    """
    listed = known.select("license", _whole(canonical_lines(F.col("text"))).alias("t")).where("t != ''")
    listed = listed.select("license", F.sha2("t", 256).alias("digest"), F.length("t").alias("size"))
    listed = listed.groupBy("digest").agg(F.min("license").alias("license"), F.max("size").alias("size"))
    listed = stage(listed, "licenses")
    sizes = [r["size"] for r in listed.select("size").distinct().limit(MANY_SIZES + 1).collect()]
    fits = (lambda t: F.length(t).isin(sizes)) if len(sizes) <= MANY_SIZES else (lambda t: F.lit(True))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines"))
    rows = rows.withColumns({"whole": _whole(F.col("lines")), "paragraphs": _paragraphs(F.col("lines"))})
    # A one-line paragraph is looked up once, as a line; a one-line text is a line as well.
    single = F.filter("paragraphs", lambda p: fits(p) & ~F.array_contains("lines", p))
    parts = F.transform(F.concat(F.filter("lines", fits), single), lambda t: F.sha2(t, 256))
    rows = rows.select("row", "doc_id", F.when(fits(F.col("whole")), F.sha2("whole", 256)).alias("whole"), parts.alias("parts"))
    rows = stage(rows, "digests")
    side = F.broadcast(listed) if small(listed, BROADCAST_LICENSES) else listed
    asked = rows.select("row", F.explode(F.concat(
        F.transform(F.coalesce("parts", F.array().cast("array<string>")), lambda d: F.struct(d.alias("digest"), F.lit(False).alias("all"))),
        F.when(F.col("whole").isNotNull(), F.array(F.struct(F.col("whole").alias("digest"), F.lit(True).alias("all")))).otherwise(F.array().cast("array<struct<digest:string,all:boolean>>")),
    )).alias("a")).select("row", "a.digest", "a.all")
    hits = asked.join(side, "digest").groupBy("row").agg(
        F.min(F.when(F.col("all"), F.col("license"))).alias("whole_license"),
        F.array_join(F.sort_array(F.collect_set(F.when(~F.col("all"), F.col("license")))), ",").alias("notices"),
        F.count_if(~F.col("all")).alias("n_notices"),
    )
    return rows.select("row", "doc_id").join(hits, "row", "left").select(
        "doc_id", "whole_license", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices")
    )
