"""License scans: canonical digests of entire texts joined to known licence digests.

A text is brought into canonical form (lower case, copyright lines out, equivalent spellings
made one, punctuation as spaces) and its digest looked up. The texts looked up are each whole
document and each of its lines, so a licence file, and a one-line notice within other text,
are both entire texts. A long text is also found inside a document: at each place where four
words begin a known text, the digest of as many words as that text has is looked up, so
headings, comment marks and the way lines are broken do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.llm.license_digests import LONG, WHOLE
from glyphmill.llm.plan import let, text_key

# Public licence texts and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""
_NO_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC + " " + _NO_WARRANTY),
    ("ISC", "ISC License " + _ISC + " " + _NO_WARRANTY),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted. " + _NO_WARRANTY,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
)

# Spellings that mean the same, as (pattern, replacement) on lower-case text.
SPELLINGS = (
    ("licence", "license"),
    ("sub[ -]license", "sublicense"),
    ("non[ -]?infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("https?://", ""),
    ("v(ersion)?[.]? ?([0-9])", "version $2"),
)
#: Lines that name a right holder: they differ from copy to copy of one licence.
COPYRIGHT_LINE = "(?m)^[^a-z\\n]*(copyright|\\(c\\)|©)[^\\n]*$"
#: Words that say where a long text may begin.
HEAD_WORDS = 4
#: Every long text has one of these; texts without are not searched.
MARKS = ("warrant", "lesser")


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, words separated by one space."""
    return _plain_words(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " "))


def _plain_words(lower: Column) -> Column:
    out = lower
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def known_digests(spark, known=KNOWN) -> DataFrame:
    """``(digest, license)`` of the known texts, canonicalised by the same expression."""
    rows = spark.createDataFrame(list(known), "license string, body string")
    return rows.select(F.sha2(canonical(F.col("body")), 256).alias("digest"), "license").distinct()


def whole_rows(spark, bodies) -> list[tuple[str, str]]:
    """``(license, digest)`` of texts that a whole document is compared with."""
    return sorted((r.license, r.digest) for r in known_digests(spark, bodies).collect())


def long_rows(spark, bodies) -> list[tuple[str, int, str, str]]:
    """``(license, n_words, head, digest)`` of texts to find inside documents.

    The bodies need at least HEAD_WORDS words, one of MARKS, and no copyright lines.
    """
    form = _plain_words(F.lower("body"))
    words = F.split(form, " ")
    rows = spark.createDataFrame(list(bodies), "license string, body string").select(
        "license", F.size(words).alias("n"), F.array_join(F.slice(words, 1, HEAD_WORDS), " ").alias("head"), F.sha2(form, 256).alias("digest")
    )
    return sorted(tuple(r) for r in rows.distinct().collect())


def _inside(text: Column, long) -> Column:
    """Digests of the stretches of a text that begin and are as long as a known long text."""
    sizes: dict[str, set[int]] = {}
    for _, n, head, _ in long:
        sizes.setdefault(head, set()).add(n)
    firsts = F.array(*[F.lit(x) for x in sorted({head.split(" ")[0] for head in sizes})])
    known = F.array(*[F.struct(F.lit(h).alias("head"), F.lit(n).alias("n")) for h in sorted(sizes) for n in sorted(sizes[h])])

    def stretches(ws):
        places = F.filter(F.sequence(F.lit(1), F.size(ws)), lambda i: F.array_contains(firsts, F.get(ws, i - 1)))
        return F.flatten(F.transform(places, lambda i: let(F.array_join(F.slice(ws, i, HEAD_WORDS), " "), lambda head: F.transform(
            F.filter(known, lambda k: (k["head"] == head) & (i + k["n"] - 1 <= F.size(ws))),
            lambda k: F.sha2(F.array_join(F.slice(ws, i, k["n"]), " "), 256),
        ))))

    return F.array_distinct(let(F.split(_plain_words(F.lower(text)), " "), stretches))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", known: DataFrame | None = None, long=LONG) -> DataFrame:
    """``(key, whole, n_lines, licenses)`` per row of ``docs``.

    ``whole`` is the licence that the entire document is, else null; ``n_lines`` counts its lines
    that are a known text; ``licenses`` lists all found, also inside the text, sorted and
    comma-joined. A null or empty text has none; repeated rows each give a row. Pass a larger table
    of digests as ``known``: it is broadcast only while Spark's size estimate allows. ``long`` are
    rows of ``long_rows``.
    """
    spark = docs.sparkSession
    # The built-in lists have a fixed length, so their broadcasts have a fixed size.
    if known is None:
        texts = spark.createDataFrame([(d, name) for name, d in WHOLE], "digest string, license string")
        known = F.broadcast(known_digests(spark).union(texts).distinct())
    body = F.coalesce(F.col(text), F.lit(""))
    pieces = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), body.alias("piece"))),
        F.transform(F.split(body, "\n"), lambda line: F.struct(F.lit(False).alias("whole"), line.alias("piece"))),
    )
    found = (
        docs.select(*text_key(F.col(text)), F.explode(pieces).alias("p"))
        .select("k1", "k2", "p.whole", canonical(F.col("p.piece")).alias("form"))
        .where("form <> ''")
        .select("k1", "k2", "whole", F.sha2("form", 256).alias("digest"))
        .join(known, "digest")
        .select("k1", "k2", "whole", "license")
    )
    if long:
        names = spark.createDataFrame([(d, name) for name, _, _, d in long], "digest string, license string").distinct()
        inside = (
            docs.where(F.lower(F.col(text)).rlike("|".join(MARKS)))
            .select(*text_key(F.col(text)), F.explode(_inside(F.col(text), long)).alias("digest"))
            .join(F.broadcast(names), "digest")
        )
        found = found.union(inside.select("k1", "k2", F.lit(None).cast("boolean").alias("whole"), "license"))
    found = (
        found.groupBy("k1", "k2")
        .agg(
            F.min(F.when(F.col("whole"), F.col("license"))).alias("whole"),
            F.count(F.when(~F.col("whole"), 1)).alias("lines"),
            F.collect_set("license").alias("names"),
        )
    )
    k1, k2 = text_key(F.col(text))
    copies = docs.select(k1, k2).groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    per_text = found.join(copies, ["k1", "k2"]).withColumn("lines", (F.col("lines") / F.col("copies")).cast("bigint"))
    rows = docs.select(F.col(key).alias("key"), k1, k2)
    return rows.join(per_text, ["k1", "k2"], "left").select(
        F.col("key").alias(key),
        "whole",
        F.coalesce("lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.array_join(F.array_sort("names"), ","), F.lit("")).alias("licenses"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    def form(column):
        # RE2 spells a back reference differently.
        out = f"regexp_replace(lower({column}), '{COPYRIGHT_LINE}', ' ', 'g')".replace("\\\\", "\\")
        for pattern, replacement in SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
        return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"

    values = ", ".join("('{}', '{}')".format(name, body.replace("'", "''")) for name, body in KNOWN)
    return f"""
    WITH known AS (
        SELECT DISTINCT sha256({form("body")}) AS digest, license FROM (VALUES {values}) AS v(license, body)
    ), pieces AS (
        SELECT doc_id, TRUE AS is_whole, text AS piece FROM documents
        UNION ALL SELECT doc_id, FALSE, unnest(string_split(text, chr(10))) FROM documents
    ), found AS (
        SELECT doc_id, min(license) FILTER (is_whole) AS whole, count(*) FILTER (NOT is_whole) AS n_lines,
            string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
        FROM pieces JOIN known ON sha256({form("piece")}) = digest WHERE {form("piece")} <> '' GROUP BY doc_id
    )
    SELECT doc_id, whole, coalesce(n_lines, 0) AS n_lines, coalesce(licenses, '') AS licenses
    FROM documents LEFT JOIN found USING (doc_id)
    """


SQL = _sql()
