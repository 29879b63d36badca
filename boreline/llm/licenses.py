"""Licence scan: canonical digests of whole texts against known licences, in DataFrame functions only.

A text, and each block of it (paragraph or line), is brought to a canonical
form: copyright lines go, case, punctuation and white space are unified, and
equivalent spellings become one. Its digest is hash-joined with the digests of
the known licences, which went through the same form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import text_of

# Licence texts and notices as published, by SPDX identifier.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
KNOWN = [
    ("MIT", MIT_GRANT),
    ("MIT", "MIT License\n\n" + MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC_GRANT),
    ("ISC", "ISC License\n\n" + ISC_GRANT),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-or-later", GPL3_NOTICE),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
]
# Spellings that count as equal, the first as the second.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorised", "authorized"),
    ("recognised", "recognized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("per cent", "percent"),
    ("http", "https"),
    ("v", "version"),
]
COPYRIGHT_LINE = r"(?im)^[^a-z\n]*(?:copyright|\(c\)|©)(?:[^a-z]*(?:\(c\)|©|[0-9]{4}))[^\n]*$"


def canonical(text: Column) -> Column:
    """The form in which texts are compared; empty for texts of punctuation only.

    Whole lines like "Copyright (c) 2020 Name" are left out. Letters and
    digits of any script stay, everything else parts words.
    """
    form = F.regexp_replace(text, COPYRIGHT_LINE, "")
    form = F.trim(F.regexp_replace(F.lower(form), r"[^\p{L}\p{N}]+", " "))
    unified = form
    for spelling, other in SPELLINGS:
        unified = F.regexp_replace(unified, rf"(?<![^ ]){spelling}(?![^ ])", other)
    # Few texts have any of them: one pass tells.
    return F.when(form.rlike(r"(?<![^ ])(?:" + "|".join(s for s, _ in SPELLINGS) + r")(?![^ ])"), unified).otherwise(form)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``license``, ``digest``, ``letters`` (length of the canonical form); one row per known digest."""
    rows = spark.createDataFrame(known, "license string, text string").withColumn("form", canonical(F.col("text")))
    return rows.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"), F.max(F.length("form")).alias("letters"))


def _runs(paragraphs: Column, n: int) -> Column:
    """Each n paragraphs in a row, as one block."""
    starts = F.when(F.size(paragraphs) >= n, F.sequence(F.lit(1), F.size(paragraphs) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.array_join(F.slice(paragraphs, k, n), "\n\n"))


def scan(df: DataFrame, known: list[tuple[str, str]] = KNOWN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``digest`` and ``license`` of the whole text, and ``blocks``, ``block_licenses`` of its parts.

    ``digest`` is the SHA-256 of the canonical form; ``license`` is null where
    the whole text is no known licence. ``blocks`` counts the lines,
    paragraphs and runs of paragraphs that are one; runs are as long as the
    longest known text; what is one line and one paragraph counts once. One row per input
    row and no shuffle: the known digests, fixed in number by the list, are
    broadcast. Null and empty texts have the digest of the empty form and no
    licence. Repeated rows give repeated rows; other columns are ignored.

    A block of more than five times the characters of the longest known text
    is not looked at: it is no licence with other punctuation.
    """
    spark = df.sparkSession
    table = known_digests(spark, known)
    longest = 5 * max((len(t) for _, t in known), default=0)
    # As many as the caller's list has texts.
    names = F.create_map(*(F.lit(v) for r in table.collect() for v in (r.digest, r.license))) if known else F.lit(None).cast("map<string,string>")
    raw = F.regexp_replace(text_of(text), "\r\n?", "\n")
    rows = df.select(F.col(key), raw.alias("raw"))
    paragraphs = F.split("raw", r"\n[ \t]*\n\s*")
    run = max((1 + t.count("\n\n") for _, t in known), default=1)
    runs = [_runs(paragraphs, n) for n in range(2, run + 1)]
    blocks = F.concat(F.split("raw", "\n"), F.filter(paragraphs, lambda p: p.contains("\n")), *runs)
    short = F.filter(blocks, lambda b: (F.length(b) <= longest) & (F.length(b) > 2))
    digests = F.transform(short, lambda b: F.sha2(canonical(b), 256))
    found = rows.select(key, F.sha2(canonical(F.col("raw")), 256).alias("digest"), digests.alias("digests"))
    whole = found.join(F.broadcast(table.select("digest", "license")), "digest", "left")
    hits = F.filter(F.transform("digests", lambda d: F.try_element_at(names, d)), lambda n: n.isNotNull())
    both = whole.withColumn("hits", hits)
    return both.select(key, "digest", "license", F.size("hits").cast("bigint").alias("blocks"), F.array_join(F.array_sort(F.array_distinct("hits")), ",").alias("block_licenses"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_canonical(text: str) -> str:
    form = f"' ' || trim(regexp_replace(lower(regexp_replace({text}, '{COPYRIGHT_LINE}', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') || ' '"
    for spelling, other in SPELLINGS:
        for _ in range(2):  # two in a row share a space
            form = f"replace({form}, ' {spelling} ', ' {other} ')"
    return f"trim({form}, ' ')"


def _sql(known: list[tuple[str, str]]) -> str:
    """The same over single lines and whole texts, which is all there is in texts without blank lines."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in known)
    return f"""
WITH known AS (SELECT min(license) AS license, sha256({_sql_canonical("text")}) AS digest FROM (VALUES {values}) AS v(license, text) GROUP BY 2),
raw AS (SELECT doc_id, row_number() OVER () AS n, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS raw FROM documents),
lines AS (SELECT n, unnest(string_split(raw, chr(10))) AS line FROM raw),
hits AS (
  SELECT n, count(*) AS blocks, string_agg(DISTINCT license, ',' ORDER BY license) AS block_licenses
  FROM lines JOIN known ON sha256({_sql_canonical("line")}) = digest WHERE length(line) > 2 GROUP BY 1),
whole AS (SELECT doc_id, n, sha256({_sql_canonical("raw")}) AS digest FROM raw)
SELECT w.doc_id, w.digest, k.license, coalesce(h.blocks, 0) AS blocks, coalesce(h.block_licenses, '') AS block_licenses
FROM whole w LEFT JOIN known k ON w.digest = k.digest LEFT JOIN hits h ON w.n = h.n
"""


ORACLE = _sql(KNOWN)
