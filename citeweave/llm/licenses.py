"""License scans by canonical digest lookup, in DataFrame operations only.

Lines are brought to a canonical form: lower case, equivalent spellings made
one, copyright statements emptied, everything but letters and digits one space. A
line is a copyright statement if it begins with the sign, or with the word or "(c)"
before another of them, a year, "by" or a bracket, so that lines of a licence's
body, wherever they are wrapped, are not. The canonical lines together, without
"All rights reserved", are a text's canonical form. Its sha256, that of the form
without a first line that is a licence's title, if more follows, and that of each
line are joined by hash with the digests of known licence texts and notices, which
went through the same form. The text with its title goes first.

Defined results: a null or empty text has the digest of the empty string, no
licence and no licence lines; nor does a text whose canonical form is empty.
Rows that repeat a doc_id share the findings of their lines; a row without a
doc_id gets only the whole-text lookup. A digest that several known texts share
stands for the first licence id in order. Other columns are not read.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import keep

# Spellings that licence matching treats as one.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("judgement", "judgment"),
    ("labour", "labor"), ("offence", "offense"), ("organisation", "organization"), ("per cent", "percent"), ("programme", "program"),
    ("recognised", "recognized"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("https://", "http://"), ("&", " and "),
]
#: Those of several words, once more for joined lines: a line may have ended inside them.
JOINED = list(dict.fromkeys((a.replace("-", " "), b) for a, b in SPELLINGS if a.replace("-", " ").count(" ") == 1 and a[0].isalpha()))
#: A line that is only a copyright statement, after lower case and spellings.
COPYRIGHT_LINE = r"^[^a-z0-9\n©(]*(©|(copyright|\(c\))[^a-z0-9\n]*(\(c\)|©|[0-9]{4}|by[^a-z0-9\n]|copyright|[<\[{]))[^\n]*"
RIGHTS = "all rights reserved"
#: Everything between words, but for the end of a line.
BETWEEN = r"[^\p{L}\p{N}\n]+"

# Names of licences, and the notices that name them.
NAMES = {
    "0BSD": ["the Zero-Clause BSD License"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "AGPL-3.0", "the AGPLv3"],
    "Apache-2.0": ["the Apache License, Version 2.0", "Apache-2.0", "the Apache License 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the Simplified BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the New BSD License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "the CC0 1.0 Universal Public Domain Dedication"],
    "EPL-2.0": ["the Eclipse Public License 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GPLv3"],
    "ISC": ["the ISC License"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "MIT": ["the MIT License", "MIT"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0"],
    "Unlicense": ["the Unlicense"],
    "Zlib": ["the zlib License"],
}
NOTICES = ["Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.",
           "This project is licensed under {}.", "This software is licensed under {}.", "SPDX-License-Identifier: {id}"]
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}


def titles() -> list[str]:
    """Canonical first lines that name a licence: its names with and without "the", and with its id."""
    out = set()
    for licence, names in NAMES.items():
        for name in (*names, licence):
            plain = name.removeprefix("the ")
            out |= {x for base in (name, plain) for x in (base, f"{base} {licence}", f"{base} license")}
    return sorted({" ".join("".join(c if c.isalnum() else " " for c in x.lower()).split()) for x in out})


def known_texts() -> list[tuple[str, str]]:
    """(licence id, text), each text once."""
    out = list(TEXTS.items())
    for licence, names in NAMES.items():
        for form in NOTICES:
            out += [(licence, form.format(name, id=licence)) for name in (names if "{}" in form else names[:1])]
    return out


def whole_texts() -> list[tuple[str, str]]:
    """(licence id, text) of the whole licences in known_licences; what follows a + in a
    file's name tells wordings of one licence apart."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "known_licences")
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out.append((name.removesuffix(".txt").split("+")[0], f.read()))
    return out


def canonical_text(text: Column) -> Column:
    """The text with every line in canonical form. It works on whole texts, not on
    arrays of lines: such expressions are compiled, and common parts run once."""
    text = F.lower(F.coalesce(text, F.lit("")))
    for spelling, same in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(same))
    text = F.regexp_replace(text, "(?dm)" + COPYRIGHT_LINE, "")
    return F.regexp_replace(text, BETWEEN, " ")


def line_digests(canonical: Column) -> Column:
    """sha256 of each line that is not empty, of all of them together, and of those after a title."""
    lines = F.filter(F.transform(F.split(canonical, "\n", -1), lambda x: F.trim(x)), lambda x: (x != "") & (x != RIGHTS))

    def joined(lines):
        out = F.array_join(lines, " ")
        for spelling, same in JOINED:
            out = F.replace(out, F.lit(spelling), F.lit(same))
        return F.sha2(out, 256)

    def of(lines):
        named = (F.size(lines) > 1) & F.get(lines, F.lit(0)).isin(*titles())
        return F.struct(F.transform(lines, lambda x: F.sha2(x, 256)).alias("lines"), joined(lines).alias("whole"),
                        F.when(named, joined(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))))).alias("untitled"))

    # A lambda's argument is evaluated once, however often it is named.
    return F.get(F.transform(F.array(lines), of), F.lit(0))


EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # sha256 of nothing


def digests(texts: DataFrame) -> DataFrame:
    """(digest, license) of known texts (license, text); one licence a digest."""
    return texts.select("license", canonical_text(F.col("text")).alias("c")).select("license", line_digests(F.col("c")).alias("d")) \
        .select("license", F.col("d.whole").alias("digest")).where(F.col("digest") != EMPTY) \
        .groupBy("digest").agg(F.min("license").alias("license"))


def known_licences(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(a).alias("license"), F.lit(b).alias("text")) for a, b in known_texts() + whole_texts()])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text_sha256 (of the canonical text), text_license, line_licenses
    (ids in order, joined by commas) and n_license_lines for each row of ``docs``."""
    known = keep(digests(known), "licence-digests")
    forms = keep(docs.select("doc_id", canonical_text(F.col("text")).alias("c")).select("doc_id", line_digests(F.col("c")).alias("d"))
                 .select("doc_id", "d.*"), "text-digests")
    found = (
        forms.where("doc_id is not null").select("doc_id", F.explode("lines").alias("digest")).join(known, "digest")
        .groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"),
                               F.count("*").alias("n_license_lines"))
    )
    whole = forms.select("doc_id", F.col("whole").alias("text_sha256"), "untitled")
    looked = whole.join(known, F.col("digest") == F.col("text_sha256"), "left") \
        .join(known.select(F.col("digest").alias("of"), F.col("license").alias("titled")), F.col("of") == F.col("untitled"), "left")
    return looked.join(found, "doc_id", "left").select(
        "doc_id", "text_sha256", F.coalesce("license", "titled").alias("text_license"), F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"))


def oracle_sql() -> str:
    """The same over ``documents`` for DuckDB."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    form = "lower(line)"
    for spelling, same in SPELLINGS:
        form = f"replace({form}, {quoted(spelling)}, {quoted(same)})"
    form = f"(select case when y = {quoted(RIGHTS)} then '' else y end from (select case when regexp_matches(x, {quoted(COPYRIGHT_LINE)}) then '' else trim(regexp_replace(x, {quoted(BETWEEN)}, ' ', 'g')) end as y from (select {form} as x)))"
    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known_texts() + whole_texts())
    title = f"({', '.join(map(quoted, titles()))})"
    whole, untitled = "string_agg(form, ' ' order by pos)", "string_agg(form, ' ' order by pos) filter (not title)"
    for spelling, same in JOINED:
        whole, untitled = (f"replace({x}, {quoted(spelling)}, {quoted(same)})" for x in (whole, untitled))
    return rf"""
with raw(license, text) as (values {values}),
klines as (select row_number() over () as k, license, string_split(text, chr(10)) as parts from raw),
kline as (select k, license, unnest(range(len(parts))) as pos, unnest(parts) as line from klines),
kform as (select k, license, pos, {form} as form from kline),
known as (select digest, min(license) as license from (
    select k, any_value(license) as license, sha256({whole}) as digest
    from kform where form <> '' group by k) group by digest),
parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
line as (select doc_id, unnest(range(len(parts))) as pos, unnest(parts) as line from parts),
form as (select doc_id, pos, {form} as form from line),
solid as (select *, form in {title} and pos = min(pos) over (partition by doc_id) and count(*) over (partition by doc_id) > 1 as title
          from form where form <> ''),
body as (select doc_id, {whole} as body, case when bool_or(title) then sha256({untitled}) end as untitled from solid group by doc_id),
whole as (select documents.doc_id, sha256(coalesce(body, '')) as text_sha256, untitled
          from documents left join body on documents.doc_id = body.doc_id),
found as (select doc_id, string_agg(distinct license, ',' order by license) as line_licenses, count(*) as n_license_lines
          from form join known on digest = sha256(form) where form <> '' group by doc_id)
select whole.doc_id, text_sha256, coalesce(known.license, titled.license) as text_license, coalesce(line_licenses, '') as line_licenses,
       coalesce(n_license_lines, 0) as n_license_lines
from whole left join known on digest = text_sha256 left join known titled on titled.digest = untitled left join found on found.doc_id = whole.doc_id
"""
