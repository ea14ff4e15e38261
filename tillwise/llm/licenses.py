"""Licence scan: canonical texts, digests, and a hash join with known licence digests.

The canonical form of a text has A-Z lower-cased, everything but ASCII letters, digits and non-ASCII
characters turned into blanks, blanks joined, and equivalent spellings made one. Lines count only for
copyright statements (a line that begins with "copyright" and a year, a sign or a holder's placeholder,
or with "all rights reserved"). A text has up to four forms: with all its words, without
statements, without the statements at its head, and without those of the head's first paragraph. The
first does not depend on how a text is wrapped, the last two stand for a wrapped text below
somebody's statement. Known texts have the same
forms; a text is known if any two of them are equal. Single lines are looked up as one-line notices.

The known texts are the short table `KNOWN` and the whole licence texts and header notices of
`licences.json`, one wrapping each.

A canonical text longer than the longest known one cannot be equal to any, so its spellings are not
rewritten and it is not digested: the bound comes from the known table and loses nothing.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import ascii_lower

WHOLE = Path(__file__).with_name("licences.json")  # read by the driver

# Spellings that count as equal (British or variant form, common form), as words.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licensed", "sublicensed"),
    ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("acknowledgements", "acknowledgments"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("fulfil", "fulfill"),
    ("merchantibility", "merchantability"),
    ("percent", "per cent"),
    ("v2 0", "version 2 0"),
    ("v3", "version 3"),
)

SMALL = 20_000  # known texts (some 100 bytes each) up to which their digests are broadcast; beyond, a shuffle join

YEAR = r"[ \t]*[0-9<\[{]"
STATEMENT = rf"^[ \t]*(?:copyright(?:{YEAR}|[ \t]*(?:\(c\)|©|$))|©|\(c\)(?:{YEAR}|[ \t]*copyright)|all rights reserved)"
NOT_TEXT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F ‐-‟]+"

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in
all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Known texts (licence, text).
KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)


def known_licences(spark) -> DataFrame:
    """The built-in table (licence, text); any other table of that form will do."""
    whole = [(row["licence"], row["text"]) for row in json.loads(WHOLE.read_text(encoding="utf-8"))]
    return spark.createDataFrame([*KNOWN, *whole], "licence string, text string")


def canonical_lines(text: Column) -> Column:
    """Lines of a text as (words in lower case with single blanks, whether it is a copyright statement)."""
    return F.transform(
        F.split(ascii_lower(text), "\n"),
        lambda line: F.struct(
            F.trim(F.regexp_replace(line, NOT_TEXT, " ")).alias("words"), line.rlike(STATEMENT).alias("statement")
        ),
    )


def forms(lines: Column) -> Column:
    """The different forms of a text: all words, without statements, without the statements at its head,
    and without those of the head's first paragraph."""

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(F.filter(some, lambda x: x["words"] != ""), lambda x: x["words"]), " ")

    def first(some: Column, test) -> Column:
        return F.greatest(F.array_position(F.transform(some, test), True), F.lit(1)).cast("int")

    ordinary = first(lines, lambda x: ~x["statement"] & (x["words"] != ""))
    begin = first(lines, lambda x: x["words"] != "")
    rest = F.slice(lines, begin, F.size(lines))
    gap = begin + first(rest, lambda x: x["words"] == "") - 1
    below = F.slice(lines, ordinary, F.size(lines))
    below_gap = F.slice(lines, F.least(gap, ordinary), F.size(lines))
    without = F.filter(lines, lambda x: ~x["statement"])
    return F.array_distinct(F.array(joined(lines), joined(without), joined(below), joined(below_gap)))


def one_spelling(canonical: Column) -> Column:
    """Equivalent spellings made one, word by word; each word gets a blank of its own on both sides."""
    padded = F.concat(F.lit(" "), F.replace(canonical, F.lit(" "), F.lit("  ")), F.lit(" "))
    for variant, common in SPELLINGS:
        spaced = variant.replace(" ", "  ")
        padded = F.replace(padded, F.lit(f" {spaced} "), F.lit(f" {common} "))
    return padded


def _digest(canonical: Column) -> Column:
    return F.sha2(one_spelling(canonical), 256)


def first_word(canonical: Column) -> Column:
    """First word of a form with one spelling; two words tell it, for no spelling has more."""
    return F.substring_index(F.trim(one_spelling(F.substring_index(canonical, " ", 3))), " ", 1)


def digests(licences: DataFrame) -> DataFrame:
    """(licence, digest, first word, length) of all forms of known texts; of one form under two names the
    first by code point."""
    return (
        licences.where("licence is not null and text is not null")
        .select("licence", F.explode(F.array(canonical_lines(F.col("text")))).alias("lines"))
        .select("licence", F.explode(forms(F.col("lines"))).alias("canonical"))
        .where("canonical <> ''")
        .groupBy(_digest(F.col("canonical")).alias("known_digest"))
        .agg(
            F.min("licence").alias("licence"),
            F.min(first_word(F.col("canonical"))).alias("known_first"),
            F.max(F.length("canonical")).alias("known_length"),
        )
    )


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """(doc_id, text_licence, notices): for every row of `docs` the licence that its whole text is, and
    the licences of its lines (sorted, each once, joined by commas).

    Null, empty or unknown texts give null for both. Rows that repeat a doc_id share their findings;
    null ids count as one id. Extra columns are not looked at. An empty licence table finds nothing.
    """
    known = digests(licences)
    size = known.agg(F.max("known_length").alias("longest"), F.count(F.lit(1)).alias("n")).first()
    longest = size.longest or 0
    if size.n <= SMALL:
        known = F.broadcast(known)
    # a rewritten word is at most twice as long or half as long as before
    fits = F.length("canonical").between(1, 2 * longest)
    if size.n <= SMALL:  # texts that begin with no known first word are not digested
        begins = [row.known_first for row in known.select("known_first").distinct().collect()]
        fits &= first_word(F.col("canonical")).isin(begins)
    # below generators, so that filters above them do not compute the expressions again
    lines = F.col("lines")
    unit = F.concat(
        F.transform(forms(lines), lambda form: F.struct(F.lit(True).alias("whole"), form.alias("canonical"))),
        F.transform(
            F.filter(lines, lambda x: ~x["statement"]),
            lambda x: F.struct(F.lit(False).alias("whole"), x["words"].alias("canonical")),
        ),
    )
    units = (
        docs.where("text is not null")
        .select("doc_id", F.explode(F.array(canonical_lines(F.col("text")))).alias("lines"))
        .select("doc_id", F.inline(unit))
        .where(fits)
        .select("doc_id", "whole", _digest(F.col("canonical")).alias("digest"))
    )
    found = (
        units.join(known, F.col("digest") == F.col("known_digest"))
        .groupBy(F.col("doc_id").alias("found_id"))
        .agg(
            F.max(F.when(F.col("whole"), F.col("licence"))).alias("text_licence"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("licence"))))).alias("notices"),
        )
    )
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id", "text_licence", F.when(F.col("notices") != "", F.col("notices")).alias("notices")
    )
