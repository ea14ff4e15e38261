import json
import textwrap

import rows

from tillwise.llm import licenses


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in licenses.scan(df, licenses.known_licences(spark)).orderBy("doc_id").collect()]


def test_whole_texts_in_canonical_form(spark):
    changed = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + licenses.MIT.upper().replace(",", " ;").replace("\n", "\n\n  ")
    spelled = licenses.MIT.replace("sublicense", "sub-license")
    other = licenses.MIT.replace("free of charge", "for a fee")
    assert [x[0] for x in scan(spark, [licenses.MIT, changed, spelled, other, licenses.ISC, "MIT"])] == ["MIT", "MIT", "MIT", None, "ISC", None]


def test_lines_are_notices(spark):
    text = "some words\n  released under the M.I.T. licence\nReleased under the MIT Licence!\nLicensed under CC BY-NC 4.0.\nend"
    got = scan(spark, [text, "see: Released under the MIT License. Or not", "SPDX-License-Identifier: GPL-3.0-only"])
    assert got == [(None, "CC-BY-NC-4.0,MIT"), (None, None), ("GPL-3.0", "GPL-3.0")]


def test_special_rows(spark):
    df = rows.special(spark)
    got = licenses.scan(df, licenses.known_licences(spark)).collect()
    assert len(got) == df.count() and all(r.text_licence is None and r.notices is None for r in got)
    assert licenses.scan(rows.empty(spark), licenses.known_licences(spark)).collect() == []
    none = spark.createDataFrame([], "licence string, text string")
    assert licenses.scan(df, none).count() == df.count()
    copied = spark.createDataFrame([(1, licenses.MIT), (1, licenses.MIT), (None, licenses.MIT), (None, None)], "doc_id long, text string")
    found = [r.text_licence for r in licenses.scan(copied, licenses.known_licences(spark)).collect()]
    assert found == ["MIT"] * 4  # rows that share an id, also a null one, share their findings


def test_many_known_texts_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(licenses, "SMALL", 0)
    assert scan(spark, [licenses.MIT, "x"]) == [("MIT", None), (None, None)]


def test_whole_texts_of_common_licences(spark):
    rows_ = json.loads(licenses.WHOLE.read_text(encoding="utf-8"))
    first = {}
    for row in rows_:
        first.setdefault((row["licence"], row["kind"]), row["text"])
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "CC0-1.0"} <= {k for k, kind in first if kind == "text"}
    keys = sorted(first)
    changed = ["Copyright 2021 Somebody\n\n" + first[k].upper().replace(",", " ,") for k in keys]
    cut = [first[k][: len(first[k]) // 2] for k in keys]
    got = scan(spark, changed + cut)
    assert [x[0] for x in got] == [k for k, _ in keys] + [None] * len(keys)
    apache = first["Apache-2.0", "text"]
    without_title = apache[apache.index("TERMS AND CONDITIONS") :]
    untitled = scan(spark, [without_title, without_title[: without_title.index("END OF TERMS")], "x\n" + " ".join(first["Apache-2.0", "notice"].split())])
    assert untitled == [("Apache-2.0", None)] * 2 + [(None, "Apache-2.0")]


def test_wrapping_does_not_count(spark):
    known = [r for r in json.loads(licenses.WHOLE.read_text(encoding="utf-8")) if r["kind"] == "text"]
    names, wrapped = [], []
    for row in known:
        paragraphs = row["text"].split("\n\n")
        for width in (40, 56, 68, 72, 100, 10**9):
            text = "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False) for p in paragraphs)
            wrapped += [text, "Copyright (c) 2019, 2021 The Authors\nAll rights reserved.\n\n" + text]
            names += [row["licence"]] * 2
    assert len({r["licence"] for r in known}) >= 18
    assert [x[0] for x in scan(spark, wrapped)] == names


def test_words_of_a_clause_are_no_statement(spark):
    changed = licenses.MIT.replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace("above copyright", "above\ncopyright")
    clause = licenses.MIT + "\n(c) one more clause of the licence"
    assert [x[0] for x in scan(spark, [changed, clause, licenses.MIT + "\n(c) 2020 Somebody"])] == ["MIT", None, "MIT"]
