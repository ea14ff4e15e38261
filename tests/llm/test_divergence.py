import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from rows import empty, special

from tillwise.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups[(lang or "", source or "")].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs.keys() | {k[0] for k in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (l, s), c in groups.items() if l == lang}
        whole = Counter()
        for c in own.values():
            whole.update(c)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        by = {s: shares(c) for s, c in own.items()}
        all_q = shares(whole)
        for s, p in by.items():
            items = [(-sum(f(p[t], q[t]) for t in kept), o.encode(), o) for o, q in by.items() if o != s]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(items))]
            items = [(-f(p[t], all_q[t]), t.encode(), t) for t in kept if own[s][t] and p[t] > all_q[t]]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(items)[:top])]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def made(rng, docs, sources, vocabulary):
    rows = []
    for _ in range(docs):
        source = rng.randrange(sources)
        low = source * 3 % vocabulary  # sources share some words and have some of their own
        words = [f"{'wW'[rng.random() < 0.3]}ö{chr(97 + n // 26 % 26)}{chr(97 + n % 26)}" for n in
                 (int(low + rng.random() ** 2 * vocabulary) % vocabulary for _ in range(rng.randrange(0, 40)))]
        rows.append((rng.choice([" ", "-1", "\n"]).join(words), rng.choice(["en", "de", None]), f"s{source}"))
    return rows


@pytest.mark.parametrize("docs,sources,vocabulary,least", [(300, 3, 60, 10), (400, 21, 300, 3), (300, 70, 500, 2), (40, 2, 5, 10)])
def test_equals_brute_force(spark, docs, sources, vocabulary, least):
    rows = made(random.Random(docs + sources), docs, sources, vocabulary)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert got(divergence.audit(df, least)) == brute(rows, least)


def test_zero_quadrants_are_priced_by_width(spark):
    """Sources without common terms: most quadrants hold nothing for both of a pair."""
    rows = []
    for source in range(12):
        words = " ".join("x" + chr(97 + source) + chr(97 + n // 26) + chr(97 + n % 26) for n in range(120))
        rows += [(words, "en", f"s{source}")] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(df, 2)) == brute(rows, 2)


def test_terms_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = made(random.Random(5), 60, 3, 20)
    df = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    found = divergence._count(iter(df.selectExpr("coalesce(lang, '') lang", "source", "cast(text as binary) text").toArrow().to_batches(7)))
    counts = Counter()
    for batch in found:
        for r in batch.to_pylist():
            counts[(r["lang"], r["source"], r["term"])] += r["n"]
    want = Counter()
    for text, lang, source in rows:
        for t in TERM.findall(text):
            want[(lang or "", source, t.translate(LOWER))] += 1
    assert {k: n for k, n in counts.items() if k[2] is not None} == want


def test_no_term_is_kept(spark):
    rows = [("a b", "en", "x"), (None, "en", "y"), ("", None, None), ("1 2", "", "z"), ("c", "", "")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(df)) == brute(rows)
    assert {r[4] for r in got(divergence.audit(df))} == {0}


def test_special_rows_and_columns(spark):
    df = special(spark)
    for name in ("term", "n", "docs", "place", "members", "r", "s", "v", "p", "q", "col", "value", "rank", "part", "item", "spot", "task"):
        df = df.withColumn(name, F.lit("x"))
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert got(divergence.audit(df, 2)) == brute(rows, 2)


def test_empty_table(spark):
    assert got(divergence.audit(empty(spark))) == []
