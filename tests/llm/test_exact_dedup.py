import hashlib
import random

import pytest
from rows import empty, special

from tillwise.llm import exact_dedup

DELETED = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    """Per row: (doc_id, keep_id, group_size, kept, digest); ties between equal rows by their place."""
    groups = {}
    for at, (doc_id, text) in enumerate(rows):
        plain = (text or "").translate(DELETED)
        groups.setdefault(plain, []).append((-len(text or ""), doc_id is None, doc_id or 0, at))
    out = []
    for plain, members in groups.items():
        best = min(members)
        for member in members:
            doc_id = rows[member[3]][0]
            out.append((doc_id, rows[best[3]][0], len(members), member is best, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(rng, n):
    texts = ["a b  c", "abc", "ab\tc", "", " \n", None, "a bc", "ABC", "\x0bä ö", "äö", "漢字"]
    texts += [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    return [(i, rng.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("parts,fan_in", [(1, 8), (7, 2), (30, 3), (30, 8), (9, 64)])
def test_equals_brute_force_over_rounds(spark, parts, fan_in):
    rows = made(random.Random(parts * fan_in), 400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert got(exact_dedup.classes(df, fan_in)) == brute(rows)


def test_special_rows(spark):
    df = special(spark).repartition(5)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows)
    result = got(exact_dedup.classes(df, 2))
    assert [r[:3] + r[4:] for r in result] == [r[:3] + r[4:] for r in want]
    # one row stays per text, also of repeated rows and of rows without an id
    assert sum(r[3] for r in result) == len({r[4] for r in result})
    assert all(r[0] == r[1] for r in result if r[3])


def test_empty_table(spark):
    assert got(exact_dedup.classes(empty(spark))) == []
    assert exact_dedup.keep_one(empty(spark)).count() == 0


def test_only_null_ids(spark):
    df = spark.createDataFrame([(None, "x y"), (None, "xy"), (None, None)], "doc_id long, text string")
    assert [r[1:4] for r in got(exact_dedup.classes(df))] == [r[1:4] for r in brute([tuple(r) for r in df.collect()])]


def test_rows_that_stay_keep_columns_with_clashing_names(spark):
    names = "keep_id group_size kept text_sha256 carried id size run row digest left_size best n from_run from_digest from_size"
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    for name in names.split():
        df = df.selectExpr("*", f"concat('{name}', doc_id) AS {name}")
    kept = exact_dedup.keep_one(df).collect()
    assert sorted((r.doc_id, r.text, r.kept, r.n) for r in kept) == [(1, "a b", "kept1", "n1"), (3, "c", "kept3", "n3")]
    assert list(kept[0].asDict()) == df.columns
    assert got(exact_dedup.classes(df)) == brute([(1, "a b"), (2, "ab"), (3, "c")])


def test_a_hot_text_is_one_entry_per_run(spark):
    rows = [(i, "hot  text" if i % 3 else f"t{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    assert got(exact_dedup.classes(df, 4)) == brute(rows)
