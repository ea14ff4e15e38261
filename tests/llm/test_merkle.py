import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from rows import empty, special

from tillwise.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes, fan):
    """(root, for every node its list of (left, right))."""
    paths, where = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, below = [], []
        for first in range(0, len(nodes), fan):
            run = nodes[first : first + fan]
            for k, members in enumerate(where[first : first + fan]):
                for member in members:
                    paths[member].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            below.append([m for members in where[first : first + fan] for m in members])
        nodes, where = above, below
    return nodes[0], paths


def brute(rows, fan=8):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    names = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    found = []
    for name in names:
        members = sorted(langs[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        found.append((members, *tree([leaf_of(*r) for r in members], fan)))
    if not found:
        return []
    root, top_paths = tree([subroot for _, subroot, _ in found], fan)
    out = []
    for (members, subroot, paths), above in zip(found, top_paths):
        for row, path in zip(members, paths):
            steps = path + above
            tampered = row
            if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                tampered = (*row[:4], row[4].translate(LOWER))
            acc = leaf_of(*tampered)
            for left, right in steps:
                acc = h(left, acc, right)
            proof = h(*(left + right for left, right in steps))
            out.append((row[0], leaf_of(*row), subroot, root, proof, acc, acc == root))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def made(rng, sizes):
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "Upper and lower", "no capitals", f"T{rng.random()} ß 漢"])
            rows.append((len(rows) * 3, rng.choice([None, "s", "ü"]), lang, rng.choice([None, 7]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes,fan",
    [
        ({"en": 1}, 8), ({"en": 8}, 8), ({"en": 9}, 8), ({"en": 65, "de": 1, None: 2}, 8), ({"a": 513}, 8),
        ({"a": 37, "b": 16, "": 3, None: 5, "ä": 1}, 2), ({f"l{i}": 1 for i in range(20)}, 2),
        ({f"l{i}": i + 1 for i in range(11)}, 3),
    ],
)
def test_equals_brute_force(spark, sizes, fan):
    rows = made(random.Random(len(sizes) * fan), sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(merkle.manifest(df, fan)) == brute(rows, fan)


def test_pointers_through_shuffle_joins(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW", 0)
    rows = made(random.Random(1), {"a": 90, "b": 30})
    assert got(merkle.manifest(spark.createDataFrame(rows, SCHEMA), 2)) == brute(rows, 2)


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 3, "Abc" if i % 2 else "abc") for i in range(200)]
    result = got(merkle.manifest(spark.createDataFrame(rows, SCHEMA)))
    bad = {r[0] for r in result if not r[6]}
    assert bad == {i for i in range(1, 200, 2) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_special_rows_and_columns(spark):
    df = special(spark)
    for name in ("tree", "place", "members", "digest", "nr", "row", "steps", "kids", "joined", "alone", "id", "spot", "task"):
        df = df.withColumn(name, F.lit("x"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert got(merkle.manifest(df)) == brute(rows)


def test_empty_table(spark):
    assert got(merkle.manifest(empty(spark))) == []


def test_proofs_of_any_leaves(spark):
    """The operator takes any table of digests and hands other columns on."""
    leaves = spark.createDataFrame([(i, "x", h(str(i)), f"note {i}") for i in range(10)], "doc_id long, lang string, leaf string, note string")
    rows = merkle.proofs(leaves).select("row.note", "row.leaf", "root", merkle.folded(F.col("row.leaf"), F.col("steps")).alias("again")).collect()
    assert {r.note for r in rows} == {f"note {i}" for i in range(10)}
    assert all(r.root == r.again for r in rows)
