from collections import Counter, defaultdict
import random

import numpy as np
import pytest
import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import link_counts, ngram_join as nj
from tillwise.llm.components import components


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(texts, k, num, den):
    """(n_shingles, least reachable id) per row of (id, text)."""
    sets = [shingles(t, k) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (d, _) in enumerate(texts):
        least[root(i)].append(d)
    return [
        (d, len(s), min((x for x in least[root(i)] if x is not None), default=None) if s else d)
        for i, ((d, _), s) in enumerate(zip(texts, sets))
    ]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, texts, k, num, den):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = [tuple(r) for r in nj.link(df, k, num, den).collect()]
    assert sorted(got, key=key) == sorted(brute(texts, k, num, den), key=key)


def copies(seed, n=150):
    rng = random.Random(seed)
    texts, passage = [], rows.words(rng, 60)
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.4:
            words = rng.choice(texts)[1].split()
            for _ in range(rng.randrange(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
            text = " ".join(words)
        elif kind < 0.6:
            text = passage + " " + rows.words(rng, rng.randrange(0, 12))
        else:
            text = rows.words(rng, rng.randrange(0, 140))
        texts.append((i, text))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80)])
def test_links_as_brute_force(spark, k, num):
    check(spark, copies(num), k, num, 100)


def test_costly_signatures_use_deletion_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(nj, "COSTLY", 2)
    check(spark, copies(7, 120), 3, 80, 100)
    check(spark, copies(8, 120), 3, 60, 100)


def test_special_rows(spark):
    df = rows.special(spark)
    got = nj.link(df, 3, 90, 100).collect()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, got), key=key) == sorted(brute(texts, 3, 90, 100), key=key)
    assert nj.link(rows.empty(spark), 3, 90, 100).collect() == []


def test_only_ids_equals_semi_join(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'t' as text")
    ids = spark.range(0, 9000, 7).selectExpr("id as node")
    assert sorted(r.doc_id for r in nj.only_ids(docs, "doc_id", ids).collect()) == list(range(0, 5000, 7))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 400), st.integers(0, 400), st.sampled_from([60, 80, 90]), st.integers(0, 9))
def test_similar_sets_share_a_signature(size, more, less, num, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    b = np.unique(np.concatenate([a[min(less, len(a) - 1) :], rng.integers(0, 2**63, more).astype(np.uint64)]))
    bands = nj.Bands(num, 100)
    if nj.similar(a, b, num, 100):
        assert len(np.intersect1d(nj.signatures(a, bands), nj.signatures(b, bands)))
        assert len(np.intersect1d(nj.deletion_signatures(a, bands), nj.deletion_signatures(b, bands)))


def test_similar_counts_exactly():
    a = np.arange(100, dtype=np.uint64)
    assert nj.similar(a, a[:90], 90, 100) and not nj.similar(a, a[:89], 90, 100)


def test_components(spark, tmp_path):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        if len(seen) > 1:
            assert found[node] == min(seen)
    assert Counter(found) and components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "e")).count() == 0


def test_without_ids_equals_anti_join(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'t' as text")
    ids = spark.range(0, 9000, 7).selectExpr("id as node")
    assert sorted(r.doc_id for r in nj.without_ids(docs, "doc_id", ids).collect()) == [i for i in range(5000) if i % 7]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 2000), st.integers(0, 300), st.integers(0, 300), st.integers(0, 9))
def test_profiles_give_a_lower_bound(size, more, less, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    b = np.unique(np.concatenate([a[min(less, len(a) - 1) :], rng.integers(0, 2**63, more).astype(np.uint64)]))
    assert nj.least_apart(nj.profile(a), len(a), nj.profile(b), len(b)) <= nj.apart(a, b) == len(set(a.tolist()) ^ set(b.tolist()))


def check_all(spark, df, k, num, den):
    """Components as brute force, and the number of all links of every row."""
    texts = [(r.doc_id, r.text) for r in df.collect()]
    sets = [shingles(t, k) for _, t in texts]
    n_links = [
        sum(i != j and den * len(a & b) >= num * len(a | b) for j, b in enumerate(sets) if b) if a else 0
        for i, a in enumerate(sets)
    ]
    want = [(*row, n) for row, n in zip(brute(texts, k, num, den), n_links)]
    assert sorted(map(tuple, nj.link_all(df, k, num, den).collect()), key=key) == sorted(want, key=key)
    return n_links


@pytest.mark.parametrize("costly", [2, 1024])
def test_every_link_is_counted(spark, monkeypatch, costly):
    monkeypatch.setattr(nj, "COSTLY", costly)
    df = spark.createDataFrame(copies(11), "doc_id long, text string")
    assert max(check_all(spark, df, 3, 80, 100)) > 20


def test_every_link_of_special_rows_and_null_ids(spark):
    check_all(spark, rows.special(spark), 3, 90, 100)
    assert nj.link_all(rows.empty(spark), 3, 90, 100).collect() == []
    words = rows.words(random.Random(12), 100, 10**6).split()
    bridge = [(1, words), (None, words[5:] + ["x"] * 5), (2, words[10:] + ["x"] * 10)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in bridge], "doc_id long, text string")
    assert check_all(spark, df, 1, 90, 100) == [1, 2, 1]


def test_a_null_id_links_two_others(spark):
    words = rows.words(random.Random(13), 100, 10**6).split()
    bridge = [(1, words), (None, words[5:] + ["x"] * 5), (2, words[10:] + ["x"] * 10)]
    check(spark, [(i, " ".join(w)) for i, w in bridge], 1, 90, 100)


@pytest.mark.parametrize("block", [3, 512])
def test_links_of_a_large_component_over_blocks(spark, monkeypatch, block):
    """Near copies in a chain: many are linked, many of one component are not."""
    monkeypatch.setattr(link_counts, "BLOCK", block)
    rng = random.Random(14)
    words = rows.words(rng, 90, 10**6).split()
    texts = []
    for i in range(60):
        words = list(words)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    links = check_all(spark, spark.createDataFrame(texts, "doc_id long, text string"), 2, 80, 100)
    assert max(links) < 59 and min(links) > 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 30), max_size=12), min_size=1, max_size=20), st.lists(st.frozensets(st.integers(0, 30), max_size=12), min_size=1, max_size=20), st.sampled_from([3, 1 << 22]))
def test_shared_elements_of_two_blocks(left, right, pairs):
    arrays = [[np.array(sorted(s), np.uint64) for s in side] for side in (left, right)]
    before, link_counts.PAIRS = link_counts.PAIRS, pairs
    try:
        found = link_counts._shared(*arrays)
    finally:
        link_counts.PAIRS = before
    assert found.tolist() == [[len(a & b) for b in right] for a in left]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(0, 20), st.integers(0, 20), st.sampled_from([60, 80, 90]), st.integers(0, 9))
def test_similar_short_sets_share_a_signature(size, more, less, num, seed):
    test_similar_sets_share_a_signature.hypothesis.inner_test(size, more, less, num, seed)


def test_unlike_sets_of_one_band_share_no_signature():
    """Large sets leave segments empty; they are no reason to compare them."""
    rng, bands = np.random.default_rng(5), nj.Bands(80, 100)
    sets = [np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64)) for _ in range(12)]
    found = np.concatenate([np.unique(nj.signatures(s, bands)) for s in sets])
    assert len(np.unique(found)) == len(found)
    assert all(len(nj.signatures(s, bands)) < 1.1 * sum(bands.differing(b) + 1 for b in bands.schemes(len(s))) for s in sets)


def test_few_steps_for_many_edges(spark, tmp_path):
    """Chains whose edges lie in few tasks are stars before the first shuffle."""
    edges = [(1000 * c + i, 1000 * c + i + 1) for c in range(5) for i in range(200)] * 2
    folder = tmp_path / "c"
    found = components(spark.createDataFrame(edges, "a long, b long").coalesce(1), str(folder)).collect()
    assert sorted(map(tuple, found)) == [(1000 * c + i, 1000 * c) for c in range(5) for i in range(201)]
    assert [p.name for p in folder.iterdir()] == ["step0"]


def test_components_if_tasks_start_again(spark, tmp_path, monkeypatch):
    from tillwise.llm import components as module

    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    whole = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "a")).collect()}
    monkeypatch.setattr(module, "HELD", 3)
    spread = spark.createDataFrame(edges, "a long, b long").repartition(9)
    assert {tuple(r) for r in components(spread, str(tmp_path / "b")).collect()} == whole
