import hashlib
import random

import numpy as np
import pytest
import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import fingerprint as fp


def slow_chunks(data):
    """Byte by byte, with the hash of the last 32 bytes."""
    out, start, h = [], 0, 0
    for i, byte in enumerate(data):
        h = ((h << 1) + int(fp.GEAR[byte])) & 0xFFFFFFFF
        size, end = i + 1 - start, i + 1
        left = len(data) - start
        if left <= fp.SHORTEST:
            continue
        cut = size >= fp.LONGEST
        cut = cut or (fp.SHORTEST <= size < fp.NORMAL and h & int(fp.STRICT) == 0)
        cut = cut or (size >= fp.NORMAL and h & int(fp.LOOSE) == 0)
        if cut:
            out.append(data[start:end])
            start = end
    return out + ([data[start:]] if start < len(data) else [])


def brute(texts):
    """Rows for (id, text) in the stated order."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    order = sorted(texts, key=key, reverse=True)
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        sets = [{c: len(c) for c in slow_chunks(x.encode())} for x in (t, new, after)]
        share = lambda a, b: (float(a == b) if not a or not b else sum(n for c, n in a.items() if c in b) / sum(a.values()))
        yield d, len(t), hashlib.sha256(new.encode()).hexdigest(), share(sets[0], sets[1]), share(sets[0], sets[2])


def check(spark, texts):
    got = fp.compare_with_next(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    want = [(d, n, h, round(a, 9), round(b, 9)) for d, n, h, a, b in brute(texts)]
    assert sorted(map(str, have)) == sorted(map(str, want))
    return got


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=600))
def test_chunks_as_byte_by_byte(text):
    data = text.encode()
    strict, loose = fp.cut_points(data) if data else ([], [])
    ends = list(fp.chunk_ends(0, len(data), strict, loose))
    chunks = [data[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(chunks) == data and chunks == slow_chunks(data)


@pytest.mark.parametrize("seed", range(3))
def test_as_brute_force(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), 150)
    check(spark, [(i, rows.words(rng, rng.randrange(0, 200)) + rng.choice(["", "é", "漢"])) for i in ids])


def test_special_rows(spark):
    got = check(spark, [(r.doc_id, r.text) for r in rows.special(spark).collect()])
    by_text = {}
    texts = {r.doc_id: r.text for r in rows.special(spark).collect() if r.doc_id not in (5, None)}
    for r in got:
        if r.doc_id in texts:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert fp.compare_with_next(rows.empty(spark)).collect() == []
    check(spark, [(4, "alone, followed by itself")])
    check(spark, [(None, "a"), (None, "b" * 300), (1, None)])


def test_insertion_moves_few_chunks():
    rng = random.Random(6)
    text = rows.words(rng, 2000, 5000).encode()
    a, b = fp.fingerprints([text, text[:3000] + b"inserted words" + text[3000:]])
    assert fp.containment(a, b) > 0.95
    assert (fp.from_text(fp.as_text(a)) == a).all() and fp.from_text("").tolist() == []
    assert np.array_equal(fp.fingerprints([b"x", text])[1], a)
