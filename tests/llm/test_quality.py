import random
from collections import Counter

import rows
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import quality


def brute(doc_id, text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    raw = text.encode()
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    size = lambda b: len(zstandard.ZstdCompressor(level=3).compress(b)) / len(b)
    kept = not failed
    if kept:
        low, high = next((a, b) for below, a, b in quality.BANDS if below is None or len(raw) < below)
        kept = low <= size(raw) <= high
        parts = [raw[at : at + 1024] for at in range(0, len(raw), 1024)] if len(raw) >= 1024 else []
        if parts:
            parts[-1] = raw[-1024:]
        odd = [part for part in parts if not 0.485 <= size(part) <= 0.75]
        kept = kept and len(odd) <= len(parts) * 0.02
    return (
        doc_id, len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup,
        len(covered), failed, kept,
    )


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_rules_as_brute_force(spark):
    df = rows.special(spark)
    got = [tuple(r)[:8] for r in quality.rules(df).collect()]
    assert sorted(got, key=key) == sorted((brute(r.doc_id, r.text) for r in df.collect()), key=key)
    assert quality.rules(rows.empty(spark)).collect() == []


def test_keep_returns_whole_rows(spark):
    df = rows.special(spark)
    kept = quality.keep(df)
    assert kept.columns == df.columns
    want = [r for r in df.collect() if brute(r.doc_id, r.text)[7]]
    assert sorted(map(str, kept.collect())) == sorted(map(str, want))
    assert quality.keep(rows.empty(spark)).columns == df.columns


def test_repetitive_and_random_texts_go():
    rng = random.Random(1)
    packer = zstandard.ZstdCompressor(level=3)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(9)) for _ in range(400))
    template = "\n".join(f"item {i} of the list costs {i % 7} coins in every shop of the town" for i in range(200))
    for n in (60, 200, 800, 4000):
        assert quality.judge(1, rows.prose(rng, n).encode(), packer)[7]
    assert not quality.judge(1, noise.encode(), packer)[7]
    assert not quality.judge(1, template.encode(), packer)[7]


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 1023, 1024, 1025, 2047, 2048, 5000):
        text = bytes(i * 7 % 251 for i in range(n))
        parts = quality.chunks(text)
        assert all(len(part) == 1024 for part in parts) and len(parts) == (-(-n // 1024) if n >= 1024 else 0)
        assert not parts or (b"".join(parts[:-1]) + parts[-1][len(parts) * 1024 - n :]) == text


def test_a_bad_end_is_seen():
    rng, packer = random.Random(2), zstandard.ZstdCompressor(level=3)
    good = rows.prose(rng, 3000).encode()
    good = good[: len(good) // 1024 * 1024]
    assert quality.judge(1, good, packer)[7]
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(9)) for _ in range(95)).encode()
    row = quality.judge(1, good + noise, packer)
    assert len(noise) < 1024 and not row[7] and row[11] >= 1


def test_long_texts_of_good_parts_stay():
    """One odd chunk in a thousand takes no long text away; a tenth of them does."""
    rng, packer = random.Random(3), zstandard.ZstdCompressor(level=3)
    good = [rows.prose(rng, 900) for _ in range(160)]
    odd = "\n".join(["the same line again and again"] * 40)
    long = "\n".join([*good[:80], odd, *good[80:]]).encode()
    row = quality.judge(1, long, packer)
    assert len(long) > 500_000 and row[11] >= 1 and row[7] == (not row[6])
    many = "\n".join(x for text in good for x in (text, odd)).encode()
    assert not quality.judge(1, many, packer)[7]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=30))
def test_repeated_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    assert quality.repeated_words(words) == len(covered)
