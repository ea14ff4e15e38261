import random
from collections import defaultdict

import pytest
import rows

from tillwise.llm import mixing


def brute_targets(sizes):
    """{source: size} -> {source: target}: cap and reshare until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= above


def table(spark, seed, n=300, hot=True):
    rng = random.Random(seed)
    texts = [
        (i, None if rng.random() < 0.05 else rows.words(rng, rng.randrange(0, 60)),
         "s0" if hot and rng.random() < 0.4 else rng.choice([None, "a", "b", "Z", "é", "s0", "s1"]))
        for i in range(n)
    ]
    return spark.createDataFrame(texts, "doc_id long, text string, source string")


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken_words(spark, seed):
    got = mixing.assign(table(spark, seed)).collect()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.mix_source] += r["size"]
        taken[r.mix_source] += r.taken
        targets[r.mix_source] = r.target
        assert r.taken == r["size"] * r.copies <= 3 * r["size"] and len(r.positions) == r.copies
        assert list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
    want = brute_targets(sizes)
    for s, size in sizes.items():
        assert targets[s] == pytest.approx(want[s]) and targets[s] <= 3 * size
        assert all(r.source_size == size for r in got if r.mix_source == s)
        assert abs(taken[s] - targets[s]) <= 60  # one document at most
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))


def test_excess_is_reshared(spark):
    texts = [(0, "a " * 10, "a"), *((i, "b " * 100, "b") for i in range(1, 20)), (99, "c " * 10, "c")]
    got = mixing.assign(spark.createDataFrame(texts, "doc_id long, text string, source string")).collect()
    targets = {r.mix_source: r.target for r in got}
    assert targets["a"] == 30 and targets["c"] == 30 and targets["b"] == pytest.approx(1920 - 60)


def test_positions_follow_the_schedule(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a") for i in range(400)], "doc_id long, text string, source string")
    positions = sorted(p for r in mixing.assign(df).collect() for p in r.positions)
    # weight falls from 1.5 to 0.5 of its mean, so the first half of the time takes 5/8 of the words
    assert sum(p < 0.5 for p in positions) / len(positions) == pytest.approx(5 / 8, abs=0.01)


def test_arrange_repeats_and_orders_rows(spark):
    df = rows.special(spark)
    out = mixing.arrange(df)
    assert out.columns == df.columns
    plan = mixing.assign(df).collect()
    assert out.count() == sum(r.copies for r in plan)
    docs = table(spark, 8)
    mixed = mixing.arrange(docs).collect()
    first = {r.doc_id: r.positions[0] for r in mixing.assign(docs).collect() if r.copies}
    seen = dict.fromkeys(r.doc_id for r in mixed)
    assert sorted(seen, key=first.get) == list(seen)
    assert [tuple(r) for r in mixing.arrange(docs).collect()] == [tuple(r) for r in mixed]


def test_special_rows(spark):
    df = rows.special(spark)
    got = mixing.assign(df)
    assert got.count() == df.count()
    assert all(r["size"] == 0 and r.copies == 0 for r in got.join(df.where("text is null").select("doc_id"), "doc_id").collect())
    assert mixing.assign(rows.empty(spark)).collect() == [] == mixing.arrange(rows.empty(spark)).collect()
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.assign(blank).collect()] == [(0.0, 0)] * 2


def test_running_total_is_split_by_digest_range(spark):
    docs = table(spark, 1)
    plan = mixing.assign(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(source_key#" in plan and "place#" in plan
