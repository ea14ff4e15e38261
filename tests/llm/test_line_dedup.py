import random

import rows

from tillwise.llm import line_dedup as ld


def line(rng, n=10):
    return " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))


def run(spark, texts, **kw):
    got = ld.dedup(spark.createDataFrame(texts, "doc_id long, text string"), **kw).collect()
    return {r.doc_id: (r.text, r.removed_lines) for r in got}


def test_later_document_loses_the_passage(spark):
    rng = random.Random(1)
    passage = [line(rng), "short one", "", line(rng)]
    a = "\n".join([line(rng), *passage, line(rng)])
    own = [line(rng), line(rng)]
    b = "\n".join([own[0], *passage, own[1]])
    got = run(spark, [(7, b), (2, a), (9, "nothing shared in this text")])
    assert got[2] == (a, 0) and got[9][1] == 0
    assert got[7] == ("\n".join(own), 4)


def test_copies_moved_blocks_and_repeated_lines(spark):
    rng = random.Random(2)
    x, y, z = line(rng), line(rng), line(rng)
    texts = [(1, f"{x}\n{y}\n{z}"), (2, f"{x}\n{y}\n{z}"), (3, f"{z}\n{x}"), (4, f"{x}\n{x}\nown words of the last text are kept\n{x}")]
    got = run(spark, texts)
    assert got[1][1] == 0 and got[2] == ("", 3) and got[3] == ("", 2)
    assert got[4] == ("own words of the last text are kept", 3)


def test_short_shared_lines_stay_unless_enclosed(spark):
    rng = random.Random(3)
    texts = [(1, "yes it is\n" + line(rng)), (2, "yes it is\n" + line(rng))]
    assert run(spark, texts)[2][1] == 0
    x, y = line(rng), line(rng)
    texts = [(1, "ok"), (2, x), (3, y), (4, f"{x}\nok\n\n{y}\nown text"), (5, f"{x}\nno\n{y}")]
    got = run(spark, texts)
    assert got[4] == ("own text", 4) and got[5] == ("no", 2)


def test_as_membership_on_long_lines(spark):
    """With lines that are long enough alone, exactly those that an earlier document has are deleted."""
    rng = random.Random(4)
    pool = [line(rng) for _ in range(60)]
    texts = [(i, "\n".join(rng.choices(pool, k=rng.randrange(0, 12)))) for i in range(80)]
    got, seen = run(spark, texts), set()
    for i, text in texts:
        want = [x for x in text.split("\n") if x not in seen or not x]
        assert got[i][0].split("\n") == (want or [""]), i
        seen |= set(text.split("\n"))


def brute(texts, min_words=8):
    """Positions of lines with words in runs that any earlier document has too, of `min_words` words or more."""
    gone = {}
    for i, text in texts:
        lines, gone[i] = text.split("\n"), set()
        for first in range(len(lines)):
            for last in range(first, len(lines)):
                run_ = lines[first : last + 1]
                if sum(len(x.split()) for x in run_) < min_words or not run_[0] or not run_[-1]:
                    continue
                n = len(run_)
                if any(run_ == y.split("\n")[k : k + n] for j, y in texts if j < i for k in range(y.count("\n") + 2 - n)):
                    gone[i] |= set(range(first, last + 1))
    return gone


def test_passage_of_short_lines_that_have_earlier_owners(spark):
    rng = random.Random(6)
    passage = [line(rng, 5) for _ in range(12)]
    a = "\n".join(x for p in passage[::2] for x in (p, line(rng, 4)))
    b, c = "\n".join([line(rng, 4), *passage, line(rng, 4)]), "\n".join([line(rng, 3), *passage, line(rng, 3)])
    got = run(spark, [(1, a), (2, b), (3, c)])
    assert got[1][1] == got[2][1] == 0 and got[3][1] == 12
    x, y, z = line(rng, 5), line(rng, 5), line(rng, 5)  # the owner repeats a line; its second place counts
    got = run(spark, [(1, f"{x}\n{z}\n{x}\n{y}"), (2, f"{x}\n{y}")])
    assert got[2] == ("", 2)


def test_all_runs_of_any_earlier_document(spark):
    rng = random.Random(7)
    pool = [line(rng, n) for n in (1, 2, 3, 3, 4, 5, 5, 6, 7, 9)] + [""]
    texts = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(60)]
    got, lost = run(spark, texts), brute(texts)
    assert sum(map(len, lost.values())) > 60
    for i, text in texts:
        lines = text.split("\n")
        kept = [x for k, x in enumerate(lines) if k not in lost[i]]
        rest = got[i][0].split("\n") if got[i][1] < len(lines) else []
        at = iter(kept)
        assert all(x in at for x in rest), i  # nothing of a shared run is left
        seen = {x for j, y in texts if j < i for x in y.split("\n")}
        assert [x for x in kept if x and x not in seen] == [x for x in rest if x and x not in seen], i


def test_passage_with_changed_lines_needs_the_alignment(spark):
    """Runs of six words each, which no lookup of eight-word runs finds, are one block in order only."""
    rng = random.Random(8)
    parts = [[line(rng, 3), line(rng, 3)] for _ in range(4)]
    a = [x for p in parts for x in (*p, line(rng, 3))]
    b = [x for p in parts for x in (*p, line(rng, 3))]
    moved = [x for p in parts[::-1] for x in (*p, line(rng, 3))]
    got = run(spark, [(1, "\n".join(a)), (2, "\n".join(b)), (3, "\n".join(moved))])
    assert got[2] == ("\n".join(b[2::3]), 8) and got[3] == ("\n".join(moved), 0)


def test_alignment_is_in_order_and_fits_equal_neighbours():
    rng = random.Random(9)
    for _ in range(300):
        a, b = (rng.choices(range(8), k=rng.randrange(0, 12)) for _ in range(2))
        got = ld.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert ld.patience(a, a) == [(i, i) for i in range(len(a))]
        assert len(got) >= len({*a[:1]} & {*b[:1]})


def test_same_for_any_bound_of_rare_lines(spark):
    """Pairs with first owners find all long runs that pairs of all texts find; cells of one pair, too."""
    rng = random.Random(10)
    pool = [line(rng, n) for n in (4, 5, 5, 6, 9, 12)]
    texts = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 7)))) for i in range(40)]
    frame, lost = spark.createDataFrame(texts, "doc_id long, text string"), brute(texts)
    for rare in (1, 100):
        gone = {r.doc_id: {k for k, kept in enumerate(r.kept) if not kept} for r in ld.plan(frame, rare=rare).collect()}
        assert all(lost[i] <= gone.get(i, set()) for i, _ in texts)


def test_copies_and_near_copies_of_a_large_group(spark):
    rng = random.Random(11)
    base = [line(rng) for _ in range(6)]
    texts = [(i, "\n".join(base if i % 3 else [*base[:3], line(rng), *base[3:]])) for i in range(1, 700)]
    got = run(spark, texts)
    assert got[1] == (texts[0][1], 0)
    for i, text in texts[1:]:
        assert got[i] == (("", 6) if i % 3 else (text.split("\n")[3], 6)), i


def test_special_rows(spark):
    df = rows.special(spark)
    got = ld.dedup(df)
    assert got.columns == [c for c in df.columns if c != "removed_lines"] + ["removed_lines"]
    found = got.collect()
    assert len(found) == df.count()
    assert all(r.removed_lines == 0 for r in found if r.doc_id is None or r.text is None)
    assert [r.removed_lines for r in found if r.doc_id == 10] == [8]
    assert all(r.text == "" for r in found if r.doc_id == 6)  # a copy of document 5
    assert ld.dedup(rows.empty(spark)).collect() == []


def test_longest_increasing_run():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(0, 9)
        pairs = list(enumerate(rng.sample(range(20), n)))
        got = ld.increasing(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        best = 0
        for mask in range(1 << n):
            run_ = [pairs[i] for i in range(n) if mask >> i & 1]
            if all(a[1] < b[1] for a, b in zip(run_, run_[1:])):
                best = max(best, len(run_))
        assert len(got) == best
