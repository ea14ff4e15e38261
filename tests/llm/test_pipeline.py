import math

import corpus_pipeline as cp
import pytest
import rows
import zstandard

from tillwise.llm import ngram_join, pieces, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, tmp_path, frame):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def corpus():
    """Sixty documents, some of them copies, near copies, junk, or with a shared passage."""
    import random

    rng = random.Random(11)
    texts, passage = [], "\n".join(rows.prose(rng, 30) for _ in range(2))
    for i in range(60):
        text = "\n".join(rows.prose(rng, 40) for _ in range(4))
        if i % 10 == 3:
            text = texts[0]
        elif i % 10 == 5:
            words = texts[i - 4].replace("\n", " ").split(" ")
            words[20] = "changed"
            text = " ".join(words)
        elif i % 10 == 7:
            text = text + "\n" + passage
        elif i % 10 == 9:
            text = "again and again " * 60
        texts.append(text)
    return [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]


def brute_stages(table):
    packer = zstandard.ZstdCompressor(level=3)
    kept = [r for r in table if quality.judge(r[0], (r[1] or "").encode(), packer)[7]]
    yield sorted(kept)
    seen, dedup = set(), []
    for d, t, *rest in sorted(kept):  # all lines here are long enough to be blocks
        left = [x for x in t.split("\n") if x not in seen]
        seen |= set(t.split("\n"))
        if left:
            dedup.append((d, "\n".join(left), *rest[:2], len("\n".join(left))))
    yield dedup
    sets, stay = [], []
    for row in dedup:
        words = row[1].lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    stay = [r for i, r in enumerate(dedup) if group[i] == i]
    yield stay


def test_first_stages_as_brute_force(spark, tmp_path):
    table = corpus()
    docs = spark.createDataFrame(table, COLUMNS)
    for (_, stage), want in zip(cp.STAGES, brute_stages(table)):
        assert 20 < len(want) < docs.count()
        docs = spark.createDataFrame([tuple(r) for r in stage(spark, docs, "").collect()], docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(map(tuple, docs.collect())) == sorted(want)


def test_run_mixes_and_encodes(spark, tmp_path):
    sf_dir = documents(spark, tmp_path, spark.createDataFrame(corpus(), COLUMNS))
    got = cp.run(spark, sf_dir).collect()
    *_, kept = brute_stages(corpus())
    library = __import__("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    ids = {r[0]: library.encode(r[1]) for r in kept}
    assert got and {r.doc_id for r in got} <= set(ids)
    assert all(list(r.ids) == ids[r.doc_id] and r.n_tokens == len(r.ids) for r in got)
    words = {s: sum(len(r[1].split()) for r in kept if r[3] == s) for s in ("s0", "s1", "s2")}
    size = {r[0]: len(r[1].split()) for r in kept}
    taken = {s: sum(size[r.doc_id] for r in got if r.source == s) for s in words}
    total = sum(words.values())
    want = {"s0": min(3 * words["s0"], total * 5 / 8)}
    rest = total - want["s0"]
    want |= {"s1": min(rest * 2 / 3, 3 * words["s1"])}
    want |= {"s2": min(3 * words["s2"], total - want["s0"] - want["s1"])}
    assert all(math.isclose(taken[s], want[s], abs_tol=320) for s in words)


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_stages_stand_special_rows(spark, name):
    stage = dict(cp.STAGES)[name]
    df = rows.special(spark)
    out = stage(spark, df, "")
    assert name == "sentencepiece" or out.columns == df.columns
    out.collect()
    assert stage(spark, rows.empty(spark), "").collect() == []


def test_one_of_each_group_keeps_different_texts_of_one_id(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words of it"), (2, "a b c d e f"), (None, "x")], "doc_id long, text string")
    got = cp.one_of_each_group(spark, df, "").collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 'a b c d e f')", "(1, 'other words of it')", "(None, 'x')"]
    assert ngram_join.link(df).count() == 5


def test_stages_keep_columns_with_any_name(spark):
    names = "stay_id stay_digest gone_id GONE_digest gone_kept gone_lines kept best found_host removed_lines node own_id row digest component"
    df = spark.createDataFrame(corpus()[:30], COLUMNS)
    for name in names.split():
        df = df.selectExpr("*", f"concat('{name}', doc_id) AS {name}")
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, df, "")
        assert out.columns == df.columns or sorted(out.columns) == sorted(df.columns), name
        assert all(r.stay_id == f"stay_id{r.doc_id}" and r.gone_lines == f"gone_lines{r.doc_id}" for r in out.collect())
