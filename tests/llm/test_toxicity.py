import random

import pytest
import rows

from tillwise.llm import toxicity as tx

WORDS = {"rotter": 3.0, "vile*": 2.0}


def total(text):
    return tx.raw_score(text, tx.Words(WORDS))


def test_grammar_over_clauses():
    plain = total("what a rotter")
    assert plain == 3.0 and total("a fine day") == 0 == total("") == total(None)
    assert total("you are a rotter") == 4.5  # target
    assert total("he is not a rotter") < plain  # negation
    assert total("rotter, they said rotter") < 2 * 4.5 and total("she said what rotter") < total("she sang what rotter")
    assert total("not today. A rotter") == plain  # clauses end
    assert total("VILEST!!") == 2.0 and total("vile*** vile&&&") == 4.0
    assert total("I will kill it") == tx.THREAT_WEIGHT


def test_composition_multiplies_factors():
    table = tx.compose(tx.negation(), tx.reported())
    (state, _), factor = table[((2, 1), tx.INSULT)], table[((2, 1), tx.INSULT)][1]
    assert state == (1, 1) and factor == pytest.approx(0.2 * 0.5)
    assert len(tx.TABLE) == 4 * 2 * 6 * 6


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.randrange(400)}" for _ in range(60)]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(60), rng.choice(["rotter", "vilest", "vilely", "vileness"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_learns_stems_and_scores_held_out_rows(spark):
    docs, labels, truth = corpus(spark)
    insults, _ = tx.fit(docs, labels)
    assert any(s.startswith("rotter") for s in insults) and any(s.startswith("vile") for s in insults)
    got = tx.score(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 400 and held
    assert all(r.predicted == truth[r.doc_id] == int(r.score >= 0.3) for r in held)


def test_copies_of_one_document_teach_no_words(spark):
    docs, labels, _ = corpus(spark)
    copy = " ".join(f"onlyhere{i}" for i in range(30))
    more = spark.createDataFrame([(1000 + i, copy) for i in range(100)], "doc_id long, text string")
    marks = spark.createDataFrame([(1000 + i, 1) for i in range(100)], "doc_id long, toxic int")
    insults, _ = tx.fit(docs.union(more), labels.union(marks))
    assert not any("onlyhere1" == s.rstrip("*") for s in insults)


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = corpus(spark)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    assert sorted(map(tuple, tx.score(docs, labels).collect())) == sorted(map(tuple, tx.score(docs, flipped).collect()))


def test_special_rows(spark):
    df = rows.special(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (5, 0), (5, 1)], "doc_id long, toxic int")
    got = tx.score(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    none = tx.score(df, labels.where("doc_id < 0")).collect()
    assert len({r.score for r in none}) == 1
    assert tx.score(rows.empty(spark), labels).collect() == []
