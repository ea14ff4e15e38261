"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the word classes of a clause: insults and threats put out their learned
weight, a target near them raises it, a negation before them takes most of it away, and reported
speech halves what follows. They are composed once into a single deterministic table, and every
clause is one walk through it. A document's score is a logistic function of the sum over its
clauses.

The insult lexicon is learned: word beginnings (and whole words) that stand, in ever different
surroundings, almost only in documents marked toxic. Distinct surroundings are counted, not
occurrences, so that copies of one toxic document do not make all of its words insults.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import fold

FOLDS, HELD_OUT = 4, 2
TRAIN_ROWS = 20_000  # bound of the labelled sample that the lexicon and the logistic are fitted on
STEMS = range(3, 9)  # lengths of word beginnings
SUPPORT, PRECISION = 8, 0.85  # least distinct toxic surroundings, and their share of all surroundings
SPECIAL = 0.95  # a longer stem replaces a shorter one if it keeps this share of its surroundings
THRESHOLD = 0.3

# The words of the closed classes.
NEGATIONS = "not no never neither nor without isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais ni nunca sin".split()
TARGETS = "you your yours he him his she her they them their these those du dich ihr sie tu toi vous il elle ils usted tus ellos".split()
REPORTS = "said says say wrote writes claimed claims called quoted reported according sagte schrieb laut dit écrit selon dijo según".split()
THREATS = "kill murder shoot stab strangle hurt beat destroy burn töten umbringen tuer frapper matar golpear".split()
THREAT_WEIGHT = 1.5

OTHER, NEGATION, TARGET, REPORT, INSULT, THREAT = range(6)
ENDS = ".!?;"
STRIP = " \t.,;:!?\"'()[]{}<>|*#$%&-_"


def negation() -> dict:
    """(state, class) -> (state, factor): three words after a negation lose most of their weight."""
    table = {}
    for left, kind in product(range(4), range(6)):
        table[left, kind] = (3 if kind == NEGATION else max(0, left - 1), 0.2 if left else 1.0)
    return table


def reported() -> dict:
    """After a verb of saying the rest of the clause counts half."""
    return {
        (inside, kind): (1 if kind == REPORT else inside, 0.5 if inside else 1.0)
        for inside, kind in product(range(2), range(6))
    }


def targeted() -> dict:
    """Within five words after a target, weights count half as much again."""
    table = {}
    for left, kind in product(range(6), range(6)):
        table[left, kind] = (5 if kind == TARGET else max(0, left - 1), 1.5 if left else 1.0)
    return table


def emitting() -> dict:
    """Insults and threats put out their weight, all other classes nothing."""
    return {(0, kind): (0, float(kind in (INSULT, THREAT))) for kind in range(6)}


def compose(first: dict, second: dict) -> dict:
    """Both read the same classes; states pair up and factors multiply."""
    table = {}
    for (a, kind), (to_a, x) in first.items():
        for (b, same), (to_b, y) in second.items():
            if kind == same:
                table[(a, b), kind] = ((to_a, to_b), x * y)
    return table


def grammar() -> tuple[tuple, dict]:
    """Start state and table of the composed transducer."""
    table = compose(compose(compose(emitting(), negation()), reported()), targeted())
    return (((0, 0), 0), 0), table


START, TABLE = grammar()


class Words(dict):
    """token -> (class, weight, ends the clause), worked out once per token."""

    def __init__(self, insults: dict[str, float], limit: int = 1_000_000):
        super().__init__()
        self.insults, self.limit = insults, limit
        self.closed = {w: (NEGATION, 0.0) for w in NEGATIONS}
        self.closed |= {w: (TARGET, 0.0) for w in TARGETS}
        self.closed |= {w: (REPORT, 0.0) for w in REPORTS}
        self.closed |= {w: (THREAT, THREAT_WEIGHT) for w in THREATS}

    def __missing__(self, token: str) -> tuple[int, float, bool]:
        if len(self) > self.limit:  # a cache: starting it again changes no result
            self.clear()
        word = token.strip(STRIP)
        found = self.closed.get(word, (OTHER, 0.0))
        weight = max((self.insults[s] for s in stems(word) if s in self.insults), default=0.0)
        if weight > found[1]:
            found = (INSULT, weight)
        self[token] = value = (*found, token[-1] in ENDS)
        return value


def stems(word: str) -> list[str]:
    """Beginnings of the word marked with a star, and the word itself."""
    return [word[:n] + "*" for n in STEMS if n <= len(word)] + [word]


def clause_scores(text: str, words: Words) -> Iterator[float]:
    """Weight of every clause that has an insult or a threat; clauses end at . ! ? ; and lines."""
    for line in text.lower().split("\n"):
        found = [words[token] for token in line.split()]
        if all(kind < INSULT for kind, _, _ in found):
            continue
        state, total = START, 0.0
        for kind, weight, ends in found:
            state, factor = TABLE[state, kind]
            total += factor * weight
            if ends:
                if total:
                    yield total
                state, total = START, 0.0
        if total:
            yield total


def raw_score(text: str | None, words: Words) -> float:
    return sum(clause_scores(text, words)) if text else 0.0


def logistic(raw: float, fit: tuple[float, float]) -> float:
    return 1 / (1 + math.exp(-(fit[0] + fit[1] * min(raw, 50.0))))


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, toxic, digest of both neighbours) of every word, each once per batch."""
    for batch in batches:
        found = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = [t.strip(STRIP) for t in (text or "").lower().split()]
            for i, word in enumerate(tokens):
                if len(word) >= STEMS[0]:
                    around = f"{tokens[i - 1] if i else ''} {tokens[i + 1] if i + 1 < len(tokens) else ''}"
                    found.add((word, toxic, xxhash.xxh3_64_intdigest(around) >> 1))
        rows = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))],
            names=["word", "toxic", "around"],
        )


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most TRAIN_ROWS labelled documents outside the held-out fold, in the order
    of a digest of their id. Labels of one id are put together: toxic if any says so."""
    sample = (
        labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.md5(F.col("label_id").cast("string").cast("binary")), "label_id")
        .limit(TRAIN_ROWS)
    )
    # at most TRAIN_ROWS rows of two numbers
    return docs.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("text", "toxic")


def learn_insults(train: DataFrame) -> dict[str, float]:
    """Stems with their log odds; a stem is left out if a shorter one serves."""
    words = (
        train.mapInArrow(_surroundings, "word string, toxic int, around long")
        .distinct()
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    lengths = F.array(*map(F.lit, STEMS))
    fitting = F.filter(lengths, lambda n: n <= F.length("word"))
    stem = F.concat(
        F.transform(fitting, lambda n: F.concat(F.col("word").substr(F.lit(1), n), F.lit("*"))), F.array("word")
    )
    found = (
        words.select(F.explode(stem).alias("stem"), "bad", "good")
        .groupBy("stem")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where((F.col("bad") >= SUPPORT) & (F.col("bad") >= PRECISION * (F.col("bad") + F.col("good"))))
        .collect()  # bounded by the sample
    )
    kept: dict[str, float] = {}
    covered: set[str] = set()
    support = {row.stem: row.bad for row in found}
    for row in sorted(found, key=lambda r: (len(r.stem), r.stem)):
        if any(s in covered for s in stems(row.stem.rstrip("*")) if s != row.stem):
            continue
        # the most special stem that still stands for nearly all of its surroundings
        begin = row.stem.rstrip("*")
        special = [s for s, n in support.items() if s.startswith(begin) and n >= SPECIAL * row.bad]
        best = max(special, key=lambda s: (len(s.rstrip("*")), not s.endswith("*"), s))
        kept[best] = max(kept.get(best, 0.0), math.log((row.bad + 0.5) / (row.good + 0.5)))
        covered.add(row.stem)
    return kept


def fit_logistic(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(raw, toxic, clean) counts -> intercept and slope, by Newton steps with a weak prior."""
    a, b = -2.0, 1.0
    for _ in range(50):
        ga, gb, haa, hab, hbb = -0.01 * a, -0.01 * (b - 1), 0.01, 0.0, 0.01
        for x, bad, good in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            n, w = bad + good, (bad + good) * p * (1 - p)
            ga, gb = ga + bad - n * p, gb + (bad - n * p) * x
            haa, hab, hbb = haa + w, hab + w * x, hbb + w * x * x
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, max(0.01, b + step * db)
        if max(abs(da), abs(db)) < 1e-9:
            break
    return a, b


def _scorer(insults: dict[str, float]):
    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(insults)
        for batch in batches:
            scores = [raw_score(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "raw"])

    return raw


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], tuple[float, float]]:
    """Lexicon and logistic from the bounded labelled sample. Without labelled rows nothing is an
    insult and every score is that of an empty text."""
    train = training_rows(docs, labels)
    insults = learn_insults(train)
    bins = (
        train.select(F.col("toxic").alias("key"), "text")
        .mapInArrow(_scorer(insults), "key int, raw double")
        .groupBy(F.least(F.round("raw", 1), F.lit(50.0)).alias("raw"))
        .agg(F.sum("key").alias("bad"), F.sum(1 - F.col("key")).alias("good"))
        .orderBy("raw")
        .collect()
    )
    return insults, fit_logistic([(r.raw, r.bad, r.good) for r in bins])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`; texts are not shuffled.

    Null and empty texts get the score of a text without any insult. Repeated rows get equal scores;
    a null id is in the fold of the empty text. Labels, language, source and id are not read for a score.
    """
    insults, line = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    raw = docs.select(F.col("doc_id").alias("key"), "text").mapInArrow(_scorer(insults), "key long, raw double")
    value = 1 / (1 + F.exp(-(F.lit(line[0]) + F.lit(line[1]) * F.least(F.col("raw"), F.lit(50.0)))))
    return raw.select(
        F.col("key").alias("doc_id"),
        (fold(F.col("key"), FOLDS) == HELD_OUT).alias("held_out"),
        value.alias("score"),
        (value >= THRESHOLD).cast("int").alias("predicted"),
        F.col("raw").alias("clause_weight"),
    )
