"""Small tables with everything that an operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, removed_lines string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}x" for _ in range(n))


def special_texts(seed=3):
    rng = random.Random(seed)
    base = words(rng, 120)
    lines = "\n".join(words(rng, 12) for _ in range(8))
    near = base.split()
    near[60] = "changed"
    return [
        None, "", "   \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), lines,
        "head line of its own here\n" + lines + "\ntail", words(rng, 9000), "äöü 漢字 " * 30,
        "same same same " * 40, base + " " + words(rng, 2), words(rng, 60),
    ]


def special(spark, seed=3, extra=True):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    texts = special_texts(seed)
    rows = [
        (None if i == 3 else i, t, None if i % 3 else "en", None if i % 5 == 0 else f"s{i % 3}",
         None if t is None else len(t), "x", None)
        for i, t in enumerate(texts)
    ]
    rows += [rows[5], rows[9], rows[9], (5, "another text for the same id", "en", "s1", 28, "y", "z"), (None,) * 7]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng, n):
    """Words of syllables, which compress as natural text does."""
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(n))
