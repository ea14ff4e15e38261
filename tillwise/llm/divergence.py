"""Source divergence audit: how far the term frequencies of sources lie apart, by a quadtree of counts.

Terms are runs of characters `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`, with A-Z lower-cased. A lang keeps the V terms that
occur in at least `least_docs` of its documents. Every (lang, source) is a row of the lang's matrix of counts,
every kept term a column, frequent ones first. A cell's share is p = 1 + floor(10^9 (count + 2) / (N + 2 V)),
with N the sum over the row, and two shares differ by f = floor((p - q)^2 / (p + q)). All are integers below 2^63.

The matrix is cut into 8 x 8 quadrants, these again, down to blocks of 8 x 8 cells. A node of the tree is one 64-bit word that
says which of its quadrants hold a count; all-zero quadrants are not stored. Two rows of nodes are walked
jointly from the root: where both quadrants are all zero, all of their columns have the same difference, so
the pair is priced as width x f of the two shares of zero and not entered; where one holds
a count the walk goes on, and blocks are compared cell by cell. Pairs are those of blocks of 8
sources, so no list of term pairs exists, and each of the S^2 source pairs of the result is made once.

Special rows: null text, lang and source are read as ''. A source without terms is a row of zeros. With V = 0 all
values are 0. Repeated rows count as often as they come. An empty table gives no rows; other columns are
not looked at. Long texts are cut into terms where they are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.columns import UPPER, map_batches
from tillwise.llm.places import number
from tillwise.session import shared_dir

LEAST_DOCS = 10
TOP = 10
K = 8  # fixed value: 8 x 8 quadrants fill a word
SCALE = 1_000_000_000
HELD = 400_000  # terms a task counts before it hands them on

_LETTERS = (UPPER + UPPER.lower()).encode()
_AS_TERM = bytes(c | 32 if 65 <= c <= 90 else c if c in _LETTERS or c > 127 else 32 for c in range(256))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source all others of its lang by difference, and
    the `top` terms that it uses more than the lang does."""
    folder = shared_dir(docs.sparkSession, "divergence")
    cells, sources = matrix(docs, least_docs, folder)
    pairs = pair_values(cells, sources, folder)
    both = pairs.select("lang", "source", F.col("other").alias("item"), "value").unionByName(
        pairs.where("source <> other").select("lang", F.col("other").alias("source"), F.col("source").alias("item"), "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = [
        both.withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair")),
        term_values(cells).withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top).withColumn("part", F.lit("term")),
    ]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def share(count: Column, total: Column, terms: Column) -> Column:
    return F.when(terms > 0, 1 + _div(SCALE * (count + 2), total + 2 * terms))


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def matrix(docs: DataFrame, least_docs: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cells with a count (lang, source, term, col, r, p, q) and sources (lang, source, r, s, v, p0): number of the
    row, of rows, of columns, and the share of a zero."""
    spark = docs.sparkSession
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    texts = docs.select(*plain, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    found = map_batches(texts, _count, "lang string, source string, term string, n long, docs long")
    counts = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")

    of_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = number(of_lang.where(F.col("docs") >= least_docs), "lang", [F.desc("docs"), F.col("term")], f"{folder}/terms")
    kept = kept.select("lang", "term", "lang_n", F.col("place").alias("col"), F.col("members").alias("v"))
    counts.drop("docs").join(kept, ["lang", "term"]).write.parquet(f"{folder}/kept")
    cells = spark.read.parquet(f"{folder}/kept")

    rows = counts.where("term is null").select("lang", "source")
    rows = number(rows, "lang", [F.col("source")], f"{folder}/sources").select(
        "lang", "source", F.col("place").alias("r"), F.col("members").alias("s")
    )
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang_totals = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.max("v").alias("v"))
    zero = F.lit(0).cast("long")
    rows = rows.join(totals, ["lang", "source"], "left").join(lang_totals, "lang", "left")
    rows = rows.na.fill(0, ["total", "lang_total", "v"]).withColumn("p0", share(zero, F.col("total"), F.col("v")))
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    shares = cells.drop("v").join(rows, ["lang", "source"]).select(
        "lang", "source", "term", "col", "r",
        share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
    )
    shares.write.parquet(f"{folder}/cells")
    return spark.read.parquet(f"{folder}/cells"), rows.drop("total", "lang_total")


def term_values(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a source uses more than its lang."""
    return cells.where("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))


def pair_values(cells: DataFrame, sources: DataFrame, folder: str) -> DataFrame:
    """(lang, source, other, value) of every two sources of a lang, once."""
    spark = cells.sparkSession
    sides = sources.agg(F.max(F.greatest("s", "v"))).first()[0] or 0
    height = 1
    while K**height < sides:
        height += 1

    bands = sources.groupBy("lang", _div(F.col("r"), F.lit(K)).alias("band")).agg(
        F.array_sort(F.collect_list(F.struct("r", "source", "p0"))).alias("rows"), F.max("s").alias("s"), F.max("v").alias("v")
    )
    bands.write.parquet(f"{folder}/bands")
    bands = spark.read.parquet(f"{folder}/bands")
    last = _div(F.col("s") - 1, F.lit(K))
    band_pairs = bands.select("lang", F.col("band").alias("a"), F.col("rows").alias("a_rows"), F.explode(F.sequence("band", last)).alias("b")).join(
        bands.select("lang", F.col("band").alias("b"), F.col("rows").alias("b_rows")), ["lang", "b"]
    )

    # blocks of cells, then words over them
    inside = _mod(F.col("r")) * K + _mod(F.col("col"))
    blocks = cells.groupBy("lang", _div(F.col("r"), F.lit(K)).alias("i"), _div(F.col("col"), F.lit(K)).alias("j")).agg(
        F.collect_list(F.struct(inside.cast("int").alias("at"), "p")).alias("held")
    )
    blocks.write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    words = {1: blocks.select("lang", "i", "j")}
    for level in range(2, height + 1):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (_mod(F.col("i")) * K + _mod(F.col("j"))).cast("int"))
        words[level] = (
            words[level - 1].groupBy("lang", _div(F.col("i"), F.lit(K)).alias("i"), _div(F.col("j"), F.lit(K)).alias("j"))
            .agg(F.bit_or(bit).alias("word"))
        )
        words[level].write.parquet(f"{folder}/words-{level}")
        words[level] = spark.read.parquet(f"{folder}/words-{level}")

    # the joint walk; a and b are row quadrants, a <= b, j is their column quadrant
    extents = bands.groupBy("lang").agg(F.max("s").alias("s"), F.max("v").alias("v"))
    walk = words[height].join(extents, "lang").select("lang", "s", "v", F.col("i").alias("a"), F.col("i").alias("b"), "j")
    zeros = []
    for level in range(height, 1, -1):
        side = K ** (level - 1)  # rows and columns of a quadrant of this node
        at = words[level]
        opened = walk.join(
            at.select("lang", F.col("i").alias("a"), "j", F.col("word").alias("a_word")), ["lang", "a", "j"], "left"
        ).join(at.select("lang", F.col("i").alias("b"), "j", F.col("word").alias("b_word")), ["lang", "b", "j"], "left")
        rows, columns = _div(F.col("s") - 1, F.lit(side)), _div(F.col("v") - 1, F.lit(side))
        down = opened.select("*", F.explode(_below("a", rows)).alias("a1")).select("*", F.explode(_below("b", rows)).alias("b1"))
        down = down.where("a1 <= b1").select("*", F.explode(_below("j", columns)).alias("j1"))
        down = down.select(
            "lang", "s", "v", F.col("a1").alias("a"), F.col("b1").alias("b"), F.col("j1").alias("j"),
            (_bit("a_word", "a1") + _bit("b_word", "b1")).alias("held"),
        )
        down.write.parquet(f"{folder}/walk-{level}")
        down = spark.read.parquet(f"{folder}/walk-{level}")
        width = F.least(F.col("v"), (F.col("j") + 1) * side) - F.col("j") * side
        zeros.append(
            down.where("held = 0").groupBy("lang", "a", "b").agg(F.sum(width).alias("width"))
            .withColumn("side", F.lit(side // K).cast("long"))
        )
        walk = down.where("held > 0").drop("held")

    p0 = F.transform("rows", lambda r: r["p0"])
    held_rows = bands.select("lang", "band", p0.alias("p0"))
    joint = (
        walk.join(blocks.select("lang", F.col("i").alias("a"), "j", F.col("held").alias("a_held")), ["lang", "a", "j"], "left")
        .join(blocks.select("lang", F.col("i").alias("b"), "j", F.col("held").alias("b_held")), ["lang", "b", "j"], "left")
        .join(held_rows.select("lang", F.col("band").alias("a"), F.col("p0").alias("a_p0")), ["lang", "a"])
        .join(held_rows.select("lang", F.col("band").alias("b"), F.col("p0").alias("b_p0")), ["lang", "b"])
        .select(
            "lang", "a", "b", F.least(F.col("v") - F.col("j") * K, F.lit(K)).alias("width"), "a_p0", "b_p0",
            *(_or_empty(f"{x}_held.at", "array<int>", f"{x}_at") for x in "ab"),
            *(_or_empty(f"{x}_held.p", "array<long>", f"{x}_p") for x in "ab"),
        )
    )
    counted = map_batches(joint, _compare, "lang string, a long, b long, at int, value long")
    counted = counted.groupBy("lang", "a", "b", "at").agg(F.sum("value").alias("counted"))

    # columns priced at once, by pairs of bands
    free = band_pairs.select("lang", "a", "b")
    priced = []
    for zero in zeros:
        over = zero.withColumnsRenamed({"a": "a_up", "b": "b_up"})
        here = free.join(
            over, (free.lang == over.lang) & (_div(free.a, over.side) == over.a_up) & (_div(free.b, over.side) == over.b_up)
        )
        priced.append(here.select(free.lang, free.a, free.b, "width"))
    pairs = band_pairs
    if priced:
        widths = priced[0]
        for part in priced[1:]:
            widths = widths.unionByName(part)
        pairs = pairs.join(widths.groupBy("lang", "a", "b").agg(F.sum("width").alias("width")), ["lang", "a", "b"], "left")
    else:
        pairs = pairs.withColumn("width", F.lit(0).cast("long"))
    each = (
        pairs.select("lang", "a", "b", "width", F.posexplode("a_rows").alias("x", "row"), "b_rows")
        .select("lang", "a", "b", "width", "x", "row", F.posexplode("b_rows").alias("y", "other"))
        .where("row.r < other.r")
        .withColumn("at", F.col("x") * K + F.col("y"))
        .join(counted, ["lang", "a", "b", "at"], "left")
    )
    analytic = F.col("width") * difference(F.col("row.p0"), F.col("other.p0"))
    zero = F.lit(0).cast("long")
    return each.select(
        "lang", F.col("row.source").alias("source"), F.col("other.source").alias("other"),
        (F.coalesce(analytic, zero) + F.coalesce("counted", zero)).alias("value"),
    )


def _mod(number: Column) -> Column:
    return number % K


def _below(name: str, last: Column) -> Column:
    """Numbers of the quadrants below quadrant `name` that lie inside the matrix."""
    first = F.col(name) * K
    return F.sequence(first, F.least(first + K - 1, last))


def _bit(word: str, row: str) -> Column:
    """1 if the word of a node marks its quadrant at row `row` and column j1."""
    place = (_mod(F.col(row)) * K + _mod(F.col("j1"))).cast("int")
    return F.coalesce(F.getbit(F.col(word), place).cast("int"), F.lit(0))


def _or_empty(field: str, kind: str, name: str) -> Column:
    return F.coalesce(F.col(field), F.array().cast(kind)).alias(name)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms and of documents per lang, source and term, and a row without term per lang and source."""
    counts: dict = {}
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for key, text in zip(zip(langs, sources), batch.column(2)):
            terms = text.as_py().translate(_AS_TERM).split()
            seen = counts.get(key)
            if seen is None:
                seen = counts[key] = (Counter(), Counter())
            seen[0].update(terms)
            seen[1].update(set(terms))
            if len(terms) > HELD:
                yield from _handed_on(counts)
        if sum(len(n) for n, _ in counts.values()) > HELD:
            yield from _handed_on(counts)
    yield from _handed_on(counts)


def _handed_on(counts: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in counts.items():
        size = len(n) + 1
        terms = [None, *(term.decode("utf-8", "replace") for term in n)]
        values = [
            pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(terms, pa.string()),
            pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[term] for term in n)], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(values, names=["lang", "source", "term", "n", "docs"])
    counts.clear()


def _dense(batch: pa.RecordBatch, side: str) -> np.ndarray:
    """Shares of the 8 x 8 cells of each row's block; rows beyond the matrix have 1."""
    rows = batch.num_rows
    cells = np.ones((rows, K, K), dtype=np.int64)
    zero = batch.column(f"{side}_p0")
    lengths = np.diff(zero.offsets.to_numpy())
    row = np.repeat(np.arange(rows), lengths)
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    cells[row, within, :] = zero.flatten().to_numpy(zero_copy_only=False)[:, None]
    at, p = batch.column(f"{side}_at"), batch.column(f"{side}_p")
    row = np.repeat(np.arange(rows), np.diff(at.offsets.to_numpy()))
    cells.reshape(rows, K * K)[row, at.flatten().to_numpy(zero_copy_only=False)] = p.flatten().to_numpy(zero_copy_only=False)
    return cells


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of differences of every two rows of two blocks over their columns, added up by pairs of bands."""
    for batch in batches:
        p, q = _dense(batch, "a")[:, :, None, :], _dense(batch, "b")[:, None, :, :]
        inside = np.arange(K)[None, :] < batch.column("width").to_numpy()[:, None]
        f = (p - q) ** 2 // (p + q) * inside[:, None, None, :]
        sums = f.sum(axis=3).reshape(batch.num_rows, K * K)
        numbers: dict = {}
        keys = zip(batch.column("lang").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist())
        slot = np.array([numbers.setdefault(key, len(numbers)) for key in keys], dtype=np.int64)
        total = np.zeros((len(numbers), K * K), dtype=np.int64)
        np.add.at(total, slot, sums)
        values = [np.repeat(np.array(part), K * K) for part in zip(*numbers)]
        if not numbers:
            continue
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(values[0].tolist(), pa.string()), pa.array(values[1], pa.int64()), pa.array(values[2], pa.int64()),
                pa.array(np.tile(np.arange(K * K, dtype=np.int32), len(numbers))), pa.array(total.reshape(-1)),
            ],
            names=["lang", "a", "b", "at", "value"],
        )
