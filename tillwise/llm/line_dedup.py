"""Line deduplication by pairwise alignment of overlapping documents.

Documents that overlap are found through the hashes of their lines, and of every shortest run of
lines with `min_words` words. A rare hash (at most `RARE` different texts have it) makes a pair of
every two of them; a frequent one that is long enough to be deleted alone makes a pair of each later
text with the first that has it, so that a passage which a third of all documents share costs one
pair a document. Equal texts are one class and are aligned once; the copies lose all of their lines.

Each pair is aligned by patience diff on all lines with words: lines that occur once in both are
anchors, the longest increasing run of anchors is kept, equal lines next to an anchor are fitted to
it, and what lies between two anchors is aligned by itself. Aligned lines that follow each other in both are a
block; two blocks of two lines or more are one if a single line between them is changed, put in or left
out. Blocks of at least `min_words` words are deleted from the later document, and what is left of it is aligned again until nothing more is found, so that
moved blocks are found too; at last, runs that alignment has no anchor for (repeated in both
documents) are looked up. So every run of `min_words` words that any earlier document has too goes,
and so does a passage with single changed lines, but for these, from pairs that share a rare line or a long run.

A shorter line that a document shares with one it was aligned with is deleted as well if it stands between
deleted lines (or at an end of the text beside one): it is a remainder of the same passage.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import free_name
from tillwise.session import shared_dir

MIN_WORDS = 8  # of a block that is deleted
RARE = 8  # texts that share a hash of which every two are a pair; beyond it, each with the first
BETWEEN = 1  # other lines inside a block
CELL = 256  # pairs of one text that are aligned together; plans only
BATCH = 4 << 20  # bytes of an Arrow batch that leaves a task


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of (later, earlier) positions increasing in both; `pairs` sorted by the first."""
    tails, at, back = [], [], [-1] * len(pairs)
    for i, (_, earlier) in enumerate(pairs):
        k = bisect.bisect_left(tails, earlier)
        back[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(earlier)
            at.append(i)
        else:
            tails[k], at[k] = earlier, i
    run, i = [], at[-1] if at else -1
    while i >= 0:
        run.append(pairs[i])
        i = back[i]
    return run[::-1]


def _once(lines: list, low: int, high: int) -> dict:
    """Lines that occur once from `low` to `high`, with their places."""
    times = Counter(lines[low:high])
    return {x: i for i, x in enumerate(lines[low:high], low) if times[x] == 1}


def patience(later: list, earlier: list) -> list[tuple[int, int]]:
    """Aligned (later, earlier) positions, increasing in both."""
    out, todo = [], [(0, len(later), 0, len(earlier))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and later[a] == earlier[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and later[a_end - 1] == earlier[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        places = _once(earlier, b, b_end)
        anchors = increasing([(i, places[x]) for x, i in _once(later, a, a_end).items() if x in places])
        if not anchors:
            continue
        out += anchors
        for i, j in anchors:
            todo.append((a, i, b, j))
            a, b = i + 1, j + 1
        todo.append((a, a_end, b, b_end))
    return sorted(out)


def blocks(aligned: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Runs that go on by one line in both documents. Runs of two lines or more are one with the next such run
    if at most `BETWEEN` other lines are in between, in each document."""
    runs: list[list[tuple[int, int]]] = []
    for pair in aligned:
        if runs and pair[0] == runs[-1][-1][0] + 1 and pair[1] == runs[-1][-1][1] + 1:
            runs[-1].append(pair)
        else:
            runs.append([pair])
    block: list[tuple[int, int]] = []
    for run in runs:
        far = block and max(run[0][0] - block[-1][0], run[0][1] - block[-1][1]) > BETWEEN + 1
        if block and (far or len(run) == 1 or len(block) == 1):
            yield block
            block = []
        block = block + run
    if block:
        yield block


def least_runs(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """(first, last) line of the shortest runs of `min_words` words and two lines or more, from each
    line forwards and from each backwards."""
    runs: set[tuple[int, int]] = set()
    first, total = 0, 0
    for last, n in enumerate(words):  # the shortest that end at `last`
        total += n
        while first < last and total - words[first] >= min_words:
            total -= words[first]
            first += 1
        if total >= min_words and first < last:
            runs.add((first, last))
    last, total = len(words) - 1, 0
    for first in range(len(words) - 1, -1, -1):  # the shortest that begin at `first`
        total += words[first]
        while last > first and total - words[last] >= min_words:
            total -= words[last]
            last -= 1
        if total >= min_words and first < last:
            runs.add((first, last))
    return runs


class Lines:
    """The lines with words of one text: their hashes, and their words counted up to `min_words`."""

    def __init__(self, hashes: bytes, words: bytes, min_words: int):
        self.hashes, self.min_words = hashes, min_words
        self.all = np.frombuffer(hashes, np.int64).tolist()
        self.words = np.frombuffer(words, np.int32).tolist()
        self._places, self._runs = None, None

    @property
    def places(self) -> dict[int, list[int]]:
        if self._places is None:
            self._places = {}
            for i, x in enumerate(self.all):
                self._places.setdefault(x, []).append(i)
        return self._places

    @property
    def runs(self) -> dict[tuple[int, int], bytes]:
        """What can be deleted alone: long lines and the shortest runs, with their hashes."""
        if self._runs is None:
            spans = least_runs(self.words, self.min_words) if self.min_words > 1 else set()
            spans.update((i, i) for i, n in enumerate(self.words) if n >= self.min_words)
            self._runs = {(i, j): self.hashes[8 * i : 8 * (j + 1)] for i, j in spans}
        return self._runs

    @property
    def run_set(self) -> set[bytes]:
        if not hasattr(self, "_run_set"):
            self._run_set = set(self.runs.values())
        return self._run_set


def shared_lines(later: Lines, earlier: Lines) -> tuple[set[int], set[int]]:
    """Numbers of the later text's lines that are deleted, and of all that the earlier one has as well."""
    small, large = sorted((later, earlier), key=lambda x: len(x.all))
    common = small.places.keys() & large.places.keys()
    at_later = sorted(i for x in common for i in later.places[x])
    at_earlier = sorted(i for x in common for i in earlier.places[x])
    shared, gone = set(at_later), set()
    ends = [earlier.all[i] for i in at_earlier]
    while sum(later.words[i] for i in at_later) >= later.min_words:
        aligned = patience([later.all[i] for i in at_later], ends)
        found = {
            i
            for run in blocks([(at_later[i], at_earlier[j]) for i, j in aligned])
            if sum(later.words[i] for i, _ in run) >= later.min_words
            for i, _ in run
        }
        if not found:
            runs = earlier.run_set
            for (first, last), key in later.runs.items():
                if key in runs:
                    gone.update(range(first, last + 1))
            break
        gone |= found
        at_later = [i for i in at_later if i not in found]
    return gone, shared


def removed(gone: set[int], shared: set[int], places: list[int], n_lines: int) -> set[int]:
    """Places in the text that are deleted: `gone`, and shared or blank lines between them."""
    out = {places[i] for i in gone}
    with_words = set(places)
    loose = {places[i] for i in shared - gone}
    at = 0
    while at < n_lines:
        end = at
        while end < n_lines and (end in loose or end not in with_words):
            end += 1
        if end > at and (at == 0 or at - 1 in out) and (end == n_lines or end in out):
            out.update(range(at, end))
        at = max(end, at + 1)
    return out


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _batches(rows: Iterator[tuple], types: dict[str, pa.DataType], size=lambda row: 64) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about `BATCH` bytes."""

    def batch(part: list) -> pa.RecordBatch:
        columns = zip(*part, strict=True) if part else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))

    part, held = [], 0
    for row in rows:
        part.append(row)
        held += size(row)
        if held >= BATCH:
            yield batch(part)
            part, held = [], 0
    yield batch(part)


LONG, INT, BYTES = pa.int64(), pa.int32(), pa.binary()
TEXTS = {"row": LONG, "doc_id": LONG, "digest": BYTES, "n": INT, "n_words": INT, "n_lines": INT, "hashes": BYTES,
         "words": BYTES, "places": BYTES}
TEXTS_SQL = ("row long, doc_id long, digest binary, n int, n_words int, n_lines int, hashes binary, words binary, "
             "places binary")
KEYS = {"hash": LONG, "row": LONG, "doc_id": LONG, "n": INT, "strong": pa.bool_()}


def _texts(min_words: int):
    """(doc_id, digest, text) -> the lines with words: hashes, words up to `min_words`, places in the text.

    `row` is a number of the row, `n` that of the lines, `n_words` that of all words up to `min_words`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        row = TaskContext.get().partitionId() << 36
        for doc_id, digest, text in _rows(batches, "doc_id", "digest", "text"):
            lines = text.split(b"\n")
            words = [len(x.split(None, min_words)[:min_words]) for x in lines]
            places = np.flatnonzero(words).astype(np.int32)
            hashes = np.array([xxhash.xxh3_64_intdigest(lines[i]) for i in places], np.uint64)
            words = np.array(words, np.int32)[places]
            n_words = min(min_words, int(words.sum()))
            yield (row, doc_id, digest, len(places), n_words, len(lines), hashes.tobytes(), words.tobytes(), places.tobytes())
            row += 1

    return lambda batches: _batches(rows(batches), TEXTS, lambda r: 100 + 16 * r[3])


def _keys(min_words: int):
    """Texts -> the hashes they are found by, once each; `strong` if what it stands for can be deleted alone."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row, doc_id, n, hashes, words in _rows(batches, "row", "doc_id", "n", "hashes", "words"):
            lines = Lines(hashes, words, min_words)
            # a run has a seed of its own, so that it is no line's hash
            found = {xxhash.xxh3_64_intdigest(x, 1) - (1 << 63): True for (i, j), x in lines.runs.items() if i < j}
            for x, w in zip(lines.all, lines.words, strict=True):
                found[x] = w >= min_words
            for x, strong in found.items():
                yield x, row, doc_id, n, strong

    return lambda batches: _batches(rows(batches), KEYS)


def _compared(min_words: int):
    """Cells sorted with their hub first -> (row of the later text, number of a line, whether it goes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hub = None
        for guest, row, hub_is_later, hashes, words, hub_row in _rows(
            batches, "guest", "row", "hub_is_later", "hashes", "words", "hub"
        ):
            lines = Lines(hashes, words, min_words)
            if guest == 0:
                hub = lines
                continue
            later, earlier = (hub, lines) if hub_is_later else (lines, hub)
            gone, shared = shared_lines(later, earlier)
            for i in shared:
                if i in gone or later.words[i] < min_words:
                    yield (hub_row if hub_is_later else row), i, i in gone

    return lambda batches: _batches(rows(batches), {"later": LONG, "line": INT, "goes": pa.bool_()}, lambda r: 16)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        names = ("doc_id", "digest", "n_lines", "places", "gone", "shared")
        for doc_id, digest, n_lines, places, gone, shared in _rows(batches, *names):
            out = removed(set(gone), set(shared), np.frombuffer(places, np.int32).tolist(), n_lines)
            yield doc_id, digest, [i not in out for i in range(max(out) + 1)], len(out)

    types = {"doc_id": LONG, "digest": BYTES, "kept": pa.list_(pa.bool_()), "removed_lines": INT}
    return _batches(rows(), types, lambda r: 100 + len(r[2]))


SCHEMA = "doc_id long, digest binary, kept array<boolean>, removed_lines int"


def _digest(text: Column) -> Column:
    """128 bits of SHA-256: the identity of a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def pairs(keys: DataFrame, rare: int = RARE) -> DataFrame:
    """(later, earlier, n_later, n_earlier): different texts to align, each two once; `later` and `earlier` are rows."""
    spark, folder = keys.sparkSession, shared_dir(keys.sparkSession, "line-hashes")
    text = F.struct("doc_id", "row", "n")
    # a table of its own, so that Spark can split the rows of a frequent line in the join
    keys.groupBy("hash").agg(
        F.count("*").alias("texts"), F.min(text).alias("first"), F.max("doc_id").alias("last"),
        F.bool_or("strong").alias("long"),
    ).where((F.col("first.doc_id") < F.col("last")) & (F.col("long") | (F.col("texts") <= rare))).select(
        "hash", "texts", "first"
    ).write.parquet(folder)
    found = keys.join(spark.read.parquet(folder), "hash")
    frequent = found.where((F.col("texts") > rare) & (F.col("doc_id") > F.col("first.doc_id"))).select(
        text.alias("a"), F.col("first").alias("b")
    )
    few = found.where(F.col("texts") <= rare).groupBy("hash").agg(F.collect_list(text).alias("all"))  # `rare` at most
    every = few.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b")).where(
        "b.doc_id < a.doc_id"
    )
    return every.unionByName(frequent).select(
        F.col("a.row").alias("later"), F.col("b.row").alias("earlier"), F.col("a.n").alias("n_later"),
        F.col("b.n").alias("n_earlier"),
    ).distinct()


def plan(docs: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """(doc_id, digest, kept, removed_lines) of documents that lose lines; `digest` is of their text."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "lines")

    def table(name: str, frame: DataFrame) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = table(
        "rows",
        docs.where("doc_id is not null and text is not null")
        .select("doc_id", _digest(F.col("text")).alias("digest"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(_texts(min_words), TEXTS_SQL),
    )
    classes = table("classes", rows.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.max("doc_id").alias("last")))
    firsts = classes.select(F.col("first.row").alias("row"))
    texts = table("texts", rows.join(firsts, "row", "left_semi"))
    keys = table("keys", texts.mapInArrow(_keys(min_words), "hash long, row long, doc_id long, n int, strong boolean"))

    # the text with more lines is the hub: it is sent once for `CELL` guests, a guest once for a pair
    hub_is_later = F.col("n_later") > F.col("n_earlier")
    met = table(
        "pairs",
        pairs(keys, rare).select(
            F.when(hub_is_later, F.col("later")).otherwise(F.col("earlier")).alias("hub"),
            F.when(hub_is_later, F.col("earlier")).otherwise(F.col("later")).alias("row"),
            hub_is_later.alias("hub_is_later"),
        ),
    )
    hubs = table("hubs", met.groupBy("hub").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells")))
    lines = texts.select("row", "hashes", "words")
    guests = (
        met.join(hubs, "hub")
        .withColumn("cell", F.pmod(F.xxhash64("row"), F.col("cells")).cast("int"))
        .join(lines, "row")
        .select("hub", "cell", F.lit(1).alias("guest"), "row", "hub_is_later", "hashes", "words")
    )
    hosts = hubs.join(lines.withColumnRenamed("row", "hub"), "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.lit(0).alias("guest"),
        F.col("hub").alias("row"), F.lit(False).alias("hub_is_later"), "hashes", "words",
    )
    found = (
        hosts.unionByName(guests)
        .repartition("hub", "cell")
        .sortWithinPartitions("hub", "cell", "guest")
        .mapInArrow(_compared(min_words), "later long, line int, goes boolean")
    )
    lost = (
        found.groupBy("later", "line").agg(F.bool_or("goes").alias("goes"))
        .groupBy(F.col("later").alias("row"))
        .agg(F.collect_list(F.when(F.col("goes"), F.col("line"))).alias("gone"),
             F.collect_list(F.when(~F.col("goes"), F.col("line"))).alias("shared"))
        .where(F.size("gone") > 0)
    )
    # rows that repeat a row of the least doc_id lose what it loses
    first = (
        texts.select("row", "doc_id", "digest", "n_lines", "places").join(lost, "row").mapInArrow(_finished, SCHEMA)
    )
    copies = (
        rows.select("doc_id", "digest", "n_words", "n_lines")
        .join(classes.where("first.doc_id < last").select("digest", F.col("first.doc_id").alias("kept_id")), "digest")
        .where((F.col("doc_id") > F.col("kept_id")) & (F.col("n_words") >= min_words))
        .select("doc_id", "digest", F.array_repeat(F.lit(False), F.col("n_lines")).alias("kept"), F.col("n_lines").alias("removed_lines"))
        .dropDuplicates(["doc_id", "digest"])
    )
    return first.unionByName(copies)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of `docs` with shared blocks deleted from `text`, and `removed_lines` (0 if none).

    Only documents with a lower doc_id count as earlier. Null texts and rows with a null doc_id
    stay as they are and take nothing from others. Rows that share a doc_id are not compared with each
    other; each loses what its own text shares with earlier documents. A copy of an earlier document loses
    all of its lines if they have `min_words` words. Blank lines are not compared; those between deleted
    lines go with them. A column `removed_lines` in `docs` is replaced; other extra columns are kept. An empty table stays empty.
    """
    own = docs.drop("removed_lines")
    names = {name: free_name(own, name) for name in ("gone_id", "gone_digest", "gone_kept", "gone_lines")}
    doc_id, digest, kept, lines = (F.col(name) for name in names.values())
    gone = plan(docs, min_words).toDF(*names.values())
    here = (F.col("doc_id") == doc_id) & (_digest(F.col("text")) == digest)
    rest = F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: F.coalesce(F.get(kept, i), F.lit(True))), "\n")
    return own.join(gone, here, "left").select(
        *(F.when(kept.isNull(), F.col("text")).otherwise(rest).alias("text") if c == "text" else F.col(f"`{c}`")
          for c in own.columns),
        F.coalesce(lines, F.lit(0)).alias("removed_lines"),
    )
