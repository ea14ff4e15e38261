"""SentencePiece encoding and decoding by a max-plus parallel scan.

The model file holds merge-ordered pieces. A sequence of pieces is the encoding of a text exactly if
every piece next to its neighbour is stable: merging the characters of the two together, best piece
first, gives back these two. So the encoding is the only path through the lattice of pieces whose
transitions all weigh more than minus infinity; the weights are the piece scores.

In the (max, +) semiring a chunk of text is a matrix from the states at its start to those at its end,
a state being the piece that covers or ends at the boundary. Matrices multiply associatively, so a
giant document is cut anywhere into chunks, the chunks' matrices are worked out in different tasks and
multiplied block by block of chunks; the best path through the blocks' products gives every block
its entry and exit state, that through a block's matrices those of its chunks, and each chunk is
then traced back alone.

No piece runs from a non-blank into a blank, so every path goes through the points before blanks, and
what follows does not depend on what came before. Between such points a text is a series of units, merged
once per worker and looked up afterwards; they also make a matrix cheap: only the parts before
the first and after the last such point depend on the boundary states.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import shared_dir

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CHUNK = 32_768  # characters; longer texts are giants
BLOCK = 256  # chunks of a giant whose matrices are multiplied in one task
NEVER = float("-inf")
CACHE = 300_000  # units, and neighbours, remembered per worker
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"
MERGED = 48  # characters; longer units are walked through the lattice, in linear time


class Vocabulary:
    """Pieces, scores and byte tokens of a model file; plain data, so tasks get it as it is."""

    def __init__(self, pieces: dict[str, tuple[int, float]], spelled: list[bytes], bytes_: list[int]):
        self.pieces, self.spelled, self.bytes = pieces, spelled, bytes_
        self.scores = {piece: score for piece, (_, score) in pieces.items()}
        self.longest = max(map(len, pieces))
        self.stable_pairs: dict[tuple[str, str], bool] = {}
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece runs from a non-blank into a blank")
        self.ends = {p[-n:] for p in pieces for n in range(1, len(p) + 1)}
        alone = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in pieces))
        # signs that no piece has directly after a Latin letter: a word of such letters ends before them
        joined = {b for p in pieces for a, b in pairwise(p) if re.match(LETTER, a)}
        signs = "".join(re.escape(c) for c in string.punctuation if c in pieces and c not in joined)
        self.units = re.compile(
            (f"{BLANK}*{LETTER}++(?=[{signs}])|" if signs else "")
            + f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+"
            + (f"|[{alone}]" if alone else "")
        )

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, spelled, bytes_ = {}, [], [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                pieces[piece] = (i, model.get_score(i))
                spelled.append(piece.replace(BLANK, " ").encode())
        return cls(pieces, spelled, bytes_)

    def merged(self, text: str) -> list[str]:
        """Characters merged pair by pair, the best-scored piece first, the leftmost among equals."""
        parts, score = list(text), self.scores.get
        weights = [score(a + b, NEVER) for a, b in pairwise(parts)]
        while weights:
            best = max(weights)
            if best == NEVER:
                break
            at = weights.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del weights[at]  # only the neighbours of the new part weigh anything else now
            if at < len(weights):
                weights[at] = score(parts[at] + parts[at + 1], NEVER)
            if at:
                weights[at - 1] = score(parts[at - 1] + parts[at], NEVER)
        return parts

    def stable(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are next to each other; an empty `left` asks for one piece."""
        key = (left, right)
        known = self.stable_pairs.get(key)
        if known is None:
            if len(self.stable_pairs) > CACHE:  # a cache: starting it again changes no result
                self.stable_pairs.clear()
            known = self.stable_pairs[key] = self.merged(left + right) == [p for p in key if p]
        return known

    def walk(self, text: str, start: int, end: int, piece: str = "") -> list[int]:
        """For every position up to `end` the start of the last piece of the encoding that goes from
        `start`, where `piece` has ended, to there; -1 if there is none."""
        before, last = [-1] * (end + 1), [""] * (end + 1)
        last[start], reached = piece, [False] * (end + 1)
        reached[start] = True
        for stop in range(start + 1, end + 1):
            for begin in range(stop - 1, max(start, stop - self.longest) - 1, -1):
                part = text[begin:stop]
                if part not in self.ends and stop - begin > 1:
                    break
                if reached[begin] and (stop - begin == 1 or part in self.pieces) and self.stable(last[begin], part):
                    before[stop], last[stop], reached[stop] = begin, part, True
                    break
        return before

    def ids_of(self, part: str) -> list[int]:
        """Id of a piece; a character that is none is spelled in bytes."""
        found = self.pieces.get(part)
        return [found[0]] if found else [self.bytes[b] for b in part.encode()]

    def weight(self, part: str) -> float:
        found = self.pieces.get(part)
        return found[1] if found else 0.0


def trace(text: str, before: list[int], start: int, end: int) -> list[str]:
    """Pieces of the walked path from `start` to `end`."""
    parts: list[str] = []
    while end > start:
        parts.append(text[before[end] : end])
        end = before[end]
    return parts[::-1]


def packed(parts: list[str], vocabulary: Vocabulary) -> bytes:
    return array("i", [i for part in parts for i in vocabulary.ids_of(part)]).tobytes()


class Units(dict):
    """unit -> ids as 32-bit numbers, worked out once."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> bytes:
        if len(self) > CACHE:  # a cache: starting it again changes no result
            self.clear()
        v = self.vocabulary
        parts = v.merged(unit) if len(unit) <= MERGED else trace(unit, v.walk(unit, 0, len(unit)), 0, len(unit))
        self[unit] = value = packed(parts, v)
        return value

    def ids(self, text: str) -> bytes:
        return b"".join([self[unit] for unit in self.vocabulary.units.findall(text)])


_WORKER: dict[str, Units] = {}


def units_of(path: str, vocabulary) -> Units:
    """The units that this Python worker knows of a vocabulary; later tasks go on with them."""
    if path not in _WORKER:
        _WORKER[path] = Units(vocabulary.value)
    return _WORKER[path]


def written(text: str) -> str:
    """The text as the lattice sees it: a blank in front, blanks as the blank sign; empty stays empty."""
    return (BLANK + text.replace(" ", BLANK)) if text else ""


def cuts(text: str, low: int, high: int) -> tuple[int, int]:
    """First and last point from `low` to before `high` that every path goes through; high + 1 and -1 if none."""
    found = [m.start() for m in re.compile(f"(?<!{BLANK}){BLANK}").finditer(text, max(low, 1), high)]
    return (found[0], found[-1]) if found else (high + 1, -1)


def states(text: str, at: int, longest: int, known) -> list[tuple[int, int]]:
    """Places of the pieces that begin before `at` and end there or later, relative to it."""
    return [
        (begin - at, end - at)
        for begin in range(max(0, at - longest), at)
        for end in range(at, min(begin + longest, len(text)) + 1)
        if end - begin == 1 or text[begin:end] in known
    ]


class Chunk:
    """text[low:high] of a giant, with what lies up to the longest piece before and after it."""

    def __init__(self, text: str, low: int, high: int, final: bool, units: Units):
        self.text, self.low, self.high, self.units, v = text, low, high, units, units.vocabulary
        self.vocabulary = v
        self.entries = states(text, low, v.longest, v.pieces) if low else [(0, 0)]
        self.exits = [(0, 0)] if final else states(text, high, v.longest, v.pieces)
        self.first, self.last = cuts(text, low, high)

    def _walk_to_exits(self, start: int, piece: str) -> list[tuple[int, list[str]]]:
        """(exit, pieces) that a path from `start` reaches."""
        final = self.exits == [(0, 0)]
        stop = self.high if final else self.high + max(e for _, e in self.exits)
        before = self.vocabulary.walk(self.text, start, stop, piece)
        found = []
        for k, (begin, end) in enumerate(self.exits):
            if final and (before[self.high] >= 0 or start == self.high):
                found.append((k, trace(self.text, before, start, self.high)))
            elif not final and self.high + end > start and before[self.high + end] == self.high + begin:
                found.append((k, trace(self.text, before, start, self.high + end)))
            elif not final and start == self.high + end and piece == self.text[self.high + begin : start]:
                found.append((k, []))
        return found

    def _heads(self) -> Iterator[tuple[int, int, str, list[str] | None]]:
        """(entry, its end, its piece, pieces from there to the first cut if it is reached)."""
        for s, (begin, end) in enumerate(self.entries):
            at, piece = self.low + end, self.text[self.low + begin : self.low + end]
            if self.first > self.high:
                yield s, at, piece, None
            elif at <= self.first:
                before = self.vocabulary.walk(self.text, at, self.first, piece)
                if at == self.first or before[self.first] >= 0:
                    yield s, at, piece, trace(self.text, before, at, self.first)

    def matrix(self) -> np.ndarray:
        out = np.full((len(self.entries), len(self.exits)), NEVER)
        weigh = lambda parts: sum(map(self.vocabulary.weight, parts))
        tails = [] if self.first > self.high else [(k, weigh(p)) for k, p in self._walk_to_exits(self.last, "")]
        for s, at, piece, head in self._heads():
            if head is None:
                for k, parts in self._walk_to_exits(at, piece):
                    out[s, k] = weigh(parts)
            else:  # what lies between the cuts is the same for all states
                for k, weight in tails:
                    out[s, k] = weigh(head) + weight
        return out

    def ids(self, entry: int, leave: int) -> bytes:
        """Ids of the pieces that begin in the chunk."""
        for s, at, piece, head in self._heads():
            if s == entry:
                if head is None:
                    return packed(dict(self._walk_to_exits(at, piece))[leave], self.vocabulary)
                tail = dict(self._walk_to_exits(self.last, ""))[leave]
                middle = self.units.ids(self.text[self.first : self.last])
                return packed(head, self.vocabulary) + middle + packed(tail, self.vocabulary)
        raise ValueError("no path from this entry state")


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def boundary_states(matrices: list[np.ndarray], entry: int = 0, leave: int = 0) -> list[int]:
    """States at the boundaries of the best path from `entry` to `leave`; one more than matrices."""
    reached = [np.where(np.arange(len(matrices[0])) == entry, 0.0, NEVER)]
    for matrix in matrices:
        reached.append((reached[-1][:, None] + matrix).max(axis=0))
    path = [leave]
    for vector, matrix in zip(reached[-2::-1], matrices[::-1], strict=True):
        path.append(int(np.argmax(vector + matrix[:, path[-1]])))
    return path[::-1]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """Text of the ids; the blank in front is dropped, broken bytes are replaced."""
    spelled = vocabulary.spelled
    text = b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _id_lists(packed: list[bytes]) -> pa.Array:
    lengths = [len(p) // 4 for p in packed]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _small(path: str, vocabulary):
    """(key, text) -> (key, ids); a thousand rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(path, vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [units.ids(written(t or "")) for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], _id_lists(found)], names=[*part.schema.names[:-1], "ids"]
                )

    return run


def _chunks(batch: pa.RecordBatch, units: Units) -> Iterator[Chunk]:
    columns = (batch.column(c).to_pylist() for c in ("text", "low", "high", "final"))
    for text, low, high, final in zip(*columns, strict=True):
        yield Chunk(text, low, high, final, units)


def _matrices(path: str, vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(path, vocabulary)
        for batch in batches:
            found = [c.matrix() for c in _chunks(batch, units)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("giant"), batch.column("k"),
                    pa.array([m.shape[1] for m in found], pa.int32()),
                    pa.array([m.tobytes() for m in found], pa.binary()),
                ],
                names=["giant", "k", "width", "matrix"],
            )

    return run


def _in_order(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    table = table.sort_by("k")
    columns = (table["matrix"].to_pylist(), table["width"].to_pylist())
    return table, [np.frombuffer(m, np.float64).reshape(-1, w) for m, w in zip(*columns, strict=True)]


def _product(table: pa.Table) -> pa.Table:
    """The matrices of one block -> their product; `k` is the block."""
    table, matrices = _in_order(table)
    whole = functools.reduce(multiply, matrices)
    return pa.table(
        {
            "giant": table["giant"][:1], "k": table["block"][:1], "width": pa.array([whole.shape[1]], pa.int32()),
            "matrix": pa.array([whole.tobytes()], pa.binary()),
        }
    )


def _states(table: pa.Table) -> pa.Table:
    """Matrices that follow each other, and the states at both ends -> the states at both ends of each."""
    table, matrices = _in_order(table)
    path = boundary_states(matrices, table["entry"][0].as_py(), table["leave"][0].as_py())
    return pa.table(
        {"giant": table["giant"], "k": table["k"], "entry": pa.array(path[:-1], pa.int32()), "leave": pa.array(path[1:], pa.int32())}
    )


def chunk_states(matrices: DataFrame, block: int = BLOCK) -> DataFrame:
    """(giant, k, width, matrix) -> (giant, k, entry, leave): the best path at the boundaries of every chunk.

    The matrices of `block` chunks meet in one task, and then the products of a giant's blocks."""
    spark, folder = matrices.sparkSession, shared_dir(matrices.sparkSession, "chunk-matrices")
    matrices.withColumn("block", F.expr(f"k div {block}")).write.parquet(folder)
    held, states = spark.read.parquet(folder), "giant string, k long, entry int, leave int"
    ends = (
        held.groupBy("giant", "block").applyInArrow(_product, "giant string, k long, width int, matrix binary")
        .withColumns({"entry": F.lit(0), "leave": F.lit(0)})  # a text has one state in front and one behind
        .groupBy("giant").applyInArrow(_states, states)
    )
    return held.join(ends.withColumnRenamed("k", "block"), ["giant", "block"]).groupBy("giant", "block").applyInArrow(_states, states)


def _traced(path: str, vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(path, vocabulary)
        for batch in batches:
            ends = zip(batch.column("entry").to_pylist(), batch.column("leave").to_pylist(), strict=True)
            found = [c.ids(entry, leave) for c, (entry, leave) in zip(_chunks(batch, units), ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("giant"), batch.column("k"), _id_lists(found)], names=["giant", "k", "ids"]
            )

    return run


def encode(
    docs: DataFrame, path: str = MODEL, chunk: int = CHUNK, keep: tuple[str, ...] = ("doc_id",), block: int = BLOCK
) -> DataFrame:
    """The columns `keep` of every row of `docs`, and `ids` (array of int).

    Null and empty texts have no ids. Repeated rows get equal ids. Texts of more than `chunk` characters
    go through the scan: their chunks are spread over tasks by (text digest, chunk number), a text
    that occurs again is encoded once, and the matrices of `block` chunks (some kilobytes each) meet
    in one task, then a text's products (at most 2^31 / chunk / block). All other texts are encoded where they are read, without a
    shuffle. Extra columns are not looked at; `ids` must not be among `keep`. An empty table gives no rows.
    """
    spark = docs.sparkSession
    # a vocabulary file's pieces: some ten thousand short strings
    vocabulary = spark.sparkContext.broadcast(Vocabulary.load(path))
    longest = vocabulary.value.longest
    if chunk < longest:
        raise ValueError(f"chunks must have {longest} characters or more")
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    kept = ", ".join(f"`{c}` {fields[c]}" for c in keep)
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    small = docs.where(~long).select(*keep, "text").mapInArrow(_small(path, vocabulary), f"{kept}, ids array<int>")

    giants = docs.where(long).select(*keep, F.sha2("text", 256).alias("giant"), "text")
    blank = F.concat(F.lit(BLANK), F.replace(F.col("text"), F.lit(" "), F.lit(BLANK)))
    numbers = F.sequence(F.lit(0), F.floor((F.length("written") - 1) / chunk))
    start = F.col("k") * chunk
    low = F.least(start, F.lit(longest))
    size = F.least(F.lit(chunk), F.length("written") - start)
    chunks = (
        giants.dropDuplicates(["giant"])
        .select("giant", blank.alias("written"))
        .select("giant", "written", F.explode(numbers).alias("k"))
        .select(
            "giant",
            "k",
            F.col("written").substr((start - low + 1).cast("int"), F.lit(chunk + 2 * longest)).alias("text"),
            low.cast("int").alias("low"),
            (low + size).cast("int").alias("high"),
            (start + size == F.length("written")).alias("final"),
        )
        .repartition("giant", "k")
    )
    states = chunk_states(
        chunks.mapInArrow(_matrices(path, vocabulary), "giant string, k long, width int, matrix binary"), block
    )
    ids = (
        chunks.join(states, ["giant", "k"])
        .mapInArrow(_traced(path, vocabulary), "giant string, k long, ids array<int>")
        .groupBy("giant")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda s: s["ids"])).alias("ids"))
    )
    return small.unionByName(giants.select("giant", *keep).join(ids, "giant").select(*keep, "ids"))


def decoded(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Every row of `encoded` with `ids` replaced by `text`; null ids give null, no ids the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    at = encoded.columns.index("ids")
    fields = ", ".join(
        "text string" if f.name == "ids" else f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = [None if v is None else decode(v.values.to_numpy(zero_copy_only=False), vocabulary.value) for v in part.column(at)]
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=["text" if i == at else n for i, n in enumerate(part.schema.names)])

    return encoded.mapInArrow(run, fields)


def digest(ids: np.ndarray) -> str:
    """SHA-256 of the ids as little-endian 32-bit numbers."""
    return hashlib.sha256(np.ascontiguousarray(ids, "<i4").tobytes()).hexdigest()
