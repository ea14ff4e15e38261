"""Elements of JSON array files of any size, cut by many tasks (see `sources.pieces`).

Files are read in pieces that end at a closing brace. If every piece of a file is one flat object, nothing more is
needed. Otherwise its splits are scanned: quotes change the state by parity, brackets change the depth by sums that
are held at 0, for brackets that close nothing do not count. Elements are cut at the commas and closing
brackets of the array itself. The scan looks at whole batches with numpy and never at single characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.sources.pieces import (
    BLOCK, END, FILE, HEAD, KIND, SIZE, TAIL, THROUGH, Records, by_split, earlier_splits, kept_columns, whole_records,
)

# What may stand between two objects of an array, null elements among it.
_BETWEEN = r"^(?:[\s,\[\]]|null)+"
_QUOTE, _BACKSLASH, _COMMA, _OPEN_SQUARE, _CLOSE_SQUARE = b'"\\,[]'
_MOVES = np.zeros(256, dtype=np.int64)
_MOVES[list(b"{[")], _MOVES[list(b"}]")] = 1, -1
_TOKENS = np.zeros(256, dtype=bool)
_TOKENS[list(b'{[}],"')] = True
_NOTHING = np.iinfo(np.int64).max // 2


def flat_record(value: Column) -> Column:
    """The object of a piece, '' if it has none."""
    body = F.regexp_replace(value, _BETWEEN, "")
    return F.when(body.startswith("{"), F.concat(body, F.lit("}"))).otherwise(body)


def odd_files(pieces: DataFrame) -> DataFrame:
    """(file, cut) of the files that are no array of flat objects; `cut` says that there is text behind the last
    closing brace. A file that ends inside an object is odd as well."""
    bare = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    seen = pieces.select(FILE, BLOCK, SIZE, F.octet_length("value").alias("bytes"), F.regexp_replace(bare, _BETWEEN, "").alias("body"))
    seen = seen.withColumn("blank", F.col("body") == "").withColumn("nr", F.monotonically_increasing_id())
    flat = F.expr(
        f"body LIKE '{{%' AND {_count('{')} = 1 AND {_count(chr(34))} % 2 = 0 AND {_count('[')} = {_count(']')}"
    )
    files = seen.groupBy(FILE).agg(
        F.max(~flat & ~F.col("blank")).alias("odd"),
        F.count_if("blank").alias("blanks"),
        F.max(F.struct(BLOCK, "nr", "blank")).alias("last"),
        (F.sum("bytes") + F.count("*") - F.max(SIZE)).alias("over"),
    )
    # every piece but one at the end has a brace behind it; three bytes may be a byte order mark
    closed = F.col("over").isin(0, -3)
    plain = F.when(closed, F.col("blanks") == 0).otherwise((F.col("blanks") == 1) & F.col("last.blank"))
    return files.where(F.col("odd") | ~plain).select(FILE, (~closed).alias("cut"))


def cut(pieces: DataFrame, files: DataFrame) -> DataFrame:
    """Elements and parts of elements of odd files, to be staged for `elements`; nulls and blanks are left out. `files`
    tells for each whether its last piece lacks the closing brace."""
    kept = kept_columns(pieces)
    texts = pieces.withColumn("value", F.col("value").cast("binary"))
    splits = texts.select("value", FILE, BLOCK).mapInArrow(
        _look, f"{FILE} string, {BLOCK} long, quotes long, by0 long, low0 long, by1 long, low1 long, opening long"
    )
    inside = F.coalesce(F.sum("quotes").over(earlier_splits()), F.lit(0)) % 2
    splits = splits.withColumn("_inside", inside.cast("long")).select(
        FILE, BLOCK, "_inside",
        *(F.when(F.col("_inside") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(c) for c in ("by", "low")),
        # the array's own bracket does not count
        F.min(F.struct(BLOCK, "opening")).over(Window.partitionBy(FILE))["opening"].alias("opening"),
        (F.col(BLOCK) == F.max(BLOCK).over(Window.partitionBy(FILE))).alias("last"),
    )
    splits = splits.withColumn("sum", F.coalesce(F.sum("by").over(earlier_splits()), F.lit(0)) - F.col("opening"))
    splits = splits.withColumn("lowest", F.min(F.col("sum") + F.col("low")).over(earlier_splits()))
    held = F.col("sum") - F.least(F.lit(0), F.coalesce("lowest", F.lit(0)))
    splits = splits.join(F.broadcast(files), FILE).select(
        FILE, BLOCK, "_inside", held.alias("_depth"), F.col("last").alias("_last"), (F.col("last") & F.col("cut")).alias("_cut")
    )
    # one row a split; a broadcast join leaves the rows of a split in order
    state = texts.drop(SIZE).join(F.broadcast(splits), [FILE, BLOCK])
    columns = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{columns}{', ' if kept else ''}{FILE} string, {BLOCK} long, value binary, {KIND} int, {END} boolean"
    arrow = pa.schema([("value", pa.binary()), (KIND, pa.int32()), (END, pa.bool_()), (FILE, pa.string()), (BLOCK, pa.int64())])
    found = state.mapInArrow(lambda batches: _cut(batches, kept, arrow), schema)
    return found.withColumn("value", F.col("value").cast("string"))


def elements(staged: DataFrame) -> DataFrame:
    """Texts of whole elements."""
    found = whole_records(staged)
    return found.withColumn("value", F.regexp_replace("value", r"^\s+|\s+$", ""))


def doubtful(text: Column) -> Column:
    """Whether an element is no JSON but may have objects in it, or is itself an array."""
    return text.rlike(r"(?s)^.+\{") & (F.try_parse_json(text).isNull() | text.rlike(r"^\s*\["))


def _count(char: str) -> str:
    return f"(length(body) - length(replace(body, '{char}', '')))"


def _text(pieces: pa.RecordBatch, first: bool) -> bytes:
    """Pieces with the braces between them, the one that ended the piece before included."""
    return (b"" if first else b"}") + b"}".join(pieces.column("value").to_pylist())


def _tokens(text: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places and characters of quotes, brackets and commas that are not escaped; is the next character escaped?"""
    chars = np.frombuffer(text, dtype=np.uint8)
    places = np.flatnonzero(_TOKENS[chars])
    if escaped or b"\\" in text:
        slashes = np.flatnonzero(chars == _BACKSLASH)
        # the character behind an odd number of backslashes in a row is escaped
        starts = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(starts, append=len(slashes))
        first = slashes[starts] if len(slashes) else slashes
        if escaped and len(first) and first[0] == 0:
            lengths[0] -= 1
        behind = (slashes[starts + np.diff(starts, append=len(slashes)) - 1] + 1)[lengths % 2 == 1] if len(slashes) else slashes
        if escaped and not (len(first) and first[0] == 0):
            behind = np.append(behind, 0)
        escaped = bool(len(behind)) and bool((behind == len(chars)).any())
        places = places[~np.isin(places, behind)]
    return places, chars[places], escaped


def _moves(chars: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Depth changes of tokens, 0 inside strings; is a token outside?"""
    quotes = chars == _QUOTE
    outside = (np.cumsum(quotes) - quotes + inside) % 2 == 0
    return np.where(outside, _MOVES[chars], 0), outside


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each split changes the state, for one that starts outside and one that starts inside a string."""
    rows = []
    for batch, first, last in by_split(batches):
        text = _text(batch, first)
        if first:
            quotes, escaped, by, low = 0, False, [0, 0], [_NOTHING, _NOTHING]
            opening = int(batch.column(BLOCK)[0].as_py() == 0 and text.removeprefix(b"\xef\xbb\xbf").lstrip().startswith(b"["))
        _, chars, escaped = _tokens(text + b"}" if last else text, escaped)
        for s in (0, 1):
            moves, _ = _moves(chars, (quotes + s) % 2)
            depths = by[s] + np.cumsum(moves[moves != 0])
            if len(depths):
                by[s], low[s] = int(depths[-1]), min(low[s], int(depths.min()))
        quotes += int((chars == _QUOTE).sum())
        if last:
            lows = [None if v == _NOTHING else v for v in low]
            rows.append((batch.column(FILE)[0].as_py(), batch.column(BLOCK)[0].as_py(), quotes % 2, by[0], lows[0], by[1], lows[1], opening))
    names = [FILE, BLOCK, "quotes", "by0", "low0", "by1", "low1", "opening"]
    types = [pa.string()] + [pa.int64()] * 7
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _cut(batches: Iterator[pa.RecordBatch], kept: list[str], fixed: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = None
    for batch, first, last in by_split(batches):
        if out is None:
            names = [*kept, FILE, BLOCK, "value", KIND, END]
            out = Records(pa.schema([batch.schema.field(n) if n in kept else fixed.field(n) for n in names]))
        if first:
            inside, depth = batch.column("_inside")[0].as_py(), batch.column("_depth")[0].as_py()
            rest, escaped, torn = [], False, bool(inside or depth > 0)
        text = _text(batch, first)
        if last and not batch.column("_cut")[0].as_py():
            text += b"}"
        places, chars, escaped = _tokens(text, escaped)
        moves, outside = _moves(chars, inside)
        sums = depth + np.cumsum(moves)
        # held at 0, but for the depth -1 in front of the array
        after = sums - np.minimum(0, np.minimum.accumulate(np.where(moves < 0, sums, 0))) if len(sums) else sums
        before = np.concatenate([[depth], after[:-1]]) if len(sums) else sums
        level = outside & (before <= 0)
        left_out = level & ((chars == _COMMA) | (chars == _CLOSE_SQUARE) | ((before < 0) & (chars == _OPEN_SQUARE)))
        ends = left_out | ((moves < 0) & (before <= 1))
        begin, found = 0, []
        for to, without in zip((places[ends] + 1).tolist(), left_out[ends].tolist()):
            if rest:
                element, rest = b"".join([*rest, text[begin : to - without]]), []
            else:
                element = text[begin : to - without]
            begin = to
            if torn:
                yield from out.add(batch, [element], HEAD)
                torn = False
            elif (element := element.strip()) and element != b"null":
                found.append(element)
        rest.append(text[begin:])
        yield from out.add(batch, found)
        inside = (inside + int((chars == _QUOTE).sum())) % 2
        depth = int(after[-1]) if len(after) else depth
        if last:
            element, end = b"".join(rest), batch.column("_last")[0].as_py()
            if torn:
                yield from out.add(batch, [element], THROUGH, end)
            elif inside or depth > 0:
                yield from out.add(batch, [element], TAIL, end)
            elif (element := element.strip()) and element != b"null":
                yield from out.add(batch, [element], end=end)
    if out is not None and out.rows:
        yield out.batch()
