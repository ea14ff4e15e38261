"""CSV records with quoted line breaks, cut by many tasks (see `sources.pieces`).

A line changes one bit of state: does the next one start inside a quoted field? Whatever the bit was, a line without
quotes leaves it, and any other line is walked from field to field for both cases. A split as a whole leaves the
bit, flips it or sets it, and so does a row of splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.sources.pieces import (
    BLOCK, END, FILE, HEAD, KIND, SIZE, TAIL, THROUGH, Records, by_split, earlier_splits, kept_columns, whole_records,
)

# In tables of records this column marks the header of a file.
HEADER = END


def cut(lines: DataFrame, sep: str, escape: str, header: bool) -> DataFrame:
    """Records and parts of records, to be staged for `records`; empty lines are left out."""
    kept = kept_columns(lines)
    texts = lines.withColumn("value", F.col("value").cast("binary"))
    marks = sep.encode(), escape.encode()
    splits = texts.select("value", FILE, BLOCK).mapInArrow(
        lambda batches: _look(batches, *marks), f"{FILE} string, {BLOCK} long, from0 int, from1 int, crlf boolean"
    )
    flips = F.expr("int(from0 = 1 AND from1 = 0)")
    to_here = Window.partitionBy(FILE).orderBy(BLOCK)
    splits = splits.withColumn("flips", F.sum(flips).over(to_here)).withColumn("turned", flips)
    # what the last split that sets the bit set it to, seen from before all flips
    fixed = F.when(F.col("from0") == F.col("from1"), (F.col("from0") + F.col("flips")) % 2)
    start = (F.coalesce(F.last(fixed, ignorenulls=True).over(earlier_splits()), F.lit(0)) + F.col("flips") - F.col("turned")) % 2
    # as Spark's own reader does, the first line of a file decides whether two characters end a line
    crlf = F.min(F.struct(BLOCK, "crlf")).over(Window.partitionBy(FILE))["crlf"]
    splits = splits.select(FILE, BLOCK, start.cast("int").alias("_inside"), crlf.alias("_crlf"))
    # one row a split; a broadcast join leaves the rows of a split in order
    state = texts.drop(SIZE).join(F.broadcast(splits), [FILE, BLOCK])
    columns = "".join(f"`{c}` {lines.schema[c].dataType.simpleString()}, " for c in kept)
    schema = f"{columns}{FILE} string, {BLOCK} long, value binary, {KIND} int, {END} boolean"
    arrow = pa.schema([("value", pa.binary()), (KIND, pa.int32()), (END, pa.bool_()), (FILE, pa.string()), (BLOCK, pa.int64())])
    found = state.mapInArrow(lambda batches: _cut(batches, kept, arrow, *marks, header), schema)
    return found.withColumn("value", F.col("value").cast("string"))


def records(staged: DataFrame) -> DataFrame:
    """Whole records, headers among them."""
    last = F.expr("CASE WHEN endswith(value, '\\n') THEN left(value, length(value) - 1) ELSE value END")
    return whole_records(staged).withColumn("value", last)


def parsed(records: DataFrame, schema: str, options: dict[str, str]) -> DataFrame:
    """Records as columns, with partition columns behind them as Spark's own reader has them."""
    kept = [c for c in records.columns if c not in ("value", FILE, HEADER)]
    row: Column = F.from_csv("value", schema, options)
    return records.select(F.explode(F.array(row)).alias("_row"), *kept).select("_row.*", *kept)


def _ends_inside(line: bytes, inside: bool, sep: bytes, escape: bytes) -> bool:
    """Whether a line ends inside a quoted field. A quote opens a field only as its first character; text behind a
    closing quote belongs to the field up to the next separator."""
    at = 0
    while True:
        if not inside:
            while line[at : at + 1] != b'"':
                at = line.find(sep, at) + 1
                if not at:
                    return False
            at += 1
        quote = line.find(b'"', at)
        if escape != b'"':
            slash = line.find(escape, at)
            if 0 <= slash < quote:
                at, inside = slash + 2, True
                continue
        if quote < 0:
            return True
        if escape == b'"' and line[quote + 1 : quote + 2] == b'"':
            at, inside = quote + 2, True
            continue
        at, inside = line.find(sep, quote + 1) + 1, False
        if not at:
            return False


def _states(lines: pa.Array, inside: bool, sep: bytes, escape: bytes) -> np.ndarray:
    """For each line of a batch, whether it ends inside a quoted field.

    Where fields are quoted as a writer quotes them, every quote turns the state over; patterns prove that for all
    lines of the batch at once. Otherwise the lines with quotes are walked one after the other."""
    quotes = pc.count_substring(lines, b'"').to_numpy(zero_copy_only=False)
    after = (np.cumsum(quotes) + inside) % 2 == 1
    quoted = np.flatnonzero(quotes)
    if not len(quoted):
        return after
    if escape == b'"':
        before = np.concatenate([[inside], after[:-1]])[quoted]
        inner, plain = rb'(?:[^"]|"")*', rb'[^"' + re.escape(sep) + rb"]*"
        fields = rb'(?:(?:"' + inner + rb'"|' + plain + rb")" + re.escape(sep) + rb')*(?:"' + inner + rb'"?|' + plain + rb")"
        some = lines.take(pa.array(quoted))
        outer_ok = pc.match_substring_regex(some, rb"^" + fields + rb"$").to_numpy(zero_copy_only=False)
        inner_ok = pc.match_substring_regex(some, rb"^" + inner + rb'(?:"(?:' + re.escape(sep) + fields + rb")?)?$").to_numpy(zero_copy_only=False)
        if np.where(before, inner_ok, outer_ok).all():
            return after
    after[:] = inside
    for at, line in zip(quoted.tolist(), lines.take(pa.array(quoted)).to_pylist()):
        inside = _ends_inside(line, inside, sep, escape)
        after[at:] = inside
    return after


def _look(batches: Iterator[pa.RecordBatch], sep: bytes, escape: bytes) -> Iterator[pa.RecordBatch]:
    """Where each split ends, inside a field or not, for one that starts outside and one that starts inside."""
    rows = []
    for batch, first, last in by_split(batches):
        lines = batch.column("value")
        if first:
            outer, inner = False, True
            crlf = lines[0].as_py().endswith(b"\r")
        after = _states(lines, outer, sep, escape)
        if inner == outer:
            inner = bool(after[-1])
        else:
            # the two seldom stay apart for long
            for at in np.flatnonzero(pc.match_substring(lines, b'"').to_numpy(zero_copy_only=False)).tolist():
                inner = _ends_inside(lines[at].as_py(), inner, sep, escape)
                if inner == after[at]:
                    inner = bool(after[-1])
                    break
        outer = bool(after[-1])
        if last:
            rows.append((batch.column(FILE)[0].as_py(), batch.column(BLOCK)[0].as_py(), int(outer), int(inner), crlf))
    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    yield pa.RecordBatch.from_arrays(columns, names=[FILE, BLOCK, "from0", "from1", "crlf"])


def _cut(
    batches: Iterator[pa.RecordBatch], kept: list[str], fixed: pa.Schema, sep: bytes, escape: bytes, header: bool
) -> Iterator[pa.RecordBatch]:
    out = None
    for batch, first, last in by_split(batches):
        lines = batch.column("value")
        if out is None:
            names = [*kept, FILE, BLOCK, "value", KIND, END]
            out = Records(pa.schema([batch.schema.field(n) if n in kept else fixed.field(n) for n in names]))
        if first:
            inside = torn = bool(batch.column("_inside")[0].as_py())
            rest, crlf = b"", batch.column("_crlf")[0].as_py()
            named = not header or batch.column(BLOCK)[0].as_py() != 0
        after = _states(lines, inside, sep, escape)
        inside = bool(after[-1])
        lengths = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        text = rest + b"\n".join(lines.to_pylist()) + b"\n"
        if crlf:
            lengths -= pc.ends_with(lines, b"\r").to_numpy(zero_copy_only=False)
            text = text.replace(b"\r\n", b"\n")
        # records end with the line feed behind them
        ends = (len(rest) + np.cumsum(lengths))[~after]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        rest = text[offsets[-1] :]
        found = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        if torn and len(found):
            yield from out.add(batch, [found[0].as_py()], HEAD)
            found, torn = found.slice(1), False
        found = found.filter(pc.greater(pc.binary_length(found), 1))
        if not named and len(found):
            yield from out.add(batch, [found[0].as_py()], end=True)
            found, named = found.slice(1), True
        if len(found):
            yield out.whole(batch, found)
        if last and rest:
            yield from out.add(batch, [rest], THROUGH if torn else TAIL, end=not named)
        elif last and torn:
            yield from out.add(batch, [rest], THROUGH)
    if out is not None and out.rows:
        yield out.batch()
