"""Text files read in pieces by many tasks, and put together again where a record spans pieces.

What a piece means depends on the text before it: is it inside quotes, how deep is it nested? A first look at
each split tells how the split changes that state, whatever it starts with. These changes are composed
along the splits of a file, one row a split, and a second look cuts every split with the state that it
starts in. Rows of a split reach a task in order, so neither look shuffles text; only records that
cross the border of two splits are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, Window, WindowSpec
from pyspark.sql import functions as F

FILE, BLOCK, SIZE = "_file", "_block", "_size"
KIND, END = "_kind", "_end"
# A record may be whole, or the end, the middle or the beginning of one that other splits have parts of.
WHOLE, HEAD, THROUGH, TAIL = 0, 1, 2, 3
BATCH_BYTES = 4 << 20


def read_pieces(reader: DataFrameReader, path: str | list[str], sep: str) -> DataFrame:
    """Pieces in column `value`, partition columns of the path, and file, start of the split and file size."""
    found = reader.option("lineSep", sep).text(path)
    kept = [c for c in found.columns if c != "value"]
    return found.select(
        *kept, "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_size").alias(SIZE),
    )


def kept_columns(pieces: DataFrame) -> list[str]:
    return [c for c in pieces.columns if c not in ("value", FILE, BLOCK, SIZE)]


def earlier_splits() -> WindowSpec:
    """For tables of one row a split."""
    return Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool, bool]]:
    """Slices of the batches with the rows of one split each; is it the first, is it the last of its split?"""
    held = None
    for batch in batches:
        files, blocks = batch.column(FILE), batch.column(BLOCK)
        at = 0
        while at < batch.num_rows:
            key, end = (files[at].as_py(), blocks[at].as_py()), batch.num_rows
            if (files[end - 1].as_py(), blocks[end - 1].as_py()) != key:
                end = at + 1
                while (files[end].as_py(), blocks[end].as_py()) == key:
                    end += 1
            piece = batch.slice(at, end - at)
            if held is not None:
                yield held[0], held[1], held[2] != key
            held = piece, held is None or held[2] != key, key
            at = end
    if held is not None:
        yield held[0], held[1], True


class Records:
    """Record batches of found records, with the other columns of the split they are from."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, split: pa.RecordBatch, found: list[bytes], kind: int = WHOLE, end: bool = False) -> Iterator[pa.RecordBatch]:
        if found:
            self.rows.append((split, found, kind, end))
            self.bytes += sum(map(len, found))
            if self.bytes > BATCH_BYTES:
                yield self.batch()

    def whole(self, split: pa.RecordBatch, found: pa.Array) -> pa.RecordBatch:
        """Whole records of one split; they do not say of which file, which is most of what is written otherwise."""
        fixed = {"value": found, FILE: pa.nulls(len(found), pa.string()), KIND: pa.array(np.zeros(len(found), np.int32)), END: pa.array(np.zeros(len(found), bool))}
        columns = [
            fixed[f.name] if f.name in fixed else pa.repeat(split.column(f.name)[0], len(found)).cast(f.type) for f in self.schema
        ]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def batch(self) -> pa.RecordBatch:
        sizes = [len(found) for _, found, _, _ in self.rows]
        columns = []
        for field in self.schema:
            if field.name == "value":
                values = pa.array([v for _, found, _, _ in self.rows for v in found], pa.binary())
            elif field.name in (KIND, END):
                place = 2 if field.name == KIND else 3
                values = pa.array([row[place] for row, n in zip(self.rows, sizes) for _ in range(n)], field.type)
            else:
                values = pa.array([v for row, n in zip(self.rows, sizes) for v in [row[0].column(field.name)[0].as_py()] * n], field.type)
            columns.append(values)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def whole_records(staged: DataFrame) -> DataFrame:
    """Records of a staged table, those that cross splits put together; `END` if one reaches the end of its file."""
    kept = [c for c in staged.columns if c not in ("value", FILE, BLOCK, KIND, END)]
    several = staged.where(F.col(KIND) != WHOLE)
    order = Window.partitionBy(FILE).orderBy(BLOCK, KIND).rowsBetween(Window.unboundedPreceding, 0)
    several = several.withColumn("_run", F.count_if(F.col(KIND) == TAIL).over(order))
    ordered = F.array_sort(F.collect_list(F.struct(BLOCK, KIND, "value")))
    joined = several.groupBy(*kept, FILE, "_run").agg(
        F.array_join(F.transform(ordered, lambda p: p["value"]), "").alias("value"), F.max(END).alias(END)
    )
    return staged.where(F.col(KIND) == WHOLE).select(*kept, FILE, "value", END).unionByName(joined.drop("_run"))
