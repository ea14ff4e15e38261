"""Column expressions and small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words are runs of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as `bytes.lower` does in Python tasks."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it as long as `df` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow`; texts arrive as bytes because the text columns are cast to binary first."""
    return df.mapInArrow(fn, schema)


class WordIds(dict):
    """Numbers words as they come: `ids[word]` is the same small integer each time."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number
