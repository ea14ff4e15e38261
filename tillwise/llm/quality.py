"""Quality rules: word and line counts, and compression bands.

A text is compressed whole and in fixed chunks. Repetitive or templated text compresses too well,
random text hardly at all; what is usual depends on the length, because a short text has no past to
refer to. The limits are parameters, one band for each range of lengths. They were set from labelled
documents so that nearly all documents of good quality lie inside. A long text has many chunks, and one
of thousands may be odd by chance, so a text goes only if more than a share of its chunks are odd.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import WordIds, map_batches

LEVEL = 3  # zstd level
CHUNK = 1024  # bytes; the last chunk of a longer text reaches back to be a full one
# Fixed values: (bytes below this, lowest and highest ratio of the whole text)
BANDS = (
    (256, 0.30, 1.20),
    (512, 0.42, 0.90),
    (1024, 0.495, 0.80),
    (2048, 0.470, 0.72),
    (4096, 0.449, 0.68),
    (16384, 0.411, 0.65),
    (262144, 0.384, 0.65),
    (1048576, 0.370, 0.65),
    (None, 0.355, 0.65),
)
CHUNK_BAND = (0.485, 0.75)  # lowest and highest ratio of a full chunk
MOST_ODD = 2  # percent of chunks outside the band; below 50 chunks none may be
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, lowest_chunk double, highest_chunk double, "
    "odd_chunks long"
)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that stand in a window of `size` words found at two or more places of the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids = WordIds()
    numbers = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    keys = numbers[:n]  # at most 2^31 words, so one multiplication fits; after that by rank
    for i in range(1, size):
        keys = keys * len(ids) + numbers[i : n + i]
        keys = np.unique(keys, return_inverse=True)[1] if len(ids) ** 3 >= 2**63 else keys
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(size):
        covered[i : n + i] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def chunks(text: bytes, size: int = CHUNK) -> list[bytes]:
    """All of a text in chunks of `size` bytes, the last one reaching back; a shorter text has none, for it
    would be compressed whole a second time."""
    starts = [*range(0, len(text) - size, size), len(text) - size] if len(text) >= size else []
    return [text[at : at + size] for at in starts]


def ratios(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Compressed share of the whole text, and of each chunk."""
    whole = len(packer.compress(text)) / len(text) if text else 1.0
    return whole, [len(packer.compress(chunk)) / CHUNK for chunk in chunks(text)]


def in_band(size: int, whole: float, bands=BANDS) -> bool:
    floor, ceiling = next((a, b) for below, a, b in bands if below is None or size < below)
    return floor <= whole <= ceiling


def judge(doc_id, text: bytes | None, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or b""
    words = text.split()
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    whole, parts = ratios(text, packer)
    odd = sum(not CHUNK_BAND[0] <= part <= CHUNK_BAND[1] for part in parts)
    return (
        doc_id,
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicate_lines(text),
        repeated,
        failed,
        not failed and in_band(len(text), whole) and 100 * odd <= MOST_ODD * len(parts),
        whole,
        min(parts, default=None),
        max(parts, default=None),
        odd,
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = [
            judge(i, t, packer)
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(ARROW), ARROW, strict=True)],
            names=[part.split()[0] for part in SCHEMA.split(", ")],
        )


ARROW = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 3 + [pa.int64()]


def rules(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` with counts, `base_failed` and `kept`; no shuffle.

    Null and empty texts have no words, so they fail the base rule; their ratio is 1. Repeated rows
    are judged one by one; null ids stay null. Extra columns are not looked at. A very long text is
    one row in one task: its time grows with its length, its memory with a few copies of it.
    """
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), _judged, SCHEMA)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass all rules, with all their columns; texts are not shuffled."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([judge(None, t, packer)[7] for t in texts], pa.bool_()))

    return docs.mapInArrow(passing, fields)
