"""Document fingerprints by content-defined chunking.

A gear hash runs over the bytes of a text; a chunk ends where its bits match a mask, a strict one up
to the normal chunk size and a looser one after it (normalised chunking). As the hash depends on the
last 32 bytes only, boundaries move with the text when something is inserted before them. The
fingerprint is the set of distinct chunks, each as a 48-bit digest with its length as weight.

Containment of one fingerprint in another is the weight of its chunks that the other has, divided by
its own weight.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORTEST, NORMAL, LONGEST = 16, 48, 192  # chunk lengths in bytes
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF8000000)  # 7 and 5 of the oldest bits
GROUP_BYTES = 4 << 20  # texts hashed together in one task
SPREAD = 8  # id ranges per shuffle partition

GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
GAP = 0xFF  # a byte that UTF-8 never has; between texts it clears the window
GEAR[GAP] = 0


def cut_points(buffer: bytes) -> tuple[list[int], list[int]]:
    """Positions after which the strict and the loose mask allow a cut."""
    hashes = GEAR[np.frombuffer(buffer, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        shifted = hashes[:-step] << np.uint32(step)
        hashes = hashes.copy()
        hashes[step:] += shifted
    loose = np.flatnonzero((hashes & LOOSE) == 0)
    strict = loose[(hashes[loose] & STRICT) == 0]
    return (strict + 1).tolist(), (loose + 1).tolist()


def chunk_ends(start: int, end: int, strict: list[int], loose: list[int]) -> Iterator[int]:
    """Ends of the chunks of buffer[start:end]."""
    while start < end:
        if end - start <= SHORTEST:
            yield end
            return
        i = bisect.bisect_left(strict, start + SHORTEST)
        if i < len(strict) and strict[i] < min(start + NORMAL, end):
            start = strict[i]
        else:
            i = bisect.bisect_left(loose, start + NORMAL)
            start = min(loose[i] if i < len(loose) else end, start + LONGEST, end)
        yield start


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted (48-bit digest, 8-bit length) of the distinct chunks of each text, as one number."""
    gap = bytes([GAP]) * 32
    buffer = gap.join([b"", *texts])
    strict, loose = cut_points(buffer)
    out, at = [], 0
    for text in texts:
        at += len(gap)
        begin, found = at, set()
        for end in chunk_ends(at, at + len(text), strict, loose):
            found.add(xxhash.xxh3_64_intdigest(buffer[begin:end]) >> 16 << 8 | (end - begin))
            begin = end
        out.append(np.array(sorted(found), np.uint64))
        at += len(text)
    return out


def as_text(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 7)
    return np.concatenate([np.zeros((len(raw), 1), np.uint8), raw], axis=1).reshape(-1).view(">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the weight of `a` that `b` has; 1 if both are empty, 0 if only one is."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    weights = a & np.uint64(255)
    return float(weights[np.isin(a, b, assume_unique=True)].sum() / weights.sum())


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> list[int]:
    """Bounds that cut the ids into even ranges, a fixed number for each shuffle partition."""
    n = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10 * n)).first()[0]
    return sorted(set(found or []))


def _range_of(bounds: list[int]):
    ends = np.array(bounds, np.int64)

    @F.pandas_udf(T.LongType())
    def place(ids):
        import pandas as pd

        out = np.searchsorted(ends, ids.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(ids.isna(), -1, out))

    return place


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
ARROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compared(group: list[tuple]) -> pa.RecordBatch:
    """Rows for (doc_id, text, following text)."""
    changed = [edited(text, following).encode() for _, text, following in group]
    texts = [text.encode() for _, text, _ in group]
    nexts = [following.encode() for _, _, following in group]
    prints = fingerprints(texts + changed + nexts[-1:])
    own, new, last = prints[: len(group)], prints[len(group) : -1], prints[-1]
    # within a group the following text is the next row's own text, except for the last row
    after = [*own[1:], last]
    rows = [
        (i, len(text), hashlib.sha256(c).hexdigest(), as_text(a), as_text(b), containment(a, b), containment(a, n))
        for (i, text, _), c, a, b, n in zip(group, changed, own, new, after, strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW, strict=True)],
        names=[part.split()[0] for part in SCHEMA.split(", ")],
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and then by descending id; the last of a range is followed by a copied row."""
    before, group, size = None, [], 0
    for batch in batches:
        for place, copied, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if before is not None:
                group.append((before[1], before[2], text))
                size += len(before[2])
                # a group may go on only while rows follow each other
                if copied or size >= GROUP_BYTES:
                    yield _compared(group)
                    group, size = [], 0
            before = None if copied else (place, doc_id, text)
    if before is not None:
        raise ValueError("a range of ids has no row after its last one")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edit with the next document, and their containments.

    The next document is the one before in ascending order of doc_id (null ids lowest; rows that
    share an id by descending text); the last one is followed by the first. One document alone is
    followed by itself. Null texts count as empty; an empty text has an empty fingerprint, which is like
    (1) another empty one and unlike (0) all others. An empty table gives no rows; extra columns are
    not looked at.

    Texts are shuffled once, into ranges of ids; only the first row of each range is copied to the
    range that comes before it. The bounds of the ranges are all that the driver sees.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    bounds = _ranges(base)
    place = _range_of(bounds)
    heads = (
        base.select("doc_id")
        .withColumn("place", place("doc_id"))
        .groupBy("place")
        .agg(F.max("doc_id").alias("head"))
        .orderBy(F.desc("place"))
        .collect()
    )
    following = [
        (row.place, heads[(i + 1) % len(heads)].head) for i, row in enumerate(heads)
    ]
    # at most SPREAD ranges per shuffle partition
    wanted = F.broadcast(spark.createDataFrame(following, "place long, head long"))
    copies = (
        base.join(wanted, F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("place", "doc_id")
        .agg(F.max("text").alias("text"))
        .select("place", F.lit(True).alias("copied"), "doc_id", "text")
    )
    own = base.select(place("doc_id").alias("place"), F.lit(False).alias("copied"), "doc_id", "text")
    return (
        own.unionByName(copies)
        .repartition("place")
        .sortWithinPartitions("place", "copied", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text"))
        .mapInArrow(_walk, SCHEMA)
    )
