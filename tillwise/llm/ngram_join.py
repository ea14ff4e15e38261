"""Jaccard self-join on word shingles by partitioning the universe of shingles.

Two sets with similarity t or more differ in at most H = r (1 - t) / t shingles, r being the size of
the smaller. Sizes fall into bands; every band cuts the universe of shingle hashes into H + 1
segments (H for the band's largest set), so two such sets agree on all of at least one segment. Every
set is indexed by one signature per segment, under its own band and every lower band whose sets it
can still match. Only sets that share a signature are compared, exactly, on their whole sets.
A segment that is empty says little, and sets of one band would all meet under it. So there are some segments more: a set with
H + 1 filled ones agrees with every similar set on a filled one, and is indexed by these only.

Cost-based allocation: a signature with few sets is worked off pair by pair. One with many sets (a
passage that thousands of documents share, or a segment that is empty in them) costs more than
indexing its sets by one-deletion neighbourhoods: with H // 2 + 1 segments, two similar sets differ
by at most one shingle in at least one of them, so the sets meet under the segment or the segment
without one shingle. A pair that meets only under costly signatures has both its sets reindexed
that way, so no pair is lost.

`link` wants the components only, so no group is expanded into its pairs: under every signature, first
all sets are compared with the least one. Signatures whose sets are then in one component are done.
In the others, blocks of sets of different components meet, and only pairs come out that neither their
profiles (counts of hashes in 256 cells) nor their distances to the least set rule out (the number of
differing shingles is a metric); these are compared exactly.

`link_all` wants the number of every row's links as well. It counts them inside the components (`llm.link_counts`),
where each two sets meet once, in blocks, and no row per pair is written.

Equal sets are one class and enter once. A node is the 64-bit hash of a class's text; texts that share
a hash are told apart by the digests of their sets, and a node that stands for two of them is compared by both. Shingles are 64-bit hashes: two different shingles
within one compared pair of a million shingles are taken as equal with a chance below 10^-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import link_counts
from tillwise.llm.columns import WordIds
from tillwise.llm.components import components
from tillwise.session import shared_dir

GROWTH = 1.25  # of the sizes in a band
COSTLY = 4096  # sets under one signature from which deletion neighbourhoods are cheaper than comparing profiles
PROFILE = 256  # cells of a set's profile
BLOCK = 256  # sets of a signature that are compared with as many others in one place
OPEN = 1 << 40  # more shingles than any set has
RECORDS = 500  # rows of an Arrow batch, for rows may hold two sets of shingles
BITMAP = 24  # log2 of the bits of the id filter: at most 2^18 rows of 64 bits are broadcast

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Whole texts to sorted distinct 64-bit shingle hashes."""

    def __init__(self, words: int):
        self.size, self.ids, self.hashes = words, WordIds(), np.zeros(1 << 16, np.uint64)
        self.known = 0

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if len(self.ids) > self.known:
            fresh = self._last(len(self.ids) - self.known)
            if len(self.ids) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(max(len(self.hashes), len(self.ids)), np.uint64)])
            self.hashes[self.known : len(self.ids)] = [xxhash.xxh3_64_intdigest(w) for w in fresh]
            self.known = len(self.ids)
        out = self.hashes[numbers]
        if self.known > 500_000:  # a cache: starting it again changes no result
            self.ids, self.known = WordIds(), 0
        return out

    def _last(self, n: int) -> list[bytes]:
        keys = reversed(self.ids)
        return [next(keys) for _ in range(n)][::-1]

    def of(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = self._hashes(words)
        n = len(hashes) - self.size + 1
        if n < 1:  # the whole sequence is the only shingle
            total = np.full(1, len(hashes), np.uint64)
            for h in hashes:
                total = mix(total * _ODD + h)
            return total
        total = np.zeros(n, np.uint64)
        for i in range(self.size):
            total = total * _ODD + mix(hashes[i : n + i])
        return np.unique(mix(total))


class Bands:
    """Size bands and the segment numbers that a similarity of num / den needs."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.counts = num, den, {}
        low, self.lows, self.highs = 1, [], []
        while low < 2**31:
            after = max(low + 1, int(low * GROWTH))
            self.lows.append(low)
            self.highs.append(after - 1)
            low = after

    def differing(self, band: int) -> int:
        return self.highs[band] * (self.den - self.num) // self.num

    def segments(self, band: int) -> int:
        """At least H + 1, and so many that few sets of the band fill less than H + 1 of them."""
        if band not in self.counts:
            low, need = self.lows[band], self.differing(band) + 1
            count = need
            while count < 2 * need + 8:
                empty, both = (1 - 1 / count) ** low, max(0.0, 1 - 2 / count) ** low
                spread = max(0.0, count * empty * (1 - empty) + count * (count - 1) * (both - empty**2)) ** 0.5
                if min(count * (1 - empty) - 2 * spread, low) >= need:
                    break
                count += 1 + count // 100
            self.counts[band] = count
        return self.counts[band]

    def schemes(self, size: int) -> list[int]:
        """Bands under which a set of this size is indexed: its own and lower ones it can match."""
        own = int(np.searchsorted(self.lows, size, side="right")) - 1
        found = [own]
        while found[-1] > 0 and self.highs[found[-1] - 1] * self.den >= size * self.num:
            found.append(found[-1] - 1)
        return found


def _sums(shingles: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each shingle, its scrambled hash, and the sum of these per segment."""
    where = (shingles >> np.uint64(8)) % np.uint64(segments)
    scrambled = mix(shingles ^ _M2)
    total = np.zeros(segments, np.uint64)
    np.add.at(total, where, scrambled)
    return where, scrambled, total


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """One signature per filled segment of every scheme of the set; also of empty ones if it fills H or less.

    If one of two similar sets fills H + 1, the other has one of these segments equal and filled; if neither does, they
    agree on one of all."""
    found = []
    for band in bands.schemes(len(shingles)):
        segments = bands.segments(band)
        where, _, total = _sums(shingles, segments)
        named = mix(total + _ODD * (np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32)))
        filled = np.bincount(where.astype(np.int64), minlength=segments) > 0
        found.append(named[filled] if int(filled.sum()) > bands.differing(band) else named)
    return np.concatenate(found)


def deletion_signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of every segment and of every segment without one of its shingles."""
    found = []
    for band in bands.schemes(len(shingles)):
        segments = bands.differing(band) // 2 + 1
        where, scrambled, total = _sums(shingles, segments)
        salt = _ODD * (np.arange(segments, dtype=np.uint64) + np.uint64((band + 1001) << 32))
        found += [mix(total + salt), mix(total[where] - scrambled + salt[where])]
    return np.unique(np.concatenate(found))


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles only one of two sorted distinct arrays has."""
    both = np.concatenate([a, b])
    both.sort()
    return len(both) - 2 * int((both[1:] == both[:-1]).sum())


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den |a & b| >= num |a | b|: the sets differ in at most (|a| + |b|) (den - num) / (den + num)."""
    return apart(a, b) * (den + num) <= (len(a) + len(b)) * (den - num)


def profile(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of PROFILE cells, 255 at most."""
    cells = np.bincount((shingles & np.uint64(PROFILE - 1)).astype(np.int64), minlength=PROFILE)
    return np.minimum(cells, 255).astype(np.uint8).tobytes()


def least_apart(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """Sets with profiles p and q differ in at least sum |p - q| shingles, and in their sizes."""
    cells = np.abs(np.frombuffer(a, np.uint8).astype(np.int16) - np.frombuffer(b, np.uint8)).sum()
    return max(int(cells), abs(n_a - n_b))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sketched(words: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingles(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingler.of(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        part.column(3),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([profile(s) for s in sets], pa.binary()),
                        _lists([signatures(s, bands) if len(s) else s for s in sets]),
                    ],
                    names=["node", "own_id", "row", "n_shingles", "digest", "profile", "signatures"],
                )

    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingles(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingler.of(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "digest", "shingles"],
                )

    return run


def _reindexed(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [np.frombuffer(s, np.uint64) for s in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists([deletion_signatures(s, bands) for s in sets])],
                    names=["node", "signatures"],
                )

    return run


def _bounded(num: int, den: int):
    """Pairs with the sets' sizes and profiles -> least and most distance, and whether to compare them.

    A node that stands for several texts (rows that share an id) has no size, and its distances are
    left open."""

    def bounds(of_a: list[dict], of_b: list[dict]) -> tuple:
        pairs = [
            (least_apart(x["profile"], x["n_shingles"], y["profile"], y["n_shingles"]), x["n_shingles"] + y["n_shingles"])
            for x in of_a
            for y in of_b
        ]
        near = any(least * (den + num) <= both * (den - num) for least, both in pairs)
        size = of_b[0]["n_shingles"] if len(of_b) == 1 else None
        return (*pairs[0], near, size) if len(pairs) == 1 else (0, OPEN, near, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [bounds(x, y) for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                names=["a", "b", "least", "most", "near", "n_b"],
            )

    return run


def _meeting(num: int, den: int):
    """Rows sorted by (signature, i, j) -> pairs between blocks i and j of a signature that may be similar;
    `sure` are those that their distances to the hub prove to be."""

    def pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block, i, j = (rows[c].to_numpy() for c in ("block", "i", "j"))
        left = np.flatnonzero(block == i[0])
        right = left if i[0] == j[0] else np.flatnonzero(block == j[0])
        component, node = rows["component"].to_numpy(), rows["node"].to_numpy()
        differ = component[left][:, None] != component[right][None, :]
        if i[0] == j[0]:
            differ = np.triu(differ, 1)
        if not differ.any():
            return node[:0], node[:0], differ[:0, 0]
        profiles = rows["profile"].to_pylist()
        known = np.array([p is not None for p in profiles])
        cells = np.frombuffer(b"".join(p or bytes(PROFILE) for p in profiles), np.uint8).reshape(-1, PROFILE).astype(np.int16)
        n, least, most = (rows[c].fill_null(0).to_numpy() for c in ("n", "least", "most"))
        x, y = np.nonzero(differ)
        x, y = left[x], right[y]
        bound = np.maximum(np.abs(n[x] - n[y]), np.maximum(least[x] - most[y], least[y] - most[x]))
        near = (bound * (den + num) <= (n[x] + n[y]) * (den - num)) | ~known[x] | ~known[y]
        x, y = x[near], y[near]
        kept = []
        for at in range(0, len(x), 1 << 14):
            p, q = x[at : at + (1 << 14)], y[at : at + (1 << 14)]
            cell_bound = np.abs(cells[p] - cells[q]).sum(axis=1, dtype=np.int64)
            kept.append((cell_bound * (den + num) <= (n[p] + n[q]) * (den - num)) | ~known[p] | ~known[q])
        good = np.concatenate([np.zeros(0, bool), *kept])
        x, y = x[good], y[good]
        sure = ((most[x] + most[y]) * (den + num) <= (n[x] + n[y]) * (den - num)) & known[x] & known[y]
        return np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), sure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def groups(table: pa.Table, last: bool) -> Iterator[pa.Table]:
            """Whole groups; what may go on in the next batch is kept back."""
            nonlocal rest
            keys = np.stack([table[c].to_numpy() for c in ("signature", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), table.num_rows]
            if not last:
                rest = table.slice(bounds[-2])
                bounds = bounds[:-1]
            for low, high in zip(bounds, bounds[1:]):
                yield table.slice(low, high - low).combine_chunks()

        def out(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            for group in groups(table, last):
                a, b, sure = pairs(group)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure)], names=["a", "b", "sure"])

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                yield from out(table if rest is None else pa.concat_tables([rest, table]), False)
        if rest is not None:
            yield from out(rest, True)

    return run


def _compared(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                (np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True)
            ]
            far = [apart(x, y) for x, y in sets]
            good = [d * (den + num) <= (len(x) + len(y)) * (den - num) for d, (x, y) in zip(far, sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "n_b", "least", "most")), pa.array(far, pa.int64()), pa.array(good, pa.bool_())],
                names=["a", "b", "n_b", "least", "most", "apart", "linked"],
            )

    return run


def _bit(ids):
    return F.pmod(F.xxhash64(ids), F.lit(1 << BITMAP))


def marked(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """`df` with `hit`: whether its column may be among `ids` (node). Never false for one that is.

    The bitmap of hashed ids has at most 2^18 rows of 64 bits, whatever the number of ids, so it is
    broadcast; a full one marks everything.
    """
    bitmap = (
        ids.select(_bit("node").alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    )
    return (
        df.withColumn("bit", _bit(column))
        .withColumn("word", F.shiftright("bit", 6))
        .join(F.broadcast(bitmap), "word", "left")
        .withColumn("hit", F.expr("coalesce(shiftright(mask, cast(bit & 63 as int)) & 1, 0) = 1"))
        .drop("bit", "word", "mask")
    )


def only_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose column is in `ids` (node). The bitmap keeps most other rows out of the shuffle; the
    semi join decides."""
    return (
        marked(df, column, ids)
        .where("hit")
        .drop("hit")
        .join(ids.select(F.col("node").alias(column)).distinct(), column, "left_semi")
    )


def without_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose column is not in `ids` (node); rows that the bitmap does not mark are not shuffled."""
    both = marked(df, column, ids)
    doubtful = both.where("hit").join(ids.select(F.col("node").alias(column)).distinct(), column, "left_anti")
    return both.where("not hit").unionByName(doubtful).drop("hit")


class _Join:
    """The rounds of one join; every intermediate table is written below the shared folder."""

    def __init__(self, texts: DataFrame, words: int, num: int, den: int):
        self.spark, self.texts, self.words, self.num, self.den = texts.sparkSession, texts, words, num, den
        self.tables, self.folder, self.profiles = 0, shared_dir(self.spark, "ngram"), None

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{self.tables}-{name}"
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, RECORDS)
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(setting, before)
        return self.spark.read.parquet(path)

    def labels(self, edges: DataFrame) -> DataFrame:
        self.tables += 1
        return components(edges, f"{self.folder}/{self.tables}-components")

    def members(self, index: DataFrame) -> DataFrame:
        """(signature, node, hub) of the signatures that two nodes or more have; the hub is the least."""
        # few signatures are shared: the first shuffle has signatures alone, and the bitmap keeps most of the others out of
        # the second, which decides
        often = index.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        hits = marked(index, "signature", often.select(F.col("signature").alias("node"))).where("hit").drop("hit")
        hits = self.written(hits, "hits")
        shared = (
            hits.groupBy("signature")
            .agg(F.min("node").alias("hub"), F.max("node").alias("top"))
            .where("hub < top")
            .drop("top")
        )
        return self.written(hits.join(shared, "signature"), "members")

    def nodes(self, pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    def known_profiles(self, nodes: DataFrame) -> DataFrame:
        """(node, of) of the nodes, and of a few more that the bitmap does not tell from them."""
        return (
            marked(self.profiles, "node", nodes)
            .where("hit")
            .groupBy("node")
            .agg(F.collect_set(F.struct("n_shingles", "profile")).alias("of"))  # one, or one per text of an id
        )

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes, from their texts."""
        return self.written(
            only_ids(self.texts, "node", nodes)
            .select("node", "text")
            .mapInArrow(_set_rows(self.words), "node long, digest binary, shingles binary")
            .dropDuplicates(["node", "digest"])
            .drop("digest"),
            "sets",
        )

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """(a, b, least, most, near, n_b): what sizes and profiles say of the pairs (a, b)."""
        known = self.written(self.known_profiles(self.nodes(pairs)), "profiles")
        side = lambda c: known.select(F.col("node").alias(c), F.col("of").alias(f"of_{c}"))
        rows = pairs.join(side("a"), "a").join(side("b"), "b")
        return self.written(
            rows.mapInArrow(_bounded(self.num, self.den), "a long, b long, least long, most long, near boolean, n_b long"),
            "bounded",
        )

    def distances(self, pairs: DataFrame, sets: DataFrame | None = None, exact: bool = False) -> DataFrame:
        """(a, b, least, most, linked, n_b) of the pairs (a, b): exact distances for those that may be
        similar (with `exact` for all), bounds for the others."""
        bounded = self.bounded(self.written(pairs, "pairs"))
        near, far = bounded.where(F.lit(exact) | F.col("near")), bounded.where(~(F.lit(exact) | F.col("near")))
        sets = self.sets_of(self.nodes(near)) if sets is None else sets
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
        compared = (
            near.drop("near").join(left, "a").join(right, "b")
            .mapInArrow(_compared(self.num, self.den), "a long, b long, n_b long, least long, most long, apart long, linked boolean")
            .groupBy("a", "b")
            .agg(
                *(F.min(c).alias(c) for c in ("n_b", "least", "most", "apart")),
                F.bool_or("linked").alias("linked"), F.count(F.lit(1)).alias("texts"),
            )
        )
        only = F.when(F.col("texts") == 1, F.col("apart"))
        compared = compared.select(
            "a", "b", "n_b", F.coalesce(only, "least").alias("least"), F.coalesce(only, "most").alias("most"), "linked"
        )
        return self.written(
            compared.unionByName(far.select("a", "b", "n_b", "least", "most", F.lit(False).alias("linked"))), "distances"
        )

    def with_hub(self, members: DataFrame) -> DataFrame:
        return members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()

    def open_members(self, members: DataFrame, to_hub: DataFrame, labels: DataFrame) -> DataFrame:
        """Members, but hubs, of signatures with two components or more: with their component, the
        signature's largest, their size, and their distance to the hub."""
        labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        largest = (
            labelled.groupBy("signature", "component")
            .agg(F.count(F.lit(1)).alias("share"))
            .groupBy("signature")
            .agg(
                F.count(F.lit(1)).alias("parts"),
                F.sum("share").alias("held"),
                F.max_by("component", F.struct("share", "component")).alias("largest"),
            )
            .where("parts > 1 and held > 2")  # of two nodes the hub was one
            .drop("parts")
        )
        known = to_hub.select(F.col("a").alias("hub"), F.col("b").alias("node"), "least", "most", F.col("n_b").alias("n"))
        rest = labelled.where("node <> hub").join(largest, "signature").join(known, ["hub", "node"])
        return self.written(rest.drop("hub"), "open")

    def crossing(self, open_members: DataFrame) -> DataFrame:
        """Pairs of one signature and different components that may be similar by their profiles, sizes
        and distances to the hub. Pairs with the hub have been compared.

        The members of a signature are dealt into blocks; a block meets each block in one place, and
        only pairs that may be similar come out."""
        known = self.known_profiles(open_members.select("node")).select(
            "node", F.when(F.size("of") == 1, F.col("of")[0]["profile"]).alias("profile")
        )
        blocks = F.ceil(F.col("held") / BLOCK).cast("int")
        meets = F.sequence(F.lit(0), F.col("blocks") - 1)
        rows = (
            open_members.join(known, "node")
            .withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(meets))
            .select(
                "signature", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "node", "component", "n", "least", "most", "profile",
            )
            .repartition("signature", "i", "j")
            .sortWithinPartitions("signature", "i", "j")
        )
        met = rows.mapInArrow(_meeting(self.num, self.den), "a long, b long, sure boolean")
        return met.groupBy("a", "b").agg(F.bool_or("sure").alias("sure"))

    def proven(self, met: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """(a, b) of the pairs that are similar."""
        met = self.written(met, "met")
        exact = self.distances(met.where("not sure").select("a", "b"), sets).where("linked")
        return met.where("sure").select("a", "b").unionByName(exact.select("a", "b"))


def _with_hubs(costly: DataFrame, members: DataFrame) -> DataFrame:
    """All nodes of the costly signatures."""
    return members.join(costly.select("signature").distinct(), "signature", "left_semi").select("node").distinct()


def _edges(join: _Join) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, (digest, node) of the classes of equal sets, and links (a, b) between nodes, as many as
    the components need."""
    words, num, den = join.words, join.num, join.den
    bands = Bands(num, den)
    sketches = join.written(
        join.texts.select("node", "text", "own_id", F.monotonically_increasing_id().alias("row")).mapInArrow(
            _sketched(words, bands),
            "node long, own_id long, row long, n_shingles long, digest binary, profile binary, signatures array<long>",
        ),
        "sketches",
    )
    filled = sketches.where("n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min(F.struct("node", "row")).alias("first")).select("digest", "first.*")
    # one row of each class goes on
    chosen = classes.select(F.col("digest").alias("class_digest"), F.col("row").alias("class_row"))
    copies = (
        filled.select("row", "digest")
        .join(chosen, F.col("digest") == F.col("class_digest"))
        .where("row <> class_row")
        .select(F.col("row").alias("node"))
    )
    first = without_ids(filled, "row", join.written(copies, "copies"))
    join.profiles = filled.select("node", "n_shingles", "profile")
    index = first.select("node", F.explode("signatures").alias("signature"))
    members = join.members(index)
    linked = lambda pairs: pairs.where("linked").select("a", "b")
    to_hub = join.distances(join.with_hub(members))
    labels = join.labels(linked(to_hub))
    # what follows starts from the components found
    edges = labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))

    left = join.open_members(members, to_hub, labels)
    met = join.crossing(left.where(F.col("held") <= COSTLY))
    edges = edges.unionByName(join.proven(met))
    costly = left.where(F.col("held") > COSTLY)
    if not costly.isEmpty():
        sets = join.sets_of(_with_hubs(costly, members))
        again = join.members(
            sets.mapInArrow(_reindexed(bands), "node long, signatures array<long>")
            .select("node", F.explode("signatures").alias("signature"))
        )
        # all distances to the hub, near or not: they rule out most of the pairs to come
        to_hub = join.distances(join.with_hub(again), sets, exact=True)
        edges = edges.unionByName(linked(to_hub))
        left = join.open_members(again, to_hub, join.labels(edges))
        edges = edges.unionByName(join.proven(join.crossing(left), sets))
    return sketches, classes.drop("row"), edges


def _linked(docs: DataFrame, words: int, num: int, den: int, counted: bool) -> DataFrame:
    text = F.col("text").cast("binary").alias("text")
    join = _Join(docs.select(F.xxhash64("text").alias("node"), text, F.col("doc_id").alias("own_id")), words, num, den)
    sketches, classes, edges = _edges(join)
    sizes = sketches.where("n_shingles > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min("own_id").alias("least"))
    placed = classes.join(join.labels(edges), "node", "left").join(sizes, "digest").select(
        "digest", "node", F.coalesce("component", "node").alias("component"), "size", "least", F.col("component").isNotNull().alias("joined")
    )
    placed = join.written(placed, "placed")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = placed.join(names, "component")
    links = []
    if counted:
        # texts that share a hash are one node in the components; their own sets are counted by both
        weights = placed.where("joined").groupBy("node", "component").agg(F.sum("size").alias("weight"))
        differing = join.written(link_counts.differences(join.sets_of(weights.select("node")), weights), "differences")
        others = join.written(link_counts.others(differing, num, den), "others")
        of_class = of_class.join(others, "node", "left")
        links = [F.when(F.col("n_shingles") > 0, F.col("size") - 1 + F.coalesce("others", F.lit(0))).otherwise(0).cast("long").alias("n_links")]
    of_class = of_class.drop("node").withColumnRenamed("digest", "class_digest")
    return sketches.join(of_class, F.col("digest") == F.col("class_digest"), "left").select(
        F.col("own_id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("own_id")).alias("component_id"),
        *links,
    )


def link(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`.

    Documents are linked if their sets of distinct shingles of `words` words (A-Z lower-cased) have a
    Jaccard similarity of num / den or more; component_id is the least doc_id reachable by links. A
    text of fewer words has its whole sequence as its only shingle; null, empty and blank texts have
    no shingles and are linked with nothing. Every row is judged by its own text, also if rows
    repeat a doc_id; rows with a null doc_id are linked like others, also between two others, but name no
    component (a component of null ids only is null). Extra columns are not looked at. An empty table
    gives no rows.
    """
    return _linked(docs, words, num, den, counted=False)


def link_all(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of `docs`: as `link`, and with how many
    other rows the row is linked, copies included."""
    return _linked(docs, words, num, den, counted=True)
