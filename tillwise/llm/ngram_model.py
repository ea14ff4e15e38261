"""Language-model scores from sharded Elias-Fano n-gram tries.

The model is a bigram model with hierarchical Dirichlet smoothing,

    p(w | u) = (c(u w) + M p1(w)) / (c(u) + M),    p1(w) = (c(w) + 1) / (N + V + 1),

with c counted over the training documents. The trie stores bigrams last word first, as back-off tries
do: level 1 has the words, level 2 their left neighbours. Both are Elias-Fano sequences in memory-mapped
files: the pointers from level 1 to level 2 are monotone, and the neighbours of a word are kept
relative to it (word rank times 2^40 plus neighbour), so a level is one monotone sequence and a
bigram is found by one successor search. Beside each entry stands its smoothed log probability,
quantised to 1/2048 of a decade.

The words are dealt over shards by hash; every shard builds its own trie from the counts of all blocks
of documents and answers the blocks' queries, so a trie never has to fit into one place and no count
passes through the driver. A block of documents sends each shard one message: its words, their
neighbours, training counts, and in which of its documents they occur. A word with a large share of
all words is dealt over several shards by its neighbours; a sample finds such words, and only the
routing depends on it. A shard sends back one partial sum per document.

V is counted before, so that scores do not depend on how words and documents are dealt.
"""

from __future__ import annotations

import pickle
import string
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import WordIds
from tillwise.llm.elias_fano import EliasFano, save
from tillwise.session import shared_dir

FOLDS, HELD_OUT = 7, 2
MASS = 200.0  # M
GRID = 2048  # quantisation steps per decade
BLOCK_BYTES = 16 << 20  # text per block; also what a shard gets of it on average
BLOCK_DOCS = 60_000
NEIGHBOUR_BITS = 40
SAMPLE = 0.01  # of documents, for the routing of frequent words

END, START = np.uint64(0x1234567F00000001), np.uint64(0x1234567F00000002)


def in_fold(doc_id, folds: int = FOLDS) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def word_hash(word) -> int:
    return int(END) if word is None else int(START) if word == "" else xxhash.xxh3_64_intdigest(word)


class Routing:
    """Shard of a bigram: by its last word, frequent words by the neighbour as well."""

    def __init__(self, shards: int, frequent: dict[int, int]):
        self.shards, self.frequent = shards, frequent

    def split(self, hashes: np.ndarray) -> np.ndarray:
        """Over how many shards each word is dealt."""
        if not self.frequent:
            return np.ones(len(hashes), np.int64)
        keys = np.array(sorted(self.frequent), np.uint64)
        ways = np.array([self.frequent[int(k)] for k in keys], np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, ways[at], 1)

    def home(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(17)) % np.uint64(self.shards)).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


class Block:
    """Documents whose bigrams are counted together."""

    def __init__(self):
        self.ids, self.numbers, self.docs, self.size = WordIds(), [], [], 0
        self.end, self.start = self.ids[None], self.ids[""]

    def add(self, doc_id, text: bytes | None) -> None:
        words = (text or b"").lower().split()
        found = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        self.numbers.append(np.append(found, self.end))
        self.docs.append((doc_id, in_fold(doc_id) == HELD_OUT, len(words) + 1))
        self.size += len(text or b"")

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.docs) >= BLOCK_DOCS

    def messages(self, routing: Routing) -> Iterator[tuple[int, bytes]]:
        """(shard, packed message) for every shard."""
        n_words, shards = len(self.ids), routing.shards
        hashes = np.array([word_hash(w) for w in self.ids], np.uint64)
        last = np.concatenate(self.numbers)
        lengths = np.array([len(x) for x in self.numbers])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        train = np.repeat(~np.array([d[1] for d in self.docs]), lengths)
        before = np.empty_like(last)
        before[1:] = last[:-1]
        before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = self.start
        counts = np.bincount(last[train], minlength=n_words)
        ways, home = routing.split(hashes), routing.home(hashes)
        own = (hashes >> np.uint64(3)).astype(np.int64)
        shard = (home[last] + own[before] % ways[last]) % shards

        key = (shard * n_words + last) * n_words + before
        order = np.argsort(key, kind="stable")  # documents stay in order within a bigram
        key, doc, train = key[order], doc[order], train[order]
        new_pair = np.concatenate([[True], key[1:] != key[:-1]])
        new_place = new_pair | np.concatenate([[True], doc[1:] != doc[:-1]])
        pairs, places = np.flatnonzero(new_pair), np.flatnonzero(new_place)
        trained = np.add.reduceat(train.astype(np.int64), pairs)
        times = np.diff(np.append(places, len(key)))
        places_of = np.diff(np.append(np.searchsorted(places, pairs), len(places)))
        pair_key = key[pairs]
        pair_shard, pair_word = pair_key // (n_words * n_words), pair_key // n_words % n_words
        neighbour = hashes[pair_key % n_words] >> np.uint64(64 - NEIGHBOUR_BITS)
        neighbour = neighbour.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : NEIGHBOUR_BITS // 8]
        place_doc = doc[places].astype(np.uint16)

        spread: dict[int, list[int]] = {}
        for w in np.flatnonzero(ways > 1):
            for k in range(ways[w]):
                spread.setdefault(int((home[w] + k) % shards), []).append(w)
        ends = np.searchsorted(pair_shard, np.arange(shards + 1))
        place_ends = np.concatenate([[0], np.cumsum(places_of)])[ends]
        total = np.array([int(counts.sum())])
        for s in range(shards):
            a, b = ends[s], ends[s + 1]
            words, held = np.unique(pair_word[a:b], return_counts=True)
            also = np.array(spread.get(s, []), np.int64)
            yield s, _pack(
                total,
                hashes[words], np.where(ways[words] > 1, 0, counts[words]).astype(np.uint32), held.astype(np.uint32),
                hashes[also], counts[also].astype(np.uint32),
                neighbour[a:b].copy(), trained[a:b].astype(np.uint32), places_of[a:b].astype(np.uint32),
                place_doc[place_ends[s] : place_ends[s + 1]], times[place_ends[s] : place_ends[s + 1]].astype(np.uint32),
            )


def _blocks(routing: Routing):
    """(doc_id, text) -> (kind, block, payload): kind is a shard, or -1 for the block's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, block = TaskContext.get().partitionId(), 0, Block()

        def closed() -> Iterator[pa.RecordBatch]:
            name = task << 24 | number
            ids, held_out, lengths = zip(*block.docs, strict=True)
            rows = [(-1, name, _pack(np.array(ids, object), np.array(held_out), np.array(lengths)))]
            rows += [(s, name, data) for s, data in block.messages(routing)]
            for at in range(0, len(rows), 16):
                part = rows[at : at + 16]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int64()),
                     pa.array([r[2] for r in part], pa.binary())],
                    names=["kind", "block", "payload"],
                )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, text.as_py())
                if block.full():
                    yield from closed()
                    number, block = number + 1, Block()
        if block.docs:
            yield from closed()

    return run


def quantised(logs: np.ndarray) -> np.ndarray:
    """Log10 values between -31 and 1 as 16-bit steps below 1."""
    return np.clip(np.rint((1.0 - logs) * GRID), 0, 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return 1.0 - codes.astype(np.float64) / GRID


class Trie:
    """One shard's words and bigrams of the training documents in memory-mapped levels."""

    def __init__(self, words, counts, pair_rank, pair_neighbour, pair_counts, base: float, folder: str):
        """Words sorted, with their counts; bigrams sorted by (rank of the word, neighbour)."""
        self.words = EliasFano(words >> np.uint64(1), folder, "words")
        keys = pair_rank.astype(np.uint64) << np.uint64(NEIGHBOUR_BITS) | pair_neighbour
        self.pairs = EliasFano(keys, folder, "pairs")
        starts = np.searchsorted(pair_rank, np.arange(len(words) + 1))
        self.pointers = EliasFano(starts + np.arange(len(words) + 1), folder, "pointers")
        self.lower = MASS * (counts + 1.0) / base  # M p1 of each word
        self.codes = save(quantised(np.log10(pair_counts + self.lower[pair_rank]) - SHIFT), f"{folder}/pairs.codes")
        self.word_codes = save(quantised(np.log10(self.lower) - SHIFT), f"{folder}/words.codes")
        self.unknown = quantised(np.log10(np.array([MASS / base])) - SHIFT)

    def _pointer(self, rank: np.ndarray) -> np.ndarray:
        """Where the neighbours of a word begin on level 2."""
        return self.pointers.get(rank).astype(np.int64) - rank

    def numerators(self, words: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """log10(c(u w) + M p1(w)) of each (w, u)."""
        rank = self.words.find(words >> np.uint64(1))
        known = rank >= 0
        out = np.full(len(words), restored(self.unknown)[0])
        out[known] = restored(self.word_codes[rank[known]])
        parent = rank[known]
        x = parent.astype(np.uint64) << np.uint64(NEIGHBOUR_BITS) | neighbours[known]
        at = self.pairs.find(x, self._pointer(parent), self._pointer(parent + 1))
        seen = np.flatnonzero(known)[at >= 0]
        out[seen] = restored(self.codes[at[at >= 0]])
        return out + SHIFT


SHIFT = 14.0  # counts reach 10^15; logs are kept below 1


def _answered(n_words: int):
    """All messages to one shard -> partial sums per block."""

    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        if kind < 0:  # the documents of the blocks pass through
            return table.select(["block", "payload"]).append_column("kind", pa.array([-1] * table.num_rows, pa.int64()))
        order = np.argsort(table["block"].to_numpy())
        blocks = table["block"].to_numpy()[order]
        messages = [_unpack(table["payload"][int(i)].as_py()) for i in order]
        total = sum(int(m[0][0]) for m in messages)
        words, rank = np.unique(np.concatenate([x for m in messages for x in (m[1], m[4])]), return_inverse=True)
        counts = np.bincount(rank, np.concatenate([x for m in messages for x in (m[2], m[5])]), len(words)).astype(np.int64)

        per_message, at = [], 0
        for m in messages:
            per_message.append(np.repeat(rank[at : at + len(m[1])], m[3]))
            at += len(m[1]) + len(m[4])
        pair_rank = np.concatenate(per_message)
        raw = np.concatenate([m[6] for m in messages])
        neighbour = np.zeros((len(raw), 8), np.uint8)
        neighbour[:, : NEIGHBOUR_BITS // 8] = raw
        neighbour = neighbour.reshape(-1).view("<u8").astype(np.uint64)
        trained = np.concatenate([m[7] for m in messages]).astype(np.int64)

        seen = counts > 0
        seen_rank = np.cumsum(seen) - 1
        train = np.flatnonzero(trained)
        keys, inverse = np.unique(
            seen_rank[pair_rank[train]].astype(np.uint64) << np.uint64(NEIGHBOUR_BITS) | neighbour[train],
            return_inverse=True,
        )
        pair_counts = np.bincount(inverse, trained[train], len(keys))
        base = total + n_words + 1.0
        places = [m[8] for m in messages]
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(
                words[seen], counts[seen], (keys >> np.uint64(NEIGHBOUR_BITS)).astype(np.int64),
                keys & np.uint64((1 << NEIGHBOUR_BITS) - 1), pair_counts, base, folder,
            )
            logs = np.concatenate(
                [trie.numerators(words[pair_rank[i : i + (1 << 18)]], neighbour[i : i + (1 << 18)])
                 for i in range(0, len(pair_rank), 1 << 18)] or [np.zeros(0)]
            )
            del trie
        # a word is the context of what follows it, the end is not
        logs -= np.where(words[pair_rank] == END, 0.0, np.log10(counts[pair_rank] + MASS))
        base_logs = np.log10(counts + 1.0)
        payloads, at = [], 0
        for m, held in zip(messages, places, strict=True):
            ranks, weights = pair_rank[at : at + len(held)], logs[at : at + len(held)]
            at += len(held)
            docs, times = m[9].astype(np.int64), m[10].astype(np.float64)
            n = int(docs.max()) + 1 if len(docs) else 0
            present = np.flatnonzero(np.bincount(docs, minlength=n))
            sums = [
                np.bincount(docs, times * np.repeat(v, held), n)[present]
                for v in (base_logs[ranks], weights, (counts[ranks] > 0).astype(np.float64))
            ]
            payloads.append(_pack(present.astype(np.uint16), sums[0], sums[1], sums[2].astype(np.uint32)))
        return pa.table(
            {
                "block": pa.array(blocks, pa.int64()),
                "payload": pa.array(payloads, pa.binary()),
                "kind": pa.array([kind] * len(blocks), pa.int64()),
            }
        )

    return run


def _summed(table: pa.Table) -> pa.Table:
    """All rows of one block -> one row per document."""
    kinds = table["kind"].to_pylist()
    at = kinds.index(-1)
    ids, held_out, lengths = _unpack(table["payload"][at].as_py())
    base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    others = [_unpack(table["payload"][i].as_py()) for i in range(len(kinds)) if i != at]
    for docs, b, s, k in sorted(others, key=lambda m: m[1].tobytes()):  # sums do not depend on the order of arrival
        base[docs] += b
        score[docs] += s
        known[docs] += k
    return pa.table(
        {
            "doc_id": pa.array(ids.tolist(), pa.int64()), "held_out": pa.array(held_out, pa.bool_()),
            "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "base_sum": pa.array(base), "score_sum": pa.array(score),
        }
    )


def _words(texts: DataFrame) -> DataFrame:
    lower = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    return texts.select(F.explode(F.split(lower, r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")


def vocabulary_size(texts: DataFrame) -> int:
    """V: different tokens of all training documents, the end among them."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    train = texts.where(fold != HELD_OUT)
    words = _words(train).select(F.xxhash64("word").alias("word")).distinct().count()
    return words + (0 if train.isEmpty() else 1)


def routing_for(texts: DataFrame) -> Routing:
    """Number of shards from the bytes of all texts; frequent words from a sample of documents."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // BLOCK_BYTES))
    words = _words(texts.sample(SAMPLE, seed=11)).groupBy("word").count()
    total = words.agg(F.sum("count")).first()[0] or 0
    if not total:
        return Routing(shards, {})
    # at most 2 shards words have such a share
    found = words.where(F.col("count") * 2 * shards > total).collect()
    ways = {xxhash.xxh3_64_intdigest(r.word.encode()): min(shards, 1 + 2 * r["count"] * shards // total) for r in found}
    return Routing(shards, {h: int(n) for h, n in ways.items() if n > 1})


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs`.

    Tokens are the words of the whole text, A-Z lower-cased, and one end. Null and empty texts have
    the end only. Documents whose crc32(doc_id as text) mod 7 is 2 are held out of all counts. Rows
    that repeat a doc_id are separate documents of the same fold; a null id counts as the empty
    text in the fold. An empty table gives no rows; without training documents N and V are 0. Extra
    columns are not looked at. Words and neighbours are told apart by 64 and 40 bits of their hash.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    routing, n_words = routing_for(texts), vocabulary_size(texts)
    folder = shared_dir(spark, "ngram-model")
    # documents of a block go to a group of their own, all others to their shard
    messages = texts.mapInArrow(_blocks(routing), "kind int, block long, payload binary").withColumn(
        "group", F.when(F.col("kind") < 0, -1 - F.col("block") % routing.shards).otherwise(F.col("kind"))
    )
    messages.groupBy("group").applyInArrow(
        _answered(n_words), "block long, payload binary, kind long"
    ).write.parquet(f"{folder}/sums")
    sums = spark.read.parquet(f"{folder}/sums")
    rows = sums.groupBy("block").applyInArrow(
        _summed, "doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, score_sum double"
    )
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    whole = rows.agg(
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.lit(0)).alias("tokens"),
        F.count(F.when(~F.col("held_out"), 1)).alias("docs"),
    ).first()
    base = float(np.log10(whole.tokens + n_words + 1.0))
    start = float(np.log10(whole.docs + MASS))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(whole.tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * base).alias("base_score"),
        (F.col("score_sum") - start).alias("score"),
    )
