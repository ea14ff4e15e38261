"""How many similar sets every set of a component has, without a row per pair.

Two linked sets lie in one component, so only sets of a component meet, each two once. A set is
shipped as its differences to the component's least node: they tell two sets' distance,
|D(x)| + |D(y)| - 2 |D(x) & D(y)|, and are short where thousands of near copies make a component large.
The nodes of a component are dealt into blocks, two blocks meet in one cell, and a cell gives one row per node
with the weight of its partners there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # nodes of a component that meet as many others in one place
PAIRS = 1 << 22  # shared differences that are counted at once


def differences(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """(component, blocks, block, node, n, weight, diffs) from sets (node, shingles) and (node, component, weight)."""
    sized = placed.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    known = placed.join(sized, "component").join(sets, "node").select(
        "component", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        "node", "weight", "shingles", F.lit(1).alias("kind"),
    )
    # the least node's set goes to every block, in front of the others
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    hubs = sized.join(sets.withColumnRenamed("node", "component"), "component").select(
        "component", "blocks", every.alias("block"), F.col("component").alias("node"),
        F.lit(0).cast("long").alias("weight"), "shingles", F.lit(0).alias("kind"),
    )
    rows = known.unionByName(hubs).repartition("component", "block").sortWithinPartitions("component", "block", "kind")
    return rows.mapInArrow(_differ, "component long, blocks int, block int, node long, n long, weight long, diffs binary")


def others(differing: DataFrame, num: int, den: int) -> DataFrame:
    """(node, others): the weight of all nodes that a node is linked with."""
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (
        differing.withColumn("other", meets)
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "weight", "diffs")
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
    )
    return rows.mapInArrow(_counted(num, den), "node long, others long").groupBy("node").agg(F.sum("others").alias("others"))


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hub = np.zeros(0, np.uint64)
    for batch in batches:
        sizes, diffs, keep = [], [], []
        for at, (kind, shingles) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("shingles").to_pylist())):
            mine = np.frombuffer(shingles, np.uint64)
            if kind == 0:
                hub = mine
                continue
            both = np.concatenate([hub, mine])
            both.sort()
            same = both[1:] == both[:-1]
            alone = np.ones(len(both), bool)
            alone[1:] &= ~same
            alone[:-1] &= ~same
            keep.append(at)
            sizes.append(len(mine))
            diffs.append(both[alone].tobytes())
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in ("component", "blocks", "block", "node")), pa.array(sizes, pa.int64()), rows.column("weight"), pa.array(diffs, pa.binary())],
            names=["component", "blocks", "block", "node", "n", "weight", "diffs"],
        )


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one cell each; a cell may span batches."""
    held: list[pa.Table] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("component", "i", "j")])
        cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            here = tuple(keys[:, low])
            if held and here != key:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            key = here
            held.append(pa.Table.from_batches([batch.slice(low, high - low)]))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each array on the left has in common with each on the right."""
    size = len(left) * len(right)
    found = np.zeros(size, np.int32)
    values = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    common = np.intersect1d(np.unique(values[0]), np.unique(values[1]))
    if not len(common):
        return found.reshape(len(left), len(right))
    codes = []
    for k in (0, 1):
        code = np.searchsorted(common, values[k])
        hit = common[np.minimum(code, len(common) - 1)] == values[k]
        code, owner = code[hit], owners[k][hit]
        order = np.argsort(code, kind="stable")
        codes.append((code[order], owner[order], np.bincount(code, minlength=len(common))))
    (_, x, n_x), (_, y, n_y) = codes
    start_x, start_y = np.cumsum(n_x) - n_x, np.cumsum(n_y) - n_y
    # elements that most sets have are multiplied out as columns, the others are paired one by one
    heavy = n_x * n_y > size / 16
    for at in range(0, int(heavy.sum()), 1024):
        some = np.flatnonzero(heavy)[at : at + 1024]
        a, b = np.zeros((len(left), len(some)), np.float32), np.zeros((len(right), len(some)), np.float32)
        for column, code in enumerate(some):
            a[x[start_x[code] : start_x[code] + n_x[code]], column] = 1
            b[y[start_y[code] : start_y[code] + n_y[code]], column] = 1
        found += (a @ b.T).astype(np.int32).ravel()
    light = np.flatnonzero(~heavy)
    pairs = n_x[light] * n_y[light]
    splits = np.searchsorted(np.cumsum(pairs), np.arange(PAIRS, int(pairs.sum()) + PAIRS, PAIRS), side="right")
    for low, high in zip([0, *splits[:-1]], splits):
        some = light[low : max(high, low)]
        if not len(some):
            continue
        # every left owner of a code, as often as the code has right owners
        lefts = np.concatenate([np.arange(start_x[c], start_x[c] + n_x[c]) for c in some])
        times = np.repeat(n_y[some], n_x[some])
        first = np.repeat(np.repeat(start_y[some], n_x[some]), times)
        within = np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times)
        found += np.bincount(np.repeat(x[lefts], times) * len(right) + y[first + within], minlength=size).astype(np.int32)
    return found.reshape(len(left), len(right))


def _counted(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            block, i, j = (rows[c].to_numpy() for c in ("block", "i", "j"))
            node, n, weight = (rows[c].to_numpy() for c in ("node", "n", "weight"))
            diffs = [np.frombuffer(d, np.uint64) for d in rows["diffs"].to_pylist()]
            left = np.flatnonzero(block == i[0])
            right = left if i[0] == j[0] else np.flatnonzero(block == j[0])
            if not len(left) or not len(right):
                continue
            size = np.array([len(d) for d in diffs])
            shared = _shared([diffs[k] for k in left], [diffs[k] for k in right])
            apart = size[left][:, None] + size[right][None, :] - 2 * shared.astype(np.int64)
            linked = apart * (den + num) <= (n[left][:, None] + n[right][None, :]) * (den - num)
            if i[0] == j[0]:
                np.fill_diagonal(linked, False)
            sides = [(node[left], linked @ weight[right])]
            if i[0] != j[0]:
                sides.append((node[right], linked.T @ weight[left]))
            nodes, totals = (np.concatenate([s[k] for s in sides]) for k in (0, 1))
            some = totals > 0
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(totals[some].astype(np.int64))], names=["node", "others"])

    return run
