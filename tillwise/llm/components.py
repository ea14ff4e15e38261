"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD = 500_000  # nodes that a task joins at once


def _written(df: DataFrame, path: str) -> DataFrame:
    """A written table instead of a growing plan; it outlives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(least, node) of what the edges of a task connect; after HELD nodes it starts again, which loses no connection."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    def stars() -> pa.RecordBatch:
        found = [(root(x), x) for x in list(parent)]
        found = [(a, b) for a, b in found if a != b]
        columns = [pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > HELD:
            yield stars()
            parent.clear()
    yield stars()


def _joined(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, with the same components; what a task's edges connect is one star."""
    return edges.where("a <> b").mapInArrow(_forest, "a long, b long")


def _stars_only(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one. Edges may repeat."""
    ends = edges.select(F.col("b").alias("node"), F.col("a").alias("up"), F.lit(False).alias("down")).unionByName(
        edges.select(F.col("a").alias("node"), F.lit(None).cast("long").alias("up"), F.lit(True).alias("down"))
    )
    seen = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("down").alias("down"))
    return not seen.agg(F.bool_or(F.expr("low < high or (low is not null and down)"))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's least neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    joined = edges.join(least, "b")
    return (
        joined.select(F.col("least").alias("a"), "b")
        .unionByName(joined.select(F.col("least").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
    )


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node.

    Edges may repeat, point either way and be loops (which are ignored). No edges, no rows. Each
    step is written below `folder`; the driver sees one truth value per step. Edges are joined inside their tasks
    before they are shuffled.
    """
    step, now = 0, _written(_joined(edges.select("a", "b")), f"{folder}/step0")
    while not _stars_only(now):
        step += 1
        now = _written(_small_star(_large_star(_joined(now))), f"{folder}/step{step}")
    ends = now.select(F.col("b").alias("node"), "a").unionByName(now.select(F.col("a").alias("node"), "a"))
    return ends.groupBy("node").agg(F.min("a").alias("component"))
