"""Mixing sources to target weights by a curriculum that changes over training time.

Every source has a weight schedule, linear between knots on training time 0 to 1. Its integral is
the source's share; shares are turned into token targets that no source may exceed `MOST` times its
size (the excess is dealt out again by weight). Within a source, documents stand in the order of a
digest of their id; document number i starts where the sizes before it end. Passes over a source
follow each other, and a copy is taken if its middle lies before the target. Its training position is
the time at which the source's integrated demand reaches its start.

Nothing is ordered in one task except one row per source: the running total inside a source is
built from BUCKETS digest ranges (totals first, then inside each range), which also splits a
source that holds a third of all rows. Texts are not moved at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.columns import word_count

MOST = 3  # copies of a document, and targets in terms of a source's size
BUCKET_BITS = 12  # 4096 digest ranges in each source
DIGEST_BITS = 60
# Fixed values of the registered mix: weights in turn, and how each source's weight moves over time
# (knots at time 0 and 1 as multiples of the weight; each pair has mean 1).
WEIGHTS = (5, 2, 1)
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def cycle_schedule(sources: DataFrame, weights=WEIGHTS, ramps=RAMPS) -> DataFrame:
    """(mix_source, knots) for a table of distinct sources: weights in turn by code point, null last."""
    order = Window.orderBy(F.col("mix_source").isNull(), "mix_source")
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    knots = [
        F.array(
            F.struct(F.lit(0.0).alias("t"), F.lit(float(w) * a).alias("w")),
            F.struct(F.lit(1.0).alias("t"), F.lit(float(w) * b).alias("w")),
        )
        for w, (a, b) in zip(weights, [ramps[i % len(ramps)] for i in range(len(weights))], strict=True)
    ]
    return sources.select("mix_source", F.element_at(F.array(*knots), turn.cast("int")).alias("knots"))


def _areas(knots: Column) -> Column:
    """Integral of the schedule from its first knot to each knot."""
    steps = F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda i: (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"])
        * (F.element_at(knots, i + 1)["w"] + F.element_at(knots, i)["w"])
        / 2,
    )
    return F.aggregate(
        steps,
        F.array(F.lit(0.0)),
        lambda done, step: F.concat(done, F.array(F.element_at(done, -1) + step)),
    )


def _when_reached(knots: Column, areas: Column, share: Column) -> Column:
    """Time at which `share` of the whole integral is reached: the segment, then its quadratic."""
    due = share * F.element_at(areas, -1)
    k = F.least(
        F.greatest(F.size(F.filter(areas, lambda a: a <= due)), F.lit(1)), F.size(areas) - 1
    )
    left, right = F.element_at(knots, k), F.element_at(knots, k + 1)
    slope = (right["w"] - left["w"]) / (right["t"] - left["t"])
    rest = due - F.element_at(areas, k)
    # rest = w x + slope x^2 / 2, solved without cancellation
    root = F.sqrt(F.greatest(left["w"] * left["w"] + 2 * slope * rest, F.lit(0.0)))
    return left["t"] + F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (left["w"] + root))


def targets(sizes: DataFrame, schedule: DataFrame) -> DataFrame:
    """One row per source with its target: `sizes` has mix_source and source_size.

    Sources sorted by the level at which they reach their cap: those before the best level are
    full, the others share what is left by weight. Works on one row per source.
    """
    w = _areas(F.col("knots"))
    ranked = sizes.join(schedule, F.col("mix_source").eqNullSafe(F.col("for_source")), "left").withColumns(
        {"areas": w, "weight": F.coalesce(F.element_at(w, -1), F.lit(0.0)), "cap": MOST * F.col("source_size")}
    )
    by_level = Window.orderBy(
        F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")), F.col("mix_source").isNull(), "mix_source"
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = F.when(F.sum("weight").over(after) > 0, left / F.sum("weight").over(after))
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn(
            "target", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.lit(0.0))
        )
        .select("mix_source", "source_size", "target", "knots", "areas")
    )


def order_digest(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text: the documents' order inside a source."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("long")


def assign(docs: DataFrame, schedule=cycle_schedule, row: Column | None = None) -> DataFrame:
    """Per document: doc_id, mix_source, size, source_size, target, copies, taken, positions.

    `schedule` makes (mix_source, knots) from the distinct sources. A null text has size 0; a null
    source is a source of its own; documents of size 0 take part with 0 words and no copies. Rows
    that repeat a doc_id are separate documents in neighbouring places (ties by size, so either
    order gives the same rows). An empty table gives no rows. Extra columns are not looked at.
    `row` is carried along as column `row`.
    """
    carried = ["row"] if row is not None else []
    sized = docs.select(
        "doc_id",
        F.col("source").alias("mix_source"),
        word_count(F.col("text")).alias("size"),
        *([row.alias("row")] if carried else []),
    ).withColumn("digest", order_digest(F.col("doc_id")))
    sized = sized.withColumns(
        {
            "place": F.shiftright("digest", DIGEST_BITS - BUCKET_BITS),
            "source_key": F.coalesce(F.concat(F.lit("s"), "mix_source"), F.lit("")),
        }
    )
    buckets = sized.groupBy("source_key", "mix_source", "place").agg(F.sum("size").alias("bucket_size"))
    sources = buckets.groupBy("mix_source").agg(F.sum("bucket_size").alias("source_size"))
    plan = targets(
        sources, schedule(sources.select("mix_source")).withColumnRenamed("mix_source", "for_source")
    )
    earlier = (
        Window.partitionBy("source_key").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
        .join(plan.withColumnRenamed("mix_source", "plan_source"), F.col("mix_source").eqNullSafe(F.col("plan_source")))
        .select("source_key", "place", "bucket_start", "source_size", "target", "knots", "areas")
    )
    inside = (
        Window.partitionBy("source_key", "place")
        .orderBy("digest", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.join(offsets, ["source_key", "place"]).withColumn(
        "start", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    # copy p spans [start + p source_size, + size); it is taken if its middle is before the target
    room = F.col("target") - F.col("start") - F.col("size") / 2
    copies = F.when(
        (F.col("size") > 0) & (room >= 0),
        F.least(F.floor(room / F.col("source_size")) + 1, F.lit(MOST)),
    ).otherwise(0)
    positions = F.transform(
        F.sequence(F.lit(0), F.col("copies").cast("int") - 1),
        lambda p: _when_reached(
            F.col("knots"), F.col("areas"), (F.col("start") + p * F.col("source_size")) / F.col("target")
        ),
    )
    return (
        placed.withColumn("copies", copies.cast("long"))
        .withColumn("positions", F.when(F.col("copies") > 0, positions).otherwise(F.array().cast("array<double>")))
        .select(
            "doc_id", "mix_source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"), "positions", "digest", *carried,
        )
    )


def arrange(docs: DataFrame, schedule=cycle_schedule) -> DataFrame:
    """The mix itself: rows of `docs`, once per taken copy, range-sorted by training position.

    The columns are those of `docs`. Documents without a copy are left out; nulls, repeated rows and
    empty tables are treated as in `assign`.
    """
    carried = F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    return (
        assign(docs, schedule, carried)
        .select(F.explode("positions").alias("position"), "digest", "row")
        .repartitionByRange("position", "digest")
        .sortWithinPartitions("position", "digest")
        .select("row.*")
    )
