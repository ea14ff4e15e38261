"""Equi-joins that survive hot keys.

A row-level join of a large table hashes all rows of one key to one task. `skew_join` looks for keys
with a large share in a sample of the left side, spreads only those over several tasks, and repeats
only their right-hand rows. The sample chooses the plan, never the result; its size does not depend on
the table, and its answer is kept for the same table and key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sample has a few hundred keys per shuffle partition, however large the table is.
SAMPLE_PER_PARTITION = 400
MIN_HITS = 10
# Rows of a left side that need no spreading.
SMALL_LEFT = 1_000_000
# Right-hand rows of one hot key that may be repeated; beyond it both sides of the key are split.
MOST_REPEATED = 100_000
# Cells of a key that is split on both sides, per piece that its left side alone would get: a cell holds few rows but
# makes many, and several small cells a task are more even than one large one.
CELLS = 4
# Pieces per average partition: several small pieces spread more evenly than one large piece.
PIECES = 4
INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_L, _R = "_salt_left", "_salt_right"

Key = str | tuple[str, str]


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Key | Sequence[Key],
    how: str = "inner",
    *,
    spread: Sequence[str] | None = None,
    null_safe: bool = False,
    keys_from: DataFrame | None = None,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Inner or left join of a large `left` to a `right`.

    `on` holds column names, or `(left, right)` pairs of differently named columns; a shared name
    comes out once. `spread` names left columns that tell the rows of one key apart (default: all
    columns but the key). A hot row goes to a piece by the hash of these columns and of the number of
    its partition, so that copies of one row are split as well. Neither changes if a task runs again
    after a lost executor, as a random number or a row position could. `keys_from` is a frame to sample
    instead of `left`: the table that brings the key, if `left` is itself a join. `hot` gives known hot
    keys, as `find_hot_keys` returns them.
    If the right side is below Spark's broadcast threshold there is nothing to spread, as it needs no
    shuffle; nor if the left side has so few rows that one task can have them all. A key that is hot on the right as
    well, so that more than MOST_REPEATED rows would be repeated, is split on both sides: its left rows into r pieces,
    its right rows into c, and each of the r x c cells joins one piece of either side. A left row is then sent
    c times and a right row r times, with r and c chosen so that both sides together are sent least.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    pairs = [(k, k) if isinstance(k, str) else k for k in ([on] if isinstance(on, (str, tuple)) else on)]
    lkeys, rkeys = [l for l, _ in pairs], [r for _, r in pairs]
    renamed = {r: f"_right_{r}" for l, r in pairs if l == r}
    right = right.withColumnsRenamed(renamed)
    rkeys = [renamed.get(r, r) for r in rkeys]
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides, rename or drop them first: {sorted(clash)}")

    def matches() -> Column:
        cond = F.lit(True)
        for l, r in zip(lkeys, rkeys):
            cond &= F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r)
        return cond

    lhash, rhash = _key_hashes(left, right, lkeys, rkeys)
    if hot is None:
        keyed = left if keys_from is None else keys_from
        idle = fits_broadcast(right) or few_rows(keyed)
        found = {} if idle else find_hot_keys(keyed, lhash)
        hot, grid = _one_sided(found, estimated_rows(keyed) if found else 0, right, rhash)
    else:
        grid = {}
    if grid:
        # All keys of a side whose hash is in the grid go this way, whatever they are.
        in_grid = [F.coalesce(h.isin(list(grid)), F.lit(False)) for h in (lhash, rhash)]
        cells = _grid_join(left.filter(in_grid[0]), right.filter(in_grid[1]), matches(), lhash, rhash, grid)
        if how == "left":
            keys = right.filter(in_grid[1]).select(*rkeys).distinct()
            alone = left.filter(in_grid[0]).join(keys, matches(), "left_anti")
            cells = cells.unionByName(alone.select("*", *(F.lit(None).cast(t).alias(c) for c, t in right.dtypes)))
        left, right = left.filter(~in_grid[0]), right.filter(~in_grid[1])
    if not hot:
        joined = left.join(right, matches(), how)
    else:
        if how == "inner" and not null_safe:
            # Stated here, since Spark does not push it below a partition number by itself.
            for k in lkeys:
                left = left.filter(F.col(k).isNotNull())
        by = list(spread) if spread else [c for c in left.columns if c not in lkeys]
        lways, rways = _ways(lhash, hot), _ways(rhash, hot)
        # The coalesce only tells the optimizer that a salt is never null.
        mixed = F.pmod(F.xxhash64(*by, F.spark_partition_id()), lways)
        piece = F.coalesce(mixed, F.lit(0)).cast("int")
        copies = F.when(rways > 1, F.sequence(F.lit(0), rways - 1)).otherwise(F.array(F.lit(0)))
        salted_left = left.withColumn(_L, F.when(lways > 1, piece).otherwise(F.lit(0)))
        salted_right = right.withColumn(_R, F.explode(copies))
        joined = salted_left.join(salted_right, matches() & (F.col(_L) == F.col(_R)), how).drop(_L, _R)
    if grid:
        joined = joined.unionByName(cells)
    return joined.drop(*renamed.values())


def merge_join(
    left: DataFrame, right: DataFrame, on: Key | Sequence[Key], columns: Sequence[str], **options
) -> DataFrame:
    """`skew_join`, then the named columns of the merged record; where both sides have a column, the
    right one wins."""
    pairs = [on] if isinstance(on, (str, tuple)) else on
    keys = {k if isinstance(k, str) else k[0] for k in pairs}
    beaten = [c for c in left.columns if c in right.columns and c not in keys]
    return skew_join(left.drop(*beaten), right, on, **options).select(*columns)


_FOUND: dict[tuple, dict[int, int]] = {}


def find_hot_keys(df: DataFrame, key_hash: Column, sample: float | None = None) -> dict[int, int]:
    """Hashes of keys that alone would make a shuffle partition at least twice the average one, and
    into how many pieces to split each.

    With P shuffle partitions a key counts as hot above a share of 1/P, so there are at most P. Null is
    a key like any other. Only the key column is read; the sample holds about SAMPLE_PER_PARTITION x P
    rows by Spark's own estimate of the table (or the share `sample`). The answer is kept per plan and
    key, so a table is looked at once in a session."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(key_hash.alias("h"))
    share = min(1.0, SAMPLE_PER_PARTITION * parts / max(estimated_rows(df), 1)) if sample is None else sample
    known = (spark.sparkContext.applicationId, keys.semanticHash(), parts, round(share, 12))
    if known not in _FOUND:
        top = (
            keys.sample(share, seed=11)
            .rollup("h")
            .agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("g"), F.desc("n"), "h")
            .limit(parts + 1)
            .collect()
        )
        total = next((row.n for row in top if row.g), 0)
        hits = [row for row in top if not row.g and row.n >= MIN_HITS and row.n * parts > total]
        # Powers of two, so that there are few different numbers of pieces.
        _FOUND[known] = {row.h: 1 << (PIECES * row.n * parts // total).bit_length() for row in hits}
    return dict(_FOUND[known])


def estimated_rows(df: DataFrame) -> int:
    """Rows by Spark's size estimate and the width of the columns; for scans the estimate comes from
    file sizes, so it costs no job. Compressed files hold more rows than that, and the sample is then
    larger, never smaller."""
    plan = df._jdf.queryExecution().optimizedPlan()
    width = sum(_WIDTHS.get(t, 16) for _, t in df.dtypes) + 8
    return int(str(plan.stats().sizeInBytes())) // width


# Spark's default sizes of the fixed-width types.
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "string": 20}
_WIDTHS |= {"bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def _one_sided(
    hot: dict[int, int], left_rows: int, right: DataFrame, right_hash: Column
) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """Pieces of the hot keys with few rows on the right, and (r, c) of the others."""
    if not hot:
        return {}, {}
    parts = int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = right.select(right_hash.alias("h"))
    held = {r.h: r["count"] for r in hashed.where(F.col("h").isin(list(hot))).groupBy("h").count().collect()}
    single, grid = {}, {}
    for key, ways in hot.items():
        many = held.get(key, 0)
        if ways * many <= MOST_REPEATED:
            single[key] = ways
        else:
            cells, few = ways * CELLS, max(1, left_rows * ways // (2 * PIECES * parts))
            columns = min(cells, 1 << max(0, round(math.log2(cells * many / few) / 2)))
            grid[key] = (cells // columns, columns)
    return single, grid


def _grid_join(
    left: DataFrame, right: DataFrame, matches: Column, lhash: Column, rhash: Column, grid: Mapping[int, tuple[int, int]]
) -> DataFrame:
    """Inner join in which each row meets every piece of the other side in a cell of its own."""
    rows, columns = ({h: size[k] for h, size in grid.items()} for k in (0, 1))

    def spread(df: DataFrame, key: Column, own: Mapping[int, int], other: Mapping[int, int], names: list[str]) -> DataFrame:
        piece = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns), F.spark_partition_id()), _ways(key, own))
        # the coalesce only tells the optimizer that a piece is never null
        marked = df.withColumn(names[0], F.coalesce(piece, F.lit(0)).cast("int"))
        return marked.withColumn(names[1], F.explode(F.sequence(F.lit(0), _ways(key, other) - 1)))

    lefts = spread(left, lhash, rows, columns, ["_left_row", "_left_column"])
    rights = spread(right, rhash, columns, rows, ["_right_column", "_right_row"])
    same_cell = (F.col("_left_row") == F.col("_right_row")) & (F.col("_left_column") == F.col("_right_column"))
    return lefts.join(rights, matches & same_cell).drop("_left_row", "_left_column", "_right_row", "_right_column")


def _ways(key_hash: Column, hot: Mapping[int, int]) -> Column:
    """Number of pieces for the key of a row; 1 unless it is hot."""
    cases = F
    for ways in sorted(set(hot.values()), reverse=True):
        cases = cases.when(key_hash.isin(*[h for h, w in hot.items() if w == ways]), F.lit(ways))
    return cases.otherwise(F.lit(1))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate is under its broadcast threshold."""
    limit = _broadcast_limit(df.sparkSession)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 0 <= size <= limit


def few_rows(df: DataFrame) -> bool:
    """Whether a table that is small by Spark's estimate really has few rows: files of one repeated key
    compress to almost nothing. Counts SMALL_LEFT rows at most, and only then."""
    return fits_broadcast(df) and df.limit(SMALL_LEFT + 1).count() <= SMALL_LEFT


def _broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _key_hashes(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]):
    """Hashes that are equal on both sides whenever the keys are. That needs keys of one type, or
    integers of any width: a text and a number may be equal and still hash differently."""
    ltypes, rtypes = dict(left.dtypes), dict(right.dtypes)
    lcols, rcols = [], []
    for l, r in zip(lkeys, rkeys):
        lcol, rcol = F.col(l), F.col(r)
        if ltypes[l] != rtypes[r]:
            if not {ltypes[l], rtypes[r]} <= INTEGERS:
                raise ValueError(f"cast the keys to one type first: {l} {ltypes[l]}, {r} {rtypes[r]}")
            lcol, rcol = lcol.cast("bigint"), rcol.cast("bigint")
        lcols.append(lcol)
        rcols.append(rcol)
    return F.xxhash64(*lcols), F.xxhash64(*rcols)
