"""Exact duplicates by a tree merge of sorted digest runs.

Every partition of the input is a run: its rows reduced to one entry per digest, in digest order, with
the row that would stay and the number of rows. In each round the runs of `fan_in` neighbours become one:
entries travel to the task that owns their part of the digest order, are merged there, and the row
that stays of all is kept. So a run is never in one task, a round moves at most one entry per digest and run, and
copies shrink to one entry before they are moved. The last round's run holds every class. Its answers go
back the way they came, from a run to the runs it was merged from, down to the rows: a join never
meets more rows of one class than `fan_in` partitions hold of it.

Texts are equal when they are identical without the characters `[\\x20\\x09-\\x0D]`. Entries are merged only if
both the SHA-256 and the length of what is left agree. The row with the most code points in the
original text stays, then the least doc_id, then the first in table order.

Special rows: a null text counts as empty, and all texts without other characters are one class. A null
doc_id comes after all others; if no row of a class has one, `keep_id` is null, and `kept` still marks one
row. Repeated rows are rows of their own, one of which stays. An empty table gives no rows. Very long
texts are hashed where they are read and never moved by `classes`. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.session import shared_dir

BLANKS = " \t\n\x0b\x0c\r"
FAN_IN = 8


def classes(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    found = _classes(docs, F.struct(F.col("doc_id")), fan_in)
    return found.select("carried.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_one(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of `docs` that stay, with all their columns whatever these are called."""
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    return _classes(docs, whole, fan_in).where("kept").select("carried.*")


def _classes(docs: DataFrame, carried: Column, fan_in: int) -> DataFrame:
    spark = docs.sparkSession
    folder = shared_dir(spark, "exact-dedup")
    text = F.coalesce(F.col("text"), F.lit(""))
    left = F.translate(text, BLANKS, "")
    docs.select(
        carried.alias("carried"),
        F.col("doc_id").alias("id"),
        F.length(text).cast("long").alias("size"),
        left.alias("left"),
        F.spark_partition_id().cast("long").alias("run"),
        F.monotonically_increasing_id().alias("row"),
    ).select(
        "carried", "id", "size", "run", "row",
        F.unhex(F.sha2("left", 256)).alias("digest"), F.octet_length("left").alias("left_size"),
    ).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    # min() of this is the row that stays
    best = F.struct((-F.col("size")).alias("less"), F.col("id").isNull().alias("unnamed"), "id", "row")
    entries = rows.select("run", "digest", "left_size", best.alias("best"), F.lit(1).cast("long").alias("n"))
    width = (rows.agg(F.max("run")).first()[0] or 0) + 1
    rounds = []
    while not rounds or width > 1:
        merged = entries.groupBy(_into(fan_in).alias("run"), "digest", "left_size").agg(
            F.min("best").alias("best"), F.sum("n").alias("n")
        )
        path = f"{folder}/round-{len(rounds)}"
        merged.write.parquet(path)
        entries = spark.read.parquet(path)
        rounds.append(entries)
        width = -(-width // fan_in)

    answers = rounds.pop().where("n > 1")
    while rounds:
        answers = rounds.pop().select("run", "digest", "left_size").join(
            _from(answers, fan_in), [_into(fan_in) == F.col("from_run"), *_same()]
        ).select("run", "digest", "left_size", "best", "n")
    joined = rows.join(_from(answers, fan_in), [_into(fan_in) == F.col("from_run"), *_same()], "left")
    alone = F.col("best").isNull()
    return joined.select(
        "carried",
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _into(fan_in: int) -> Column:
    """The run that a run goes into."""
    return F.floor(F.col("run") / fan_in)


def _from(answers: DataFrame, fan_in: int) -> DataFrame:
    return answers.select(
        F.col("run").alias("from_run"), F.col("digest").alias("from_digest"),
        F.col("left_size").alias("from_size"), "best", "n",
    )


def _same() -> list[Column]:
    return [F.col("digest") == F.col("from_digest"), F.col("left_size") == F.col("from_size")]
