"""The corpus pipeline: quality rules, line dedup, near duplicates, source mix, token ids.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it is written as Parquet
and read again as the next stage's `docs`. All stages but the last return the columns of documents.

What becomes of special rows, stage by stage: null and blank texts go with the quality rules. Rows that
repeat a doc_id with one text are one document from the third stage on; with different texts they
are different documents. Rows with a null doc_id pass the second and third stage as they are, for
nothing can name them; they still link others in the third. Extra columns are carried along to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import line_dedup, mixing, ngram_join, pieces, quality
from tillwise.llm.columns import WORD, free_name
from tillwise.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that an earlier one has; those left without a word go."""
    rest = line_dedup.dedup(docs).where((F.col("removed_lines") == 0) | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        changed = F.col("removed_lines") > 0
        rest = rest.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rest.select(*(f"`{c}`" for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the one with the least id."""
    links = ngram_join.link(docs)
    stay_id, digest = free_name(docs, "stay_id"), free_name(docs, "stay_digest")
    stay = links.where("doc_id = component_id").select(F.col("doc_id").alias(stay_id)).distinct()
    named = docs.where("doc_id is not null").join(stay, F.col("doc_id") == F.col(stay_id), "left_semi")
    marked = named.withColumn(digest, F.sha2(F.concat(F.col("text").isNull().cast("string"), F.coalesce("text", F.lit(""))), 256))
    once = marked.dropDuplicates(["doc_id", digest]).drop(digest)
    return once.unionByName(docs.where("doc_id is null"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixing.arrange(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every document."""
    encoded = pieces.encode(docs, keep=("doc_id", "source"))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", without_shared_lines),
    ("ngram_join", one_of_each_group),
    ("mixing", source_mix),
    ("sentencepiece", token_ids),
]

# Compression ratios and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what each hands on is below the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
