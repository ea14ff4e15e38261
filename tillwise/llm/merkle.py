"""Merkle manifest of a table, with a proof for every row found by pointer jumping.

Leaves are digests of rows. Per lang they ascend by doc_id, and every `fan` consecutive nodes are hashed into
one until one is left, the subroot; the subroots, in order of lang, are hashed in the same way into the root. All
nodes of a level are made by one grouping, `fan` rows a group.

A proof is the list of steps from a leaf to the root; a step holds the node's siblings to the left
and to the right. Every inner node starts with the step to its parent and a pointer to it. In each round a node
takes over the steps and the pointer of the node it points to, by a join of the table with itself, so
the distance doubles until every pointer has reached the root: a tree of 10^11 leaves takes four
rounds. The `fan` leaves under one node share all but their first step, so they travel as one row.

H is the lower-case hexadecimal SHA-256 of the inputs joined, digests among them as hexadecimal text.

Special rows: a null lang is a lang of its own, before all others; a null doc_id comes before others, and
its fold counts it as empty text; rows that repeat a doc_id are leaves of their own, in order of their digest. A
lone leaf of a lang is its subroot, and a lone subroot is the root. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import ascii_lower, fold
from tillwise.llm.places import number
from tillwise.session import shared_dir

FAN = 8
DIGEST = 32  # fixed value: bytes of a SHA-256
TOP = "^"  # the tree above the subroots; those of langs are "" for null and "=" and the lang for others
FEW = 4_000  # nodes pointed to that are sent to every task, at most 224 bytes x depth each
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """H of the fields, each `-` if null, else its number of UTF-8 bytes, `:` and its value."""
    parts = [field.cast("string") for field in fields]
    written = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*written), 256)


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered): the leaf of every row, and that of the row with A-Z of its text
    lower-cased where 3 divides the crc32 of its doc_id."""
    first = [F.col(name) for name in FIELDS[:-1]]
    text = F.when(fold(F.col("doc_id"), 3) == 0, ascii_lower(F.col("text")))
    changed = text.isNotNull() & (text != F.col("text"))
    leaf = leaf_digest(*first, F.col("text"))
    return docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(changed, leaf_digest(*first, text)).alias("tampered"))


def proofs(leaves: DataFrame, fan: int = FAN) -> DataFrame:
    """The rows of `leaves` (doc_id, lang, leaf and others) as column `row`, with subroot, root and steps.

    `leaf` is a digest in hexadecimal; a step is a struct (left, right) of joined binary digests."""
    spark = leaves.sparkSession
    folder = shared_dir(spark, "merkle")
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    named = leaves.select(
        tree.alias("tree"), "doc_id", F.unhex("leaf").alias("digest"), F.monotonically_increasing_id().alias("nr"),
        F.struct(*(F.col(f"`{c}`") for c in leaves.columns)).alias("row"),
    )
    named.write.parquet(f"{folder}/leaves")
    order = [F.col("doc_id"), F.col("digest"), F.col("nr")]
    placed = number(spark.read.parquet(f"{folder}/leaves"), "tree", order, f"{folder}/ordered")

    runs = _parents(placed, 1, fan, F.col("row"))
    runs.write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    levels = _climb(runs, 1, fan, f"{folder}/level")
    whole = [F.lit(TOP).alias("tree"), F.col("tree").alias("lang_tree"), "id", "digest"]
    subroots = _union([level.where("members = 1").select(*whole) for level in levels])
    top = number(subroots, "tree", [F.col("lang_tree")], f"{folder}/subroots")
    top_levels = _climb(top, 0, fan, f"{folder}/top")
    root = _union([level.where("members = 1").select("id", "digest") for level in top_levels]).first()
    if root is None:
        root_id, root_digest = F.lit(None).cast("string"), F.lit(None).cast("binary")
    else:
        root_id, root_digest = F.lit(root.id), F.lit(bytes(root.digest))

    inner = levels[1:] + top_levels[1:]
    final = _jump(inner, root_id, f"{folder}/jump") if inner else None
    if final is None:
        reached = runs.withColumns({"steps": F.array().cast(STEPS), "subroot": root_digest})
    else:
        final = final.select(F.col("id").alias("from_id"), "steps", "subroot")
        reached = runs.join(final, F.col("id") == F.col("from_id"), "left")
    parts = reached.select(
        F.posexplode("kids").alias("at", "kid"), "joined", "alone",
        F.coalesce("steps", F.array().cast(STEPS)).alias("steps"), F.coalesce("subroot", root_digest).alias("subroot"),
    )
    own = F.when(F.col("alone"), F.array().cast(STEPS)).otherwise(F.array(_step(F.col("joined"), F.col("at"))))
    return parts.select(
        F.col("kid.payload").alias("row"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(root_digest).alias("root"),
        F.concat(own, "steps").alias("steps"),
    )


def proof_digest(steps: Column) -> Column:
    """H of all siblings of a proof."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(
        steps, leaf, lambda below, s: F.sha2(F.concat(_hex(s["left"]), below, _hex(s["right"])), 256)
    )


def manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    found = proofs(tampered_leaves(docs), fan)
    checked = found.select(
        "row.doc_id", "row.leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.coalesce("row.tampered", "row.leaf"), F.col("steps")).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


STEPS = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _step(joined: Column, at: Column) -> Column:
    """Siblings of child number `at`, counted from 0."""
    return F.struct(
        F.substring(joined, F.lit(1), at * DIGEST).alias("left"),
        F.substring(joined, (at + 1) * DIGEST + 1, F.length(joined)).alias("right"),
    )


def _parents(nodes: DataFrame, level: int, fan: int, payload: Column) -> DataFrame:
    """Nodes over `nodes` (tree, place, members, digest), with their children in order. A lone leaf stands
    for itself: its node has its digest and is marked `alone`."""
    kid = F.struct("place", "digest", payload.alias("payload"))
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / fan).alias("up")).agg(
        F.collect_list(kid).alias("kids"), F.max("members").alias("below")
    )
    ordered = F.array_sort("kids", lambda a, b: (a["place"] - b["place"]).cast("int"))
    joined = F.aggregate(ordered, F.lit(b""), lambda all_, k: F.concat(all_, k["digest"]))
    made = grouped.withColumn("kids", ordered).withColumn("joined", joined).withColumn("alone", F.col("below") == 1)
    return made.select(
        "tree",
        F.col("up").alias("place"),
        F.ceil(F.col("below") / fan).alias("members"),
        F.concat(F.lit(f"{level}:"), F.col("up").cast("string"), F.lit(":"), "tree").alias("id"),
        F.when(F.col("alone"), F.col("joined")).otherwise(F.unhex(F.sha2(_hex(F.col("joined")), 256))).alias("digest"),
        "kids", "joined", "alone",
    )


def _climb(nodes: DataFrame, level: int, fan: int, path: str) -> list[DataFrame]:
    """`nodes` and the levels over them, until every tree has one node."""
    found = [nodes]
    while (found[-1].agg(F.max("members")).first()[0] or 0) > 1:
        level += 1
        _parents(found[-1].where("members > 1"), level, fan, F.col("id")).write.parquet(f"{path}-{level}")
        found.append(nodes.sparkSession.read.parquet(f"{path}-{level}"))
    return found


def _jump(levels: list[DataFrame], root_id: Column, path: str) -> DataFrame:
    """(id, pointer, steps, subroot) of all nodes below the root, every pointer at the root."""
    spark = levels[0].sparkSession
    kids = _union([level.select("tree", "id", "joined", F.posexplode("kids").alias("at", "kid")) for level in levels])
    jumps = kids.select(
        F.col("kid.payload").alias("id"),
        F.nullif(F.col("id"), root_id).alias("pointer"),
        F.array(_step(F.col("joined"), F.col("at"))).alias("steps"),
        F.when(F.col("tree") == TOP, F.col("kid.digest")).alias("subroot"),
    )
    for doubling in range((len(levels) - 1).bit_length()):
        jumps.write.parquet(f"{path}-{doubling}")
        jumps = spark.read.parquet(f"{path}-{doubling}")
        under = jumps.where("pointer is not null")
        aims = under.select("pointer").distinct()
        target = jumps.select(
            F.col("id").alias("target"), F.col("pointer").alias("next"),
            F.col("steps").alias("more"), F.col("subroot").alias("above"),
        ).join(aims.withColumnRenamed("pointer", "target"), "target", "left_semi")
        # fan^distance nodes point to one: with few of them the shuffle would be uneven
        if aims.count() <= FEW:
            target = F.broadcast(target)
        moved = under.join(target, F.col("pointer") == F.col("target")).select(
            "id", F.col("next").alias("pointer"), F.concat("steps", "more").alias("steps"),
            F.coalesce("subroot", "above").alias("subroot"),
        )
        jumps = jumps.where("pointer is null").unionByName(moved)
    return jumps


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
