"""URL filter: host-suffix and path-prefix expressions, short-hash join, digest check, precedence.

Each URL is expanded into the expressions that a rule could have been written for: every suffix of
its host by labels, with every prefix of its path that ends in a slash. Expressions meet the rules on
the first 32 bits of their SHA-256; equal full digests confirm. The longest rule wins.

The depth of the expansion comes from the rules (most labels, most slashes), so it is bounded by the
rule table, whatever the URLs look like, and no rule can be missed. Equal (host, path) pairs are
expanded once, so a hot host costs no more than its distinct paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.columns import ascii_lower, free_name

SHORT = 8  # hex digits of the join key: 32 bits


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or no `://`."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with digests; of equal rules `block` beats `allow`.

    A path must be empty or end in a slash (only such prefixes are expanded); other rules fail the job.
    """
    rule = F.concat(ascii_lower(F.col("host")), F.col("path"))
    checked = F.when((F.col("path") == "") | F.col("path").endswith("/"), rule).otherwise(
        F.raise_error(F.concat(F.lit("rule path does not end in a slash: "), rule)).cast("string")
    )
    return (
        rules.select(checked.alias("rule"), F.col("action").alias("rule_action"))
        .where("rule is not null")
        .groupBy("rule")
        .agg(F.max("rule_action").alias("rule_action"))
        .withColumn("rule_digest", _digest(F.col("rule")))
        .withColumn("short", F.substring("rule_digest", 1, SHORT))
    )


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """All host suffixes of at most `labels` labels, each with all path prefixes of at most
    `slashes` slashes and with the empty prefix."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    n = F.size(parts)
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), n - labels + 1), n),
        lambda i: F.array_join(F.slice(parts, i, n), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(slashes))),
        lambda j: F.when(j == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(steps, F.lit(1), j), "/"), F.lit("/"))
        ),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of `urls` with host, path, rule and verdict added.

    Null URLs and URLs without `://` have empty host and path and get the default; so does every URL
    without a fitting rule, or under an empty rule table. Repeated rows stay repeated. Columns of
    `urls` that bear one of the added names are replaced. Ties cannot occur: two different rules that
    fit one URL differ in length or in where the host ends, and then the longer host wins.
    """
    ready = prepared_rules(rules)
    host_part = F.substring_index("rule", "/", 1)
    depth = ready.agg(
        F.max(F.size(F.split(host_part, r"\."))).alias("labels"),
        F.max(F.length("rule") - F.length(F.translate("rule", "/", ""))).alias("slashes"),
    ).first()
    base = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop(
        "rule", "verdict"
    )
    found = (
        base.select(F.col("host").alias("found_host"), F.col("path").alias("found_path"))
        .distinct()
        .withColumn(
            "expression",
            F.explode(expressions(F.col("found_host"), F.col("found_path"), depth.labels or 1, depth.slashes or 0)),
        )
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("short", F.substring("digest", 1, SHORT))
        .join(ready, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("found_host", "found_path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule"), F.length(host_part).alias("host_length"), "rule", "rule_action"
                )
            ).alias("best")
        )
    )
    names = {name: free_name(base, name) for name in ("found_host", "found_path", "best")}
    host, path, best = names.values()
    return (
        base.join(
            found.withColumnsRenamed(names), (F.col("host") == F.col(host)) & (F.col("path") == F.col(path)), "left"
        )
        .withColumns(
            {
                "rule": F.col(f"{best}.rule"),
                "verdict": F.coalesce(F.col(f"{best}.rule_action"), F.lit(default)),
            }
        )
        .drop(host, path, best)
    )
