"""Registered queries of the text operators, with SQL checks where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    divergence, exact_dedup, fingerprint, licenses, line_dedup, merkle, mixing, ngram_join, ngram_model, pieces,
    quality, toxicity, url_filter,
)

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(fn):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_URL_SQL = """
WITH rules(rhost, rpath, act) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0
  THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT row_number() OVER () AS rn, page_id,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
best AS (SELECT rn, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
  arg_max(act, length(rhost || rpath)) AS act
  FROM split JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(act, 'allow') AS verdict FROM split LEFT JOIN best USING (rn)
"""


@_register(_URL_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

_MIX_SQL = f"""
WITH sized AS (SELECT doc_id, source, {_WORDS_SQL}::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS digest FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap FROM sized GROUP BY source),
turns AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS turn FROM sums),
weighed AS (SELECT *, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
    CASE turn WHEN 0 THEN 7.5::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS w0,
    CASE turn WHEN 0 THEN -5.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS slope FROM turns),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE / sum(w) OVER after AS level
    FROM weighed WINDOW before AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goals AS (SELECT *, least(cap::DOUBLE, max(level) OVER () * w) AS target FROM levels),
placed AS (SELECT doc_id, size, source_size, target, w, w0, slope,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY digest, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
counted AS (SELECT *, CASE WHEN size > 0 AND target - start - size / 2 >= 0
    THEN least(floor((target - start - size / 2) / source_size) + 1, 3) ELSE 0 END::BIGINT AS copies FROM placed)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, size * copies AS taken,
    CASE WHEN copies > 0 THEN round(CASE WHEN start = 0 THEN 0.0 ELSE 2 * (start / target * w)
      / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * (start / target * w), 0))) END, 6) END AS first_position
FROM counted
"""


@_register(_MIX_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    mixed = mixing.assign(docs)
    return (
        mixed.withColumn("first_position", F.round(F.get("positions", F.lit(0)), 6))
        .select("doc_id", "size", "source_size", "target", "taken", "first_position")
        .repartitionByRange("first_position", "doc_id")
        .sortWithinPartitions("first_position", "doc_id")
    )


def _canonical_sql(text: str) -> str:
    plain = (
        f"trim(regexp_replace(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        f"'abcdefghijklmnopqrstuvwxyz'), '(^|\\n)[ \\t]*(?:copyright|\\(c\\)|©|all rights reserved)[^\\n]*', '\\1', 'g'), "
        "'[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F\\x{00A0}\\x{2010}-\\x{201F}]+', ' ', 'g'), ' ')"
    )
    padded = f"(' ' || replace({plain}, ' ', '  ') || ' ')"
    for variant, common in licenses.SPELLINGS:
        spaced = variant.replace(" ", "  ")
        padded = f"replace({padded}, ' {spaced} ', ' {common} ')"
    return f"sha256({padded})"


def _licence_sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in licenses.KNOWN)
    return f"""
WITH known(licence, known_text) AS (VALUES {quoted}),
keys AS (SELECT {_canonical_sql('known_text')} AS k, min(licence) AS licence FROM known GROUP BY 1),
units AS (SELECT doc_id, TRUE AS whole, text AS u FROM documents
  UNION ALL SELECT doc_id, FALSE, unnest(string_split(text, chr(10))) FROM documents),
found AS (SELECT doc_id, max(licence) FILTER (whole) AS text_licence,
  string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (NOT whole) AS notices
  FROM units JOIN keys ON {_canonical_sql('u')} = k GROUP BY doc_id)
SELECT doc_id, text_licence, notices FROM documents LEFT JOIN found USING (doc_id)
"""


@_register(_licence_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan(docs, licenses.known_licences(spark))


@_register()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_register()
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_register()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))


@_register()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_all(_table(spark, sf_dir, "documents", "doc_id", "text"), words=3, num=90, den=100)


@_register()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    rest = line_dedup.dedup(docs)
    return rest.select(
        "doc_id",
        "removed_lines",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@_register()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    encoded = pieces.encode(docs, keep=("doc_id", "text_sha256"))
    counted = encoded.withColumns(
        {"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(F.to_json("ids"), 256)}
    )
    return pieces.decoded(counted).select(
        "doc_id", "n_tokens", "ids_sha256", (F.sha2("text", 256) == F.col("text_sha256")).alias("round_trip")
    )


@_register()
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.score(_table(spark, sf_dir, "documents", "doc_id", "text"))


def _merkle_sql() -> str:
    """Levels are written out: seven for a lang, three above, enough for 2,097,152 rows of a lang and 512 langs."""
    low, high = 7, 3
    fields = " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in merkle.FIELDS[:-1]
    )
    text = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda ch: ord(ch)::BIGINT)), lambda c, b: xor(c >> 8, bits[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"
    )
    bit = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    steps = [
        f"crc_table AS (SELECT list(list_reduce(list_concat([n], range(8)), {bit}) ORDER BY n) AS bits FROM range(256) t(n))",
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({fields} || {text.format('text')}) AS leaf, "
        f"CASE WHEN {crc} % 3 = 0 THEN sha256({fields} || {text.format(lower)}) END AS changed FROM documents, crc_table)",
        "docs AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nr FROM leaves)",
        "l0 AS (SELECT tree, nr, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM docs)",
    ]

    def level(name: str, to: str) -> str:
        return (
            f"{to} AS (SELECT tree, nr // 8 AS nr, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY nr)) END AS h, "
            f"(max(n) + 7) // 8 AS n FROM {name} GROUP BY tree, nr // 8)"
        )

    def sides(name: str) -> str:
        run = "PARTITION BY tree, nr // 8 ORDER BY nr ROWS BETWEEN"
        return (
            f"{name}s AS (SELECT tree, nr, n > 1 AS used, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights FROM {name})"
        )

    for k in range(low):
        steps += [level(f"l{k}", f"l{k + 1}"), sides(f"l{k}")]
    steps.append(f"t0 AS (SELECT '^' AS tree, row_number() OVER (ORDER BY tree) - 1 AS nr, h, count(*) OVER () AS n, tree AS lang_tree FROM l{low})")
    for k in range(high):
        steps += [level(f"t{k}", f"t{k + 1}"), sides(f"t{k}")]
    steps.append(
        f"c0 AS (SELECT docs.*, l{low}.h AS subroot, t0.nr AS top_nr, t{high}.h AS root, coalesce(changed, leaf) AS acc, '' AS proof "
        f"FROM docs JOIN l{low} USING (tree) JOIN t0 ON lang_tree = docs.tree CROSS JOIN t{high})"
    )
    at = 0
    for name, nr, tree in [(f"l{k}s", f"c.nr // {8**k}", "c.tree") for k in range(low)] + [
        (f"t{k}s", f"c.top_nr // {8**k}", "'^'") for k in range(high)
    ]:
        steps.append(
            f"c{at + 1} AS (SELECT c.* REPLACE (CASE WHEN used THEN sha256(lefts || acc || rights) ELSE acc END AS acc, "
            f"CASE WHEN used THEN proof || lefts || rights ELSE proof END AS proof) "
            f"FROM c{at} c JOIN {name} s ON s.tree = {tree} AND s.nr = {nr})"
        )
        at += 1
    return "WITH " + ",\n".join(steps) + (
        "\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified "
        f"FROM c{at}"
    )


@_register(_merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents", *merkle.FIELDS))


_AUDIT_SQL = r"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms FROM documents),
numbered AS (SELECT *, row_number() OVER () AS rn FROM docs),
words AS (SELECT rn, lang, source, unnest(terms) AS term FROM numbered),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT rn) >= 10),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
full_cells AS (SELECT grp.lang, grp.source, term, lang_n, coalesce(n, 0) AS n
  FROM grp JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)),
shares AS (SELECT *, 1 + 1000000000 * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g)::BIGINT AS p,
    1 + 1000000000 * (lang_n + 2) // (sum(lang_n) OVER g + 2 * count(*) OVER g)::BIGINT AS q
  FROM full_cells WINDOW g AS (PARTITION BY lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
every AS (SELECT * FROM all_pairs UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@_register(_AUDIT_SQL)
def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents", "text", "lang", "source"))


_EXACT_SQL = r"""
WITH plain AS (SELECT doc_id, length(coalesce(text, '')) AS size,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
ordered AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST) AS nr,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size, nr = 1 AS kept, text_sha256 FROM ordered
"""


@_register(_EXACT_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(_table(spark, sf_dir, "documents", "doc_id", "text"))
