"""File readers. Every reader is lazy except schema inference, which Spark does in its own pass."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import shared_dir
from tillwise.sources import arrays, records
from tillwise.sources.pieces import END, FILE, kept_columns, read_pieces

CORRUPT = "_corrupt_record"
# A CSV file of more splits than this is cut into records by many tasks, which pays on some tens of cores.
LARGE = 8
STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    *,
    header: bool = True,
    sep: str = ",",
    multi_line: bool = False,
    mode: str | None = None,
    split: bool | None = None,
) -> DataFrame:
    """CSV with inferred types, or with a declared schema applied **by position**.

    With a schema the header names are ignored, so a file whose header differs is renamed to the
    declared columns, and a row that does not fit fails the job (`mode="PERMISSIVE"` for nulls
    instead). If all columns are STRING, as in a raw load, an empty field is the empty text; with typed
    columns it is null. In such files a quote inside a quoted field is doubled, as warehouses load them; inferred
    files keep Spark's backslash. Quoted line breaks need `multi_line`. If a file is then larger than
    LARGE splits, or with `split`, all files are cut into records by many tasks first (`sources.records`; lines end
    with a line feed) and staged in the shared folder; without it Spark reads each file by one task.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("multiLine", multi_line)
    split = multi_line and (_has_large_file(spark, path) if split is None else split)
    if schema is None:
        if split:
            return _inferred_records(_csv_records(spark, path, sep, "\\", header), header, sep, mode or "PERMISSIVE")
        return reader.option("inferSchema", True).option("mode", mode or "PERMISSIVE").csv(path)
    if split:
        found = _csv_records(spark, path, sep, '"', header).filter(~F.col(records.HEADER))
        rows = records.parsed(found, schema, {"sep": sep, "escape": '"', "mode": mode or "FAILFAST"})
    else:
        declared = reader.schema(schema).option("enforceSchema", True).option("escape", '"')
        rows = declared.option("mode", mode or "FAILFAST").csv(path)
    fields = T.StructType.fromDDL(schema)
    raw = all(isinstance(field.dataType, T.StringType) for field in fields)
    return rows.na.fill("", subset=fields.names) if raw else rows


def _has_large_file(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a file is so large that cutting it up, some thirty times the work of one task that parses it as it
    comes, is still done sooner on a cluster."""
    limit = LARGE * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    listed = spark.read.format("binaryFile").load(path)
    if int(str(listed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit:
        return False
    return (listed.agg(F.max("length")).first()[0] or 0) > limit


def _csv_records(spark: SparkSession, path: str | list[str], sep: str, escape: str, header: bool) -> DataFrame:
    staged = shared_dir(spark, "csv-records")
    records.cut(read_pieces(spark.read, path, "\n"), sep, escape, header).write.parquet(staged)
    return records.records(spark.read.parquet(staged))


def _inferred_records(found: DataFrame, header: bool, sep: str, mode: str) -> DataFrame:
    """Records with the types that Spark infers from all of them, and the names of the first file's header."""
    spark = found.sparkSession
    rows = found.filter(~F.col(records.HEADER))
    reader = spark.read.option("sep", sep).option("inferSchema", True)
    types = [f.dataType.simpleString() for f in _from_strings(reader, "csv", rows.select("value")).schema]
    names = [f"_c{i}" for i in range(len(types))]
    if header:
        first = found.filter(F.col(records.HEADER)).orderBy(FILE).select("value").limit(1)
        names = list((_from_strings(spark.read.option("sep", sep), "csv", first).first() or [])) or names
    schema = ", ".join(f"`{(n or f'_c{i}').replace('`', '``')}` {t}" for i, (n, t) in enumerate(zip(names, types)))
    return records.parsed(rows, schema, {"sep": sep, "mode": mode})


def _from_strings(reader: DataFrameReader, kind: str, texts: DataFrame) -> DataFrame:
    """What Spark's reader makes of a frame of one text column."""
    strings = texts._jdf.__getattr__("as")(texts.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(getattr(reader._jreader, kind)(strings), texts.sparkSession)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    *,
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """JSON Lines, or one array per file with `multi_line`; declared or inferred schema.

    With a declared schema in permissive mode the text of a bad record is kept in
    `_corrupt_record`, so that bad input is visible instead of turning into rows of nulls.
    A multi-line file is parsed by one task: use `read_json_array` for large files of flat records.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", mode)
    if schema is None:
        return reader.json(path)
    declared = with_corrupt(schema) if mode == "PERMISSIVE" else T.StructType.fromDDL(schema)
    return reader.schema(declared).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: str | None, *, split: bool = True
) -> DataFrame:
    """Array files of objects, split over many tasks whatever their size; declared or inferred schema.

    The text source splits files at the closing brace, so in a file of flat objects every piece is one
    record. Null elements are skipped. Files with a brace inside a string, a nested object or an element that is
    no object are cut by a scan of their pieces instead (`sources.arrays`) and staged in the shared folder, so
    this reader looks at its input once before it returns. An element that is no object, is cut off by the
    end of the file or does not fit the schema arrives in `_corrupt_record` and takes no other with it. A missing
    quote or bracket turns the inside of strings out for the rest of a file; a file in which an element does not end
    where the scan ends it is read whole by one task, from object to object (it must fit into one text). Without
    `split` all files are read so.
    """
    if not split:
        if schema is None:
            raise ValueError("a schema is inferred from split files only")
        return parse_json(_whole_arrays(spark.read, path), schema)
    pieces = read_pieces(spark.read, path, "}")
    kept = kept_columns(pieces)
    # Spark's own list of the input files is on the driver as well; this is a part of it.
    odd = arrays.odd_files(pieces).collect()
    flat = pieces.select(*kept, arrays.flat_record(F.col("value")).alias("value"), FILE).filter(F.col("value") != "")
    if not odd:
        return _parsed_elements(flat.drop(FILE), schema)
    names = spark.createDataFrame(odd, f"{FILE} string, cut boolean")
    base = _base([path] if isinstance(path, str) else path)

    def some() -> DataFrameReader:
        return spark.read.option("basePath", base) if kept else spark.read

    staged = shared_dir(spark, "array-parts")
    arrays.cut(read_pieces(some(), [unquote(row[FILE]) for row in odd], "}"), names).write.parquet(staged)
    cut = arrays.elements(spark.read.parquet(staged))
    texts = [flat.join(F.broadcast(names), FILE, "left_anti").select(*kept, "value")]
    unsure = arrays.doubtful(F.col("value"))
    doubtful = cut.filter(unsure)
    if doubtful.isEmpty():
        texts.append(cut.select(*kept, "value"))
    else:
        torn = doubtful.select(FILE, "value", END).mapInArrow(_torn, f"{FILE} string").distinct().collect()
        torn_names = spark.createDataFrame(torn, f"{FILE} string")
        sure = cut.join(F.broadcast(torn_names), FILE, "left_anti")
        fields = T.StructType([*[cut.schema[c] for c in kept], T.StructField("value", T.StringType())])
        texts += [
            sure.filter(~unsure).select(*kept, "value"),
            sure.filter(unsure).select(*kept, "value").mapInArrow(_array_elements, fields),
        ]
        if torn:
            texts.append(_whole_arrays(some(), [unquote(row[FILE]) for row in torn]))
    return _parsed_elements(functools.reduce(DataFrame.unionByName, texts), schema)


def _parsed_elements(texts: DataFrame, schema: str | None) -> DataFrame:
    """Parsed elements. Without a schema Spark infers one: every task merges the types it meets, and the
    driver merges one type a task."""
    if schema is None:
        found = _from_strings(texts.sparkSession.read, "json", texts.select("value")).schema
        fields = [f for f in found if f.name != CORRUPT]
        if not fields:
            raise ValueError("no element that is an object to infer a schema from")
        schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    return parse_json(texts, schema)


def _whole_arrays(reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    """Elements of array files, one task each."""
    whole = reader.option("wholetext", True).text(path)
    kept = [c for c in whole.columns if c != "value"]
    fields = [*[whole.schema[c] for c in kept], T.StructField("value", T.StringType())]
    return whole.select(*kept, "value").mapInArrow(_array_elements, T.StructType(fields))


def _base(roots: list[str]) -> str:
    """Folder below which partition columns are read from the path."""
    return roots[0].split("*", 1)[0] if len(roots) == 1 else roots[0].rstrip("/").rsplit("/", 1)[0]


def _array_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per element of each text, which is an array; nulls are left out. What cannot be read as
    an element comes out up to the next comma."""
    for batch in batches:
        for row in range(batch.num_rows):
            found, _ = _walk(batch.column(batch.num_columns - 1)[row].as_py())
            others = [pa.array(batch.column(c)[row : row + 1].to_pylist() * len(found), batch.column(c).type) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found, pa.string())], names=batch.schema.names)


def _torn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with an element, not at the end of the file, behind which a reader from object to object would not
    go on where the scan does."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in range(3)))
        files = [file for file, text, end in rows if not end and not _walk(text)[1]]
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=[FILE])


def _walk(text: str) -> tuple[list[str], bool]:
    """Elements of an array, and if the last of them could be read."""
    decoder, blank = json.JSONDecoder(strict=False), re.compile(r"[\s,\[]*")
    text = text.strip().removeprefix("\ufeff").removesuffix("]")
    at, found, read = blank.match(text).end(), [], True
    while at < len(text):
        try:
            value, end = decoder.raw_decode(text, at)
            read = True
        except ValueError:
            value, end = "", text.find(",", at)
            read, end = False, len(text) if end < 0 else end
        if value is not None:
            found.append(text[at:end])
        at = blank.match(text, end).end() if end > at else end + 1
    return found, read


def parse_json(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Parse one JSON object per row; a malformed text, or one with a value of the wrong type, goes to
    `_corrupt_record`. Text after the object is ignored, see `parse_json_lines`."""
    options = {**STRICT_JSON, "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(column, with_corrupt(schema), options)
    others = [c for c in lines.columns if c != column]
    return lines.select(*others, once(parsed).alias("_parsed")).select(*others, "_parsed.*")


def parse_json_lines(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """As `parse_json` for fields that are all STRING, where text after the object is malformed too.

    Spark's parser stops behind the first object, so two records that share a line would lose the
    second. Each line is parsed as an array with an end mark behind it: whatever else is on the line
    breaks the array or moves the mark."""
    fields = T.StructType.fromDDL(schema)
    if not all(isinstance(field.dataType, T.StringType) for field in fields):
        raise ValueError("parse_json_lines takes STRING fields only; cast afterwards")
    marked = F.concat(F.lit("["), F.col(column), F.lit(',{"_end": ""}]'))
    parsed = F.from_json(marked, T.ArrayType(T.StructType([*fields, T.StructField("_end", T.StringType())])), STRICT_JSON)
    others = [c for c in lines.columns if c != column]
    staged = lines.select(*others, F.col(column).alias("_text"), parsed.alias("_parsed"))
    first, second = F.try_element_at("_parsed", F.lit(1)), F.try_element_at("_parsed", F.lit(2))
    whole = (F.size("_parsed") == 2) & first["_end"].isNull() & (second["_end"] == "")
    record = F.when(whole, first)
    judged = staged.select(*others, "_text", once(record).alias("_record"))
    return judged.select(
        *others,
        *[F.col("_record")[f.name].alias(f.name) for f in fields],
        F.when(F.col("_record").isNull(), F.coalesce("_text", F.lit(""))).alias(CORRUPT),
    )


def once(expensive: Column) -> Column:
    """A value that filters on it do not compute again: Spark copies the expressions of a projection
    into a filter above it, but not those of a generator."""
    return F.explode(F.array(expensive))


def with_corrupt(schema: str) -> T.StructType:
    return T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column `value`."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> DataFrame:
    """A Parquet folder or wildcard. Give `base_path` with a wildcard over a partitioned folder,
    or the partition column is lost."""
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def is_corrupt() -> Column:
    return F.col(CORRUPT).isNotNull()
