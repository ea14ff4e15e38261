"""Parquet folders.

Overwriting writes a hidden folder beside the output first and then lets the two change places, so a job
that fails leaves the old rows where they were. Between the two renames of the change the output is missing for a
moment; if the driver dies just then, the next write, or `restore_folder`, brings the old rows back. On
object stores, where a rename copies, write tables (`sinks.tables`) instead: they only move a pointer."""

from __future__ import annotations

import os
import posixpath
import re
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# Schemes that name the same store.
SAME_STORE = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "abfss": "abfs", "wasbs": "wasb"}


class UnsafeOutput(Exception):
    """Writing there would delete or mix with the input."""


def check_output(output: str, inputs: Iterable[str]) -> None:
    """Refuse an output folder that equals, contains or lies inside an input path.

    Overwriting a folder deletes it first, so such a job would lose its own input. Paths are compared
    as the file system sees them: relative ones from the working folder, without `..`, with blanks
    written either way, and with one name for each store."""
    outs = _spellings(output)
    for path in inputs:
        for source in _spellings(re.split(r"[*?{\[]", path, maxsplit=1)[0]):
            for out in outs:
                if out == source or source.startswith(out.rstrip("/") + "/") or out.startswith(source.rstrip("/") + "/"):
                    raise UnsafeOutput(f"output {output} overlaps input {path}")


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    inputs: Iterable[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a folder after checking it against `inputs` (default: the folders the plan reads). A failed
    overwrite leaves the old rows."""
    check_output(path, scan_roots(df) if inputs is None else inputs)
    if mode == "overwrite":
        overwrite_folder(df.sparkSession, path, df.write.parquet)
    else:
        df.write.mode(mode).parquet(path)


def overwrite_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Call `write` with a fresh folder beside `path` and put that in its place when it is complete."""
    restore_folder(spark, path)
    store, target = _located(spark, path)
    mark = uuid.uuid4().hex
    fresh, old = (_beside(spark, target, mark, part) for part in ("new", "old"))
    try:
        write(fresh.toString())
    except BaseException:
        store.delete(fresh, True)
        raise
    if store.exists(target):
        _rename(store, target, old)
        try:
            _rename(store, fresh, target)
        except BaseException:
            _rename(store, old, target)
            raise
        store.delete(old, True)
    else:
        _rename(store, fresh, target)


def restore_folder(spark: SparkSession, path: str) -> bool:
    """Put the old rows back if an overwrite was interrupted between its renames; says if that was so."""
    store, target = _located(spark, path)
    if store.exists(target) or not store.exists(target.getParent()):
        return False
    pattern = re.compile(rf"_{re.escape(target.getName())}-[0-9a-f]{{32}}\.old")
    left = [s for s in store.listStatus(target.getParent()) if pattern.fullmatch(s.getPath().getName())]
    if left:
        _rename(store, max(left, key=lambda s: s.getModificationTime()).getPath(), target)
    return bool(left)


def _located(spark: SparkSession, path: str):
    """File system and full path of a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") or "/")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(place)


def _beside(spark: SparkSession, target, mark: str, part: str):
    """A folder that readers of the parent folder skip, as its name begins with an underscore."""
    return spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{mark}.{part}")


def _rename(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def scan_roots(df: DataFrame) -> list[str]:
    """Root paths of the file scans of a plan: what the readers were given, not every file below."""
    roots: list[str] = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith(("LocalRelation", "LogicalRDD", "Range", "OneRowRelation", "ExternalRDD")):
            continue
        try:
            paths = leaf.relation().location().rootPaths()
        except Exception:  # another kind of scan: ask for its files
            return df.inputFiles()
        roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def _spellings(path: str) -> set[str]:
    return {_normal(path), _normal(unquote(path))}


def _normal(path: str) -> str:
    path = re.sub(r"^file:/*", "/", path)
    head, sep, tail = path.partition("://")
    if sep:
        return f"{SAME_STORE.get(head.lower(), head.lower())}://{posixpath.normpath(tail) if tail else ''}"
    spark = SparkSession.getActiveSession()
    if spark is not None:
        default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString()
        if not default.startswith("file:"):  # a path without a scheme lies in the cluster's own store
            home = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
            whole = path if path.startswith("/") else f"{home.getWorkingDirectory().toUri().getPath()}/{path}"
            return _normal(default.rstrip("/") + posixpath.normpath(whole))
    return os.path.realpath(path)
