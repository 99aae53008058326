"""File sources: image bytes, text files, listings, path checks.

Spark's ``binaryFile`` source skips hidden entries and zero-byte files, while
reading by path (what a converter does) returns both, and the reference's
listing skips hidden *files* but lists and descends hidden *directories*.  So
``list_files`` has its own lister, run inside Spark tasks (level by level, the
folders of a level in parallel), and ``read_files`` reads the listed paths inside
tasks.
"""

from __future__ import annotations

import posixpath
from functools import reduce
from typing import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwise.functions import paths
from boxwise.session import default_parallelism, materialize, ship_package
from boxwise.sources.fsutil import as_uri, resolve

LIST_SCHEMA = "path string, is_dir boolean, length long, mtime timestamp"


READ_BYTES = 64 << 20              # a batch of read files holds about this much


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "rel_path", "length", "content"]
    for pdf in batches:
        out, held = [], 0
        for path, rel in zip(pdf["path"], pdf["rel_path"]):
            fs, p = resolve(path)
            with fs.open_input_file(p) as f:
                data = f.read()
            out.append((path, rel, len(data), data))
            held += len(data)
            if held >= READ_BYTES:
                yield pd.DataFrame(out, columns=names)
                out, held = [], 0
        yield pd.DataFrame(out, columns=names)


def read_files(listing: DataFrame) -> DataFrame:
    """Bytes of every listed file, read inside the tasks in batches bounded by
    size: ``path, rel_path, length, content``.  Only paths are shuffled."""
    n = default_parallelism(listing.sparkSession)
    return listing.select("path", "rel_path").repartition(n, "path").mapInPandas(
        _reader, "path string, rel_path string, length long, content binary")


def read_into(df: DataFrame, path_col: str, content_col: str) -> DataFrame:
    """``df`` with ``content_col``, the bytes of the file each row names, read where the row
    is: dealt out first, rows pull their payload in and no shuffle carries it.  Batches
    are bounded by the bytes read."""
    from pyspark.sql import types as T
    schema = T.StructType([*df.schema.fields, T.StructField(content_col, T.BinaryType())])
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            paths, low, held = batch.column(path_col).to_pylist(), 0, []
            size = 0
            for i, path in enumerate(paths):
                fs, p = resolve(path)
                with fs.open_input_file(p) as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= READ_BYTES or i + 1 == len(paths):
                    part = batch.slice(low, i + 1 - low)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=schema.names)
                    low, held, size = i + 1, [], 0

    return df.mapInArrow(run, schema)


IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png")


def scan_images(spark: SparkSession, root: str, *, suffixes=IMAGE_SUFFIXES,
                recursive: bool = True) -> DataFrame:
    """``path, rel_path, length, content`` of image files under ``root``
    (listing rule of :func:`list_files`; empty files included)."""
    return read_files(list_files(spark, root, list_dir=False, suffix=tuple(suffixes), recursive=recursive))


def read_text_files(spark: SparkSession, root: str, *, encoding: str = "utf-8", recursive: bool = True,
                    suffix=None) -> DataFrame:
    """Whole-file text: ``path, rel_path, text`` decoded with ``encoding``."""
    lst = list_files(spark, root, list_dir=False, suffix=suffix, recursive=recursive)
    return read_files(lst).select("path", "rel_path", F.decode("content", encoding.upper()).alias("text"))


def _lister(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs
    for pdf in batches:
        for d in pdf["dir"]:
            fs, p = resolve(d)
            found = fs.get_file_info(pafs.FileSelector(p))        # a folder that is missing raises
            for low in range(0, max(len(found), 1), 10_000):
                rows = []
                for info in found[low:low + 10_000]:
                    is_dir = info.type == pafs.FileType.Directory
                    rows.append((as_uri(d, info.path), is_dir, None if is_dir else info.size,
                                 pd.Timestamp(info.mtime) if info.mtime is not None else None))
                yield pd.DataFrame(rows, columns=["path", "is_dir", "length", "mtime"])


def list_entries(spark: SparkSession, root: str, *, recursive: bool = True) -> DataFrame:
    """Every entry under ``root`` (hidden ones included): ``path, is_dir, length,
    mtime``.  Breadth first: the folders of a level are listed side by side, each
    once, and the level is stored, so a listing is read as often as needed but made
    once.  A missing ``root`` raises ``FileNotFoundError``."""
    if not isdir(spark, root):
        raise FileNotFoundError(f"no such folder to list: {root}")
    n = default_parallelism(spark)
    todo = spark.createDataFrame([(root,)], "dir string")
    levels = []
    while True:
        level = materialize(todo.mapInPandas(_lister, LIST_SCHEMA), "listing")
        levels.append(level)
        dirs = level.where("is_dir").select(F.col("path").alias("dir"))
        if not recursive or dirs.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        todo = dirs.repartition(n, "dir")


def list_files(spark: SparkSession, root: str, *, list_dir: bool = True, list_file: bool = True,
               suffix=None, recursive: bool = False) -> DataFrame:
    """Relative paths under ``root``: ``rel_path, is_dir, length, mtime``.

    Hidden files (name starts with ``.``) are skipped; directories are listed
    and, when ``recursive``, descended even if hidden.  ``suffix`` (str or
    tuple) filters files and must be None when directories are listed.
    """
    if list_dir and suffix is not None:
        raise TypeError("a suffix filters files only: list directories without one")
    if suffix is not None and not isinstance(suffix, (str, tuple)):
        raise TypeError(f"suffix: expected str or tuple of str, got {type(suffix).__name__}")
    e = list_entries(spark, root, recursive=recursive)
    rel = paths.relative_to(F.col("path"), _strip_scheme(root))
    e = e.withColumn("rel_path", rel)
    is_file = ~F.col("is_dir") & ~paths.basename(F.col("path")).startswith(".")
    if suffix is not None:
        is_file = is_file & paths.ends_with_any(F.col("rel_path"), suffix)
    cond = F.lit(False)
    if list_file:
        cond = cond | is_file
    if list_dir:
        cond = cond | F.col("is_dir")
    return e.where(cond).select("path", "rel_path", "is_dir", "length", "mtime")


def list_prefix(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Every object key under ``root/prefix`` (hidden ones too, directories
    skipped) relative to the prefix with leading slashes stripped."""
    base = posixpath.join(root, prefix) if prefix else root
    e = list_entries(spark, base, recursive=True).where(~F.col("is_dir") & ~F.col("path").endswith("/"))
    return e.select("path", paths.relative_to(F.col("path"), _strip_scheme(base)).alias("rel_path"), "length")


def _strip_scheme(p: str) -> str:
    if p.startswith("file://"):
        return p[len("file://"):]
    if p.startswith("file:"):
        return p[len("file:"):]
    return p


def _jfs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jfs(spark, path)
    return bool(fs.exists(p))


def isdir(spark: SparkSession, path: str) -> bool:
    fs, p = _jfs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def isfile(spark: SparkSession, path: str) -> bool:
    fs, p = _jfs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def path_check(spark: SparkSession, expected: dict[str, tuple[str, str]], *, raise_missing: bool = True) -> DataFrame:
    """Check named inputs ``name -> (path, 'dir'|'file')`` through the Hadoop
    filesystem (works for object stores); raise ``FileNotFoundError`` for the
    first missing one, or return the report."""
    rows = []
    for name, (path, kind) in expected.items():
        ok = isdir(spark, path) if kind == "dir" else isfile(spark, path)
        rows.append((name, path, kind, ok))
    if raise_missing:
        for name, path, kind, ok in rows:
            if not ok:
                raise FileNotFoundError(f"input {name!r}: no {'folder' if kind == 'dir' else 'file'} at {path}")
    return spark.createDataFrame(rows, "name string, path string, kind string, ok boolean")


def _plain(c):
    return F.regexp_replace(c, "^file:(//)?", "")


def attach_files(images: DataFrame, listing: DataFrame) -> DataFrame:
    """Image records (with a resolved ``path``) whose file is listed, with its ``length`` and its
    ``path`` as listed."""
    f = listing.select(_plain(F.col("path")).alias("_p"), F.col("path").alias("_listed"), "length")
    j = images.withColumn("_p", _plain(F.col("path"))).join(f.hint("merge"), "_p")
    return j.withColumn("path", F.col("_listed")).drop("_p", "_listed")


def attach_image_bytes(images: DataFrame, files: DataFrame) -> DataFrame:
    """Image records (with a resolved ``path``) with ``length`` and ``content`` of their file.
    ``files`` is a listing: records are joined to its paths and the bytes are read where the
    joined record is, so no shuffle carries them.  With a ``content`` column of its own it is
    joined as it is."""
    if "content" not in files.columns:
        named = attach_files(images, files).repartition(default_parallelism(images.sparkSession), "path")
        return read_into(named, "path", "content")
    f = files.select(_plain(F.col("path")).alias("_p"), "length", "content")
    return images.withColumn("_p", _plain(F.col("path"))).join(f, "_p").drop("_p")


def empty_or_missing_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """``file_name, issue``: expected files (``file_name, path``) that are
    absent from the listing (``path, length``), or present but empty."""
    e = expected.select("file_name", _plain(F.col("path")).alias("_p"))
    f = listing.select(_plain(F.col("path")).alias("_p"), "length")
    missing = e.join(f, "_p", "left_anti").select("file_name", F.lit("missing").alias("issue"))
    empty = e.join(f.where(F.col("length") == 0), "_p").select("file_name", F.lit("empty").alias("issue"))
    return missing.unionByName(empty)
