"""Header lines of all files of a folder, found by a Spark job.

The files are scanned as text lines with their path and block (``_metadata``). Lines behind
a file's first split are passed over as they are read; of the others, one aggregate in the
JVM keeps each file's first line that is not blank. No Python runs for it: a Python worker
that left a split early would cost a new worker for each, and the JVM reads the split to
its end all the same. The lines are grouped in Spark: one row a distinct header reaches the
driver, with the names of its files. The driver itself opens no file and makes no call for
one.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from propyield.sources import fs

#: Bytes of a split of the header scan: at least, and so that there are at most so many.
SPLIT_BYTES, SPLITS = 16 << 20, 4096


def any_case_glob(suffix: str) -> str:
    """A file-name pattern for a suffix in any case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


@dataclass(frozen=True)
class HeaderGroup:
    """The files of a folder that share one header line.

    ``names`` are file names as ``_metadata.file_name`` gives them; with ``others`` the group
    is every file but those.
    """

    columns: tuple[str, ...]
    names: tuple[str, ...]
    others: bool

    def of_file(self, name: Column) -> Column:
        known = name.isin(*self.names) if self.names else F.lit(False)
        return ~known if self.others else known


def names_of(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line (quotes as the CSV reader has them; a blank name
    becomes ``_c<i>``)."""
    names = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar='"'), [])
    return tuple(n if n else f"_c{i}" for i, n in enumerate(names))


def folder_reader(spark: SparkSession, folder: str, suffix: str, **options) -> DataFrameReader:
    """A reader of the ``*<suffix>`` files (any case) that lie in ``folder`` itself."""
    return spark.read.options(pathGlobFilter=any_case_glob(suffix),
                              recursiveFileLookup=str(fs.has_folders(spark, folder)).lower(), **options)


def file_parts(spark: SparkSession, folder: str, suffix: str, part: Callable[[Column], Column]) -> DataFrame:
    """part, key, names: the folder's files by ``part`` (a text of their name).

    ``key`` is a digest of the files' names, sizes and times. Listed and grouped by Spark; no
    file is opened.
    """
    files = folder_reader(spark, folder, suffix).format("binaryFile").load(folder).where(in_folder(spark, folder))
    said = F.concat_ws(":", "_metadata.file_name", "length", "modificationTime")
    return (files.select(part(F.col("_metadata.file_name")).alias("part"), F.col("_metadata.file_name").alias("name"), said.alias("said"))
            .groupBy("part").agg(F.sha1(F.array_join(F.sort_array(F.collect_list("said")), "\n")).alias("key"),
                                 F.sort_array(F.collect_list("name")).alias("names")))


def in_folder(spark: SparkSession, folder: str) -> Column:
    """Whether a row's file lies in ``folder`` itself, not in a sub-folder. The condition is
    on file metadata alone, so files that fail it are not opened."""
    if not fs.has_folders(spark, folder):
        return F.lit(True)
    inside = F.regexp_replace("_metadata.file_path", r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "")
    slashes = F.length(inside) - F.length(F.replace(inside, F.lit("/"), F.lit("")))
    return slashes == fs.depth(spark, folder) + 1


def first_lines(spark: SparkSession, folder: str, suffix: str, names: Sequence[str] | None = None) -> DataFrame:
    """file_name, line (binary): the first line of every ``*<suffix>`` file that is not blank."""
    # a session of its own: how this scan is split does not touch the caller's settings
    own = spark.newSession()
    split = max(SPLIT_BYTES, min(fs.folder_bytes(spark, folder) // SPLITS, 1 << 30))
    for key, value in (("spark.sql.files.maxPartitionBytes", split), ("spark.sql.files.openCostInBytes", 1 << 14),
                       ("spark.sql.files.minPartitionNum", 1)):
        own.conf.set(key, str(value))
    lines = folder_reader(own, folder, suffix).schema("value string").text(folder).where(in_folder(spark, folder))
    if names is not None:
        lines = lines.where(F.col("_metadata.file_name").isin(*names))
    # a file's first split lies in one task, where the numbers rise with the lines
    lines = lines.select("_metadata.file_name", "_metadata.file_block_start", "value", F.monotonically_increasing_id().alias("number"))
    return (lines.where((F.col("file_block_start") == 0) & F.col("value").rlike(r"[^\x20\x09-\x0D]"))
            .groupBy("file_name").agg(F.min_by(F.col("value").cast("binary"), "number").alias("line")))


def header_groups(spark: SparkSession, folder: str, suffix: str, sep: str, encoding: str = "UTF-8",
                  names: Sequence[str] | None = None) -> list[HeaderGroup]:
    """The distinct headers of the folder's files, in order of their first file's name.

    ``names`` asks for these files only. ``encoding`` must write line breaks and ``sep`` as
    ASCII does. Files without a line that is not blank belong to no group.
    """
    if not fs.exists(spark, folder):
        return []
    lines = first_lines(spark, folder, suffix, names).withColumn("line", F.decode("line", encoding))
    # a row a distinct line, with the names of its files
    found = {r["line"]: sorted(r["names"]) for r in lines.groupBy("line").agg(F.collect_list("file_name").alias("names")).collect()}
    if not found:
        return []
    most = max(found, key=lambda line: (len(found[line]), line))
    others = tuple(n for line, files in found.items() if line != most for n in files)
    ordered = sorted(found, key=lambda line: found[line][0])
    return [HeaderGroup(names_of(x, sep), others if x == most else tuple(found[x]), x == most) for x in ordered]
