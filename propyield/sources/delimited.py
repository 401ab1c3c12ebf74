"""Delimited-text sources: single files, tolerant reads and folder ingest.

Columns are read as text under an explicit schema built from the file header, so
codes keep their leading zeros (``09000`` is not the number 9000). Numbers are parsed
later with ``try_`` casts, or by types inferred over all files together.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from propyield.functions import file_year_digits
from propyield.schemas import string_schema
from propyield.sources.headers import folder_reader, header_groups, in_folder
from propyield.sources.inference import infer_types


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by exact (case-sensitive) name; unlisted columns keep their name.

    Positional, so ``Code postal`` and ``Code Postal`` are told apart whatever
    ``spark.sql.caseSensitive`` says.
    """
    return df.toDF(*[mapping.get(c, c) for c in df.columns])


def _reader(spark: SparkSession, sep: str, encoding: str) -> DataFrameReader:
    return spark.read.options(header=True, sep=sep, encoding=encoding)


def read_header(spark: SparkSession, path: str, sep: str, encoding: str = "UTF-8") -> list[str]:
    """Column names of the header line of a file or of a folder's first file
    (Spark reads only that line)."""
    return _reader(spark, sep, encoding).option("inferSchema", False).csv(path).columns


def read_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str,
                   columns: Sequence[str] | None = None,
                   rename: Mapping[str, str] | None = None,
                   encoding: str = "UTF-8", infer: bool = False,
                   file_year: str | None = None) -> DataFrame:
    """Read header-bearing delimited files that share one header.

    ``columns`` is the expected header (read from the first file when omitted).
    ``enforceSchema=False`` makes Spark check every file's header against it, so a
    file with re-ordered columns fails instead of being read scrambled.
    ``infer=True`` gives each column the type that all its values share, codes with
    leading zeros staying text (one extra pass over the data, see ``infer_types``).
    ``file_year`` adds a text column holding the digits of each row's file name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    cols = list(columns) if columns is not None else read_header(spark, paths[0], sep, encoding)
    df = _reader(spark, sep, encoding).option("enforceSchema", False).schema(string_schema(cols)).csv(paths)
    if infer:
        df = infer_types(df)
    if file_year:
        df = df.withColumn(file_year, file_year_digits("_metadata.file_name"))
    return rename_columns(df, rename) if rename else df


def read_tolerant(spark: SparkSession, path: str, sep: str = "\t",
                  code_col: str = "code", encoding: str = "UTF-8") -> DataFrame:
    """Tolerant read: rows whose field count differs from the header are dropped.

    Column pruning is switched off for this scan so that ``count()``, a one-column
    select and a full collect all see the same rows.
    """
    cols = read_header(spark, path, sep, encoding)
    df = (_reader(spark, sep, encoding)
          .options(mode="DROPMALFORMED", columnPruning=False)
          .schema(string_schema(cols)).csv(path))
    return df.withColumn(code_col, F.col(code_col).cast("string"))


@dataclass(frozen=True)
class Scanned:
    """The rows of a tolerant scan and what it rejected."""

    good: DataFrame
    rejected: DataFrame  # file, line, reason


def scan_with_rejects(spark: SparkSession, path: str, out: str, sep: str = "\t",
                      encoding: str = "UTF-8") -> Scanned:
    """Tolerant read that keeps what it drops: every data line is a good row or a reject.

    One scan writes both tables below ``out`` (parquet). A line whose number of fields
    differs from the header's is rejected whole, with its file and the reason. Blank lines
    are no data lines.
    """
    cols = read_header(spark, path, sep, encoding)
    raw = f"_line_{uuid.uuid4().hex[:8]}"
    df = (_reader(spark, sep, encoding)
          .options(mode="PERMISSIVE", columnNameOfCorruptRecord=raw, columnPruning=False)
          .schema(string_schema([*cols, raw])).csv(path))
    # fields of the raw line, separators within quotes apart
    bare = F.regexp_replace(raw, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + len(sep)
    reason = (F.when(fields < len(cols) * len(sep), "too few fields").when(fields > len(cols) * len(sep), "too many fields")
              .otherwise("unreadable"))
    (df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("_metadata.file_path").alias("file"),
               F.col(raw).alias("line"), F.when(F.col(raw).isNotNull(), reason).alias("reason"), F.col(raw).isNull().cast("int").alias("ok"))
     .write.partitionBy("ok").parquet(out))
    both = spark.read.parquet(out)
    return Scanned(both.where("ok = 1").select("row.*"), both.where("ok = 0").select("file", "line", "reason"))


def ingest_folder(spark: SparkSession, folder: str, suffix: str, sep: str,
                  rename: Mapping[str, str] | None = None,
                  file_year: str | None = None, allow_missing: bool = False,
                  infer: bool = False, encoding: str = "UTF-8",
                  names: Sequence[str] | None = None, file_name: str | None = None) -> DataFrame:
    """All ``*<suffix>`` files (any case) directly in ``folder``, unioned by name.

    Files are grouped by header (one Spark job), each group is one parallel scan, and the
    groups are unioned by column name, so column order may differ between files.
    A column missing from some files is an error unless ``allow_missing``. ``names`` takes
    these files only (as ``_metadata.file_name`` has them), and ``file_name`` adds a column of
    that name with the row's one. ``infer`` gives each column the
    type that all files agree on (``infer_types``).
    """
    groups = header_groups(spark, folder, suffix, sep, encoding, names)
    if not groups:
        raise ValueError(f"no {suffix} file with a header line in folder {folder}")
    frames = []
    for group in groups:
        reader = folder_reader(spark, folder, suffix, header=True, sep=sep, encoding=encoding, enforceSchema=False)
        df = reader.schema(string_schema(group.columns)).csv(folder).where(in_folder(spark, folder))
        if len(groups) > 1:
            df = df.where(group.of_file(F.col("_metadata.file_name")))
        if names is not None:
            df = df.where(F.col("_metadata.file_name").isin(*names))
        if file_year:
            df = df.withColumn(file_year, file_year_digits("_metadata.file_name"))
        if file_name:
            df = df.withColumn(file_name, F.col("_metadata.file_name"))
        frames.append(rename_columns(df, rename) if rename else df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=allow_missing)
    return infer_types(out) if infer else out


def ingest_yearly_folder(spark: SparkSession, folder: str, rename: Mapping[str, str] | None = None,
                         year_col: str = "year", **kw) -> DataFrame:
    """``*.csv`` files with ``;``; the year column holds the digits of the file name."""
    return ingest_folder(spark, folder, ".csv", ";", rename=rename, file_year=year_col, **kw)


def ingest_pipe_folder(spark: SparkSession, folder: str,
                       rename: Mapping[str, str] | None = None, **kw) -> DataFrame:
    """``*.txt`` files separated by ``|``."""
    return ingest_folder(spark, folder, ".txt", "|", rename=rename, **kw)
