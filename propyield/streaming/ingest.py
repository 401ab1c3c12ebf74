"""Incremental folder ingest with Structured Streaming.

The batch job re-reads a whole input folder; when yearly files keep arriving, the
file stream source ingests only files it has not seen. The progress checkpoint
lives in the shared folder, so a restarted job (or a lost executor) resumes with
exactly-once output. Run it with ``trigger(availableNow=True)`` from a scheduler:
it processes what is there and stops.

``stream_folder`` reads one header layout (the file source has one schema); files with
re-ordered columns fail the header check instead of being read scrambled.
``ingest_any_layout`` streams the names of new files and ingests each batch of them by
name, as the batch ingest does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from propyield.functions import file_year_digits
from propyield.schemas import string_schema
from propyield.sources.delimited import ingest_folder, read_header, rename_columns
from propyield.sources.fs import escaped, list_files
from propyield.sources.headers import any_case_glob


def stream_folder(spark: SparkSession, folder: str, suffix: str, sep: str,
                  header: list[str] | None = None,
                  rename: Mapping[str, str] | None = None,
                  file_year: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the ``*<suffix>`` files of ``folder`` (all text)."""
    if header is None:
        files = list_files(spark, folder, suffix)
        if not files:
            raise ValueError(f"no {suffix} file in folder {folder}")
        header = read_header(spark, escaped(files[0]), sep)
    reader = (spark.readStream.schema(string_schema(header))
              .options(header=True, sep=sep, enforceSchema=False,
                       pathGlobFilter=any_case_glob(suffix)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(folder)
    if file_year:
        df = df.withColumn(file_year, file_year_digits("_metadata.file_name"))
    return rename_columns(df, rename) if rename else df


def ingest_available(stream: DataFrame, target: str, checkpoint: str,
                     partition_by: list[str] | None = None) -> StreamingQuery:
    """Append every not-yet-ingested file to the parquet table ``target`` and stop."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(target)
    query.awaitTermination()
    return query


def each_batch_of_files(spark: SparkSession, folder: str, suffix: str, sep: str, checkpoint: str,
                        handle: Callable[[DataFrame, int], None], rename: Mapping[str, str] | None = None,
                        file_year: str | None = None, allow_missing: bool = False,
                        max_files: int | None = None) -> StreamingQuery:
    """Call ``handle(rows, batch number)`` for every batch of not-yet-seen files, and stop.

    The stream carries file names only; a batch's files are read by name, whatever the
    order of their columns. After a failure the last batch comes again with its number, so
    a handler that replaces what it wrote under a number counts every file exactly once.
    """
    names = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", any_case_glob(suffix)))
    if max_files:
        names = names.option("maxFilesPerTrigger", max_files)

    def batch_of(batch: DataFrame, number: int) -> None:
        files = sorted({r["file_name"] for r in batch.collect()})  # the names of one batch's new files
        if files:
            handle(ingest_folder(batch.sparkSession, folder, suffix, sep, rename, file_year, allow_missing, names=files), number)

    query = (names.load(folder).select("_metadata.file_name").writeStream.foreachBatch(batch_of)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def ingest_any_layout(spark: SparkSession, folder: str, suffix: str, sep: str, target: str,
                      checkpoint: str, rename: Mapping[str, str] | None = None,
                      file_year: str | None = None, allow_missing: bool = False) -> StreamingQuery:
    """Append every not-yet-ingested file, whatever the order of its columns, and stop.

    Each batch of files goes to a folder of its own below ``target`` (``batch=<n>``), which a
    repeated batch replaces, so a restart after a failure leaves every file's rows exactly once.
    """
    return each_batch_of_files(
        spark, folder, suffix, sep, checkpoint,
        lambda rows, number: rows.write.mode("overwrite").parquet(f"{target}/batch={number}"),
        rename, file_year, allow_missing)
