"""File sinks: delimited folders, one named delimited file, materialised tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propyield.sources import fs


def export_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
               mode: str = "overwrite", single_part: bool = False) -> None:
    """Write a folder of delimited part files (one per task).

    ``single_part`` asks for one part file; it is done with ``repartition(1)`` so
    everything upstream still runs in parallel and only the final write is one task.
    """
    out = df.repartition(1) if single_part else df
    (out.write.mode(mode)
     .options(header=header, sep=sep, ignoreLeadingWhiteSpace=False,
              ignoreTrailingWhiteSpace=False)
     .csv(path))


def export_named_csv(df: DataFrame, folder: str, file_name: str, sep: str = ";") -> str:
    """Write ``df`` as exactly one delimited file ``folder/file_name`` (replaced).

    One task writes it: meant for final tables with a row per place; anything that
    grows with the input belongs in ``export_csv``'s part folder. The part is written
    to a unique temp folder next to the target and moved with a Hadoop rename (any
    filesystem); an older file is put aside first and comes back if that fails.
    """
    spark = df.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp-{uuid.uuid4().hex}"
    target = f"{folder.rstrip('/')}/{file_name}"
    try:
        export_csv(df, f"{tmp}/new", sep=sep, single_part=True)
        parts = fs.glob(spark, f"{tmp}/new/part-*")
        if len(parts) != 1:
            raise OSError(f"expected one part file in {tmp}, found {len(parts)}")
        old = fs.exists(spark, target)
        if old:
            fs.rename(spark, target, f"{tmp}/old")
        try:
            fs.rename(spark, parts[0], target)
        except Exception:
            if old:
                fs.rename(spark, f"{tmp}/old", target)
            raise
    finally:
        fs.delete(spark, tmp)
    return target


def materialize_once(df: DataFrame, path: str, force: bool = False,
                     partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet at ``path`` unless a complete copy is there, then read it.

    Reading back cuts the lineage: later stages restart from these files, not from
    the sources, if an executor is lost. ``force`` rewrites (inputs changed).
    """
    spark = df.sparkSession
    if force or not fs.exists(spark, f"{path}/_SUCCESS"):
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.parquet(path)


def materialize_for(spark: SparkSession, build: Callable[[], DataFrame], path: str, key: str,
                    force: bool = False) -> DataFrame:
    """The parquet table at ``path`` made for ``key`` (a digest of inputs and parameters).

    A table made for another key is rebuilt; a marker file that names the key is
    written last, so a half-written table is never taken for a complete one.
    """
    marker = f"{path}/_made-for-{key}"
    if force or not fs.exists(spark, marker):
        fs.delete(spark, marker)
        build().write.mode("overwrite").parquet(path)
        fs.touch(spark, marker)
    return spark.read.parquet(path)
