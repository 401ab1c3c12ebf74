"""JDBC table sink (any database with a JDBC driver on the classpath)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               mode: str = "overwrite", batchsize: int = 10_000,
               num_partitions: int | None = None, truncate: bool = False) -> None:
    """Write ``df`` to ``table``; ``overwrite`` drops and recreates it unless
    ``truncate`` keeps the table definition.

    Credentials come from the caller's ``properties`` (user, password, driver);
    nothing is stored here. ``num_partitions`` caps concurrent connections, since
    each task opens one connection to the database.
    """
    writer = (df.write.mode(mode)
              .option("batchsize", str(batchsize))
              .option("truncate", "true" if truncate else "false"))
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.jdbc(url, table, properties=dict(properties))
