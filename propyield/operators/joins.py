"""Equi-join of a large table with a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_lookup(big: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with ``lookup`` on equal keys.

    The planner broadcasts the lookup when its estimated bytes stay below
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled, AQE
    splits a hot key's partition, and it may still switch to a broadcast once it has
    measured the real shuffle size. Building the plan runs no job.
    """
    return big.join(lookup, on, how)
