"""Row filters and value remaps. All are plain predicates, so Catalyst pushes them
into the scan (``PushedFilters``) or through joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.functions import remap
from propyield.schemas import SALE_KIND


def filter_region(df: DataFrame, code: str, col: str = "reg") -> DataFrame:
    """Rows of one region code."""
    return df.where(F.col(col) == F.lit(code))


def filter_kind(df: DataFrame, kind: str = SALE_KIND, col: str = "kind") -> DataFrame:
    """Sales of one transaction kind (``Vente`` by default)."""
    return df.where(F.col(col) == F.lit(kind))


def filter_labels(df: DataFrame, labels: Iterable[str],
                  col: str = "region_label") -> DataFrame:
    """Rows whose label is one of ``labels``."""
    return df.where(F.col(col).isin(list(labels)))


def filter_present(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is neither null nor the empty string."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != F.lit("")))


def having_positive(df: DataFrame, col: str) -> DataFrame:
    """Post-aggregation filter: keep groups whose ``col`` is strictly positive."""
    return df.where(F.col(col) > F.lit(0))


def remap_column(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace listed values of ``col`` (e.g. region code ``73`` -> ``76``)."""
    return df.withColumn(col, remap(col, mapping))
