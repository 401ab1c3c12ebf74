"""Text repair and preview."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.functions import MOJIBAKE_RULES, repair_text


def repair_column(df: DataFrame, col: str,
                  rules: Iterable[tuple[str, str]] = MOJIBAKE_RULES) -> DataFrame:
    """Repair mis-decoded accents in ``col`` over the whole text."""
    return df.withColumn(col, repair_text(col, rules))


def preview_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; ordered by ``order_by`` when given so it is stable.

    With an order this is a top-k (each task keeps its best ``n``, one small merge),
    not a global sort.
    """
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.limit(n)
