"""Rent estimates: parse and average per department or city and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.functions import decimal_comma, exact_mean
from propyield.schemas import RENT

DEPT_KEYS = ["dep", "year"]
CITY_KEYS = ["city", "insee", "year"]


def parse_rents(df: DataFrame) -> DataFrame:
    """Rent per m2 (point estimate and interval bounds) as exact decimals; the year
    taken from the file name becomes an int."""
    return df.withColumns({
        "rent_m2": decimal_comma("rent_txt", RENT),
        "rent_low_m2": decimal_comma("low_txt", RENT),
        "rent_high_m2": decimal_comma("high_txt", RENT),
        "year": F.col("year").try_cast("int"),
    })


def rent_means(df: DataFrame, keys: list[str]) -> DataFrame:
    """Unweighted mean of the three rent columns per ``keys`` (doubles).

    ``df`` is the renamed rent table (text columns); parsing happens here.
    """
    return (parse_rents(df)
            .groupBy(*keys)
            .agg(exact_mean("rent_m2").alias("avg_rent_m2"),
                 exact_mean("rent_low_m2").alias("avg_rent_low_m2"),
                 exact_mean("rent_high_m2").alias("avg_rent_high_m2")))


def rent_by_dept(df: DataFrame) -> DataFrame:
    return rent_means(df, DEPT_KEYS)


def rent_by_city(df: DataFrame) -> DataFrame:
    return rent_means(df, CITY_KEYS)
