"""Gross rental yield per department or city and year, long and year-pivoted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.functions import gross_yield, year_of
from propyield.operators.text import repair_column
from propyield.session import scratch_path


def with_sale_year(address: DataFrame) -> DataFrame:
    """Add the sale year (int, null for an unparsable date)."""
    return address.withColumn("year", year_of("date_txt"))


def sales_totals(address: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total built surface and total value per ``keys`` and sale year.

    ``address`` is the address-grain table; the year is derived here if absent.
    Partial aggregation collapses a hot key on the map side before the shuffle.
    """
    if "year" not in address.columns:
        address = with_sale_year(address)
    return (address.groupBy(*keys, "year")
            .agg(F.sum("surface_sum").alias("total_surface"),
                 F.sum("value_sum").alias("total_value")))


def yield_long(totals: DataFrame, rents: DataFrame, join_keys: Sequence[str],
               rent_keys: Sequence[str] = ()) -> DataFrame:
    """Join sale totals with mean rents on ``join_keys`` + year and compute the yield.

    ``rent_keys`` are extra descriptive columns taken from the rent side (the city
    name). Both sides are small aggregates; the planner and AQE pick the join.
    """
    keys = [*join_keys, "year"]
    r = rents.select(*rent_keys, *keys, "avg_rent_m2")
    return (totals.join(r, keys, "inner")
            .select(*rent_keys, *join_keys, "year",
                    gross_yield("avg_rent_m2", "total_surface", "total_value")
                    .alias("rental_yield")))


def gather_years(long: DataFrame, row_keys: Sequence[str], value: str = "rental_yield") -> DataFrame:
    """One row per ``row_keys`` with ``cells``, a map from year to value.

    One aggregate; a place holds at most one row a year upstream, so the lists are as
    long as there are years. Of several values of one cell the greatest counts, a null
    only if there is no other. Rows without a year add no cell.
    """
    pairs = F.sort_array(F.collect_set(F.when(
        F.col("year").isNotNull(), F.struct(F.col("year").cast("int").alias("year"), F.col(value).alias("value")))), asc=False)
    best = F.filter(pairs, lambda x, i: (i == 0) | (x["year"] != F.get(pairs, i - 1)["year"]))
    return long.groupBy(*row_keys).agg(F.map_from_entries(best).alias("cells"))


def years_of(gathered: DataFrame) -> list[int]:
    """The years of the cells, ascending: one row a year reaches the driver."""
    years = gathered.select(F.explode(F.map_keys("cells")).alias("year")).distinct()
    return sorted(r["year"] for r in years.collect())


def spread_years(gathered: DataFrame, row_keys: Sequence[str], years: Sequence[int]) -> DataFrame:
    """The cells of ``gather_years`` as one column for each of ``years``."""
    return gathered.select(*row_keys, *[F.try_element_at("cells", F.lit(y)).alias(str(y)) for y in years])


def pivot_years(long: DataFrame, row_keys: Sequence[str], value: str = "rental_yield",
                years: Sequence[int] | None = None) -> DataFrame:
    """One row per ``row_keys``, one column per year (ascending), cell = the value.

    With ``years`` given this is one aggregate and no job. Otherwise the years are those of
    the data: the gathered table (a row a place) is written once below the shared folder,
    and both the years and the result are read from it, so ``long`` is computed once.
    """
    gathered = gather_years(long, row_keys, value)
    if years is None:
        spark = long.sparkSession
        path = scratch_path(spark, "gathered")
        gathered.write.parquet(path)
        gathered = spark.read.schema(gathered.schema).parquet(path)
        years = years_of(gathered)
    return spread_years(gathered, row_keys, years)


def yield_by_dept_long(address: DataFrame, rent_dept: DataFrame) -> DataFrame:
    return yield_long(sales_totals(address, ["dep"]), rent_dept, ["dep"])


def yield_by_city_long(address: DataFrame, rent_city: DataFrame) -> DataFrame:
    return yield_long(sales_totals(address, ["insee"]), rent_city, ["insee"],
                      rent_keys=["city"])


def yield_by_dept(address: DataFrame, rent_dept: DataFrame) -> DataFrame:
    """Wide yield table: department x year."""
    return pivot_years(yield_by_dept_long(address, rent_dept), ["dep"])


def yield_by_city(address: DataFrame, rent_city: DataFrame, repair: bool = False) -> DataFrame:
    """Wide yield table: (city name, INSEE code) x year; ``repair`` mends damaged
    accents of the city name first, so spellings of one city share a row."""
    long = yield_by_city_long(address, rent_city)
    return pivot_years(repair_column(long, "city") if repair else long, ["city", "insee"])
