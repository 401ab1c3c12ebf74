"""Aggregates kept up to date from a stream of new files, each file counted exactly once.

Sums and counts are mergeable: a batch of new files adds a small table of partial sums per
key, written under the batch's number. A batch that is repeated after a failure writes the
same number again and so replaces itself; the totals are the sum over all numbers. Means
and filters on totals are derived when the totals are read, so after every batch they equal
what the batch job computes from all files.

Below ``target``: ``batch=<n>/`` for each batch, ``base=<n>/`` what ``compact`` merged of all
batches up to ``n`` (a reader takes the last complete base and the batches after it).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, StructType

from propyield.operators.filters import having_positive
from propyield.operators.rents import parse_rents
from propyield.operators.sales import address_sales, join_geo, sum_lines
from propyield.operators.yields import sales_totals
from propyield.operators.filters import filter_kind, filter_labels, filter_present
from propyield.schemas import ADDRESS_KEYS, RENT_RENAMES, SALE_KIND, SALE_RENAMES, RegionSpec
from propyield.sources import fs
from propyield.streaming.ingest import each_batch_of_files

RENT_COLUMNS = ("rent_m2", "rent_low_m2", "rent_high_m2")


@dataclass(frozen=True)
class Sums:
    """What is summed (name -> column) under which keys."""

    keys: Sequence[str]
    sums: Mapping[str, Column]

    def partial(self, df: DataFrame) -> DataFrame:
        if all(n in df.columns for n in self.sums):  # sums already, of the batch's keys
            return self.merged(df)
        return df.groupBy(*self.keys).agg(*[F.sum(c).alias(n) for n, c in self.sums.items()])

    def merged(self, df: DataFrame) -> DataFrame:
        """Sums of sums, of the same types: a total fits where its parts do."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        return df.groupBy(*self.keys).agg(*[
            (F.sum(n).cast(kinds[n]) if isinstance(kinds[n], DecimalType) else F.sum(n)).alias(n) for n in self.sums])


def add_batch(partial: DataFrame, target: str, number: int) -> None:
    """Write a batch's partial sums; the same batch again replaces its own."""
    partial.write.mode("overwrite").parquet(f"{target}/batch={number:010d}")


def _numbered(spark: SparkSession, target: str, kind: str) -> dict[int, str]:
    found = fs.glob(spark, f"{fs.escaped(target)}/{kind}=*/_SUCCESS")
    return {int(f.rsplit("/", 2)[1].partition("=")[2]): f.rsplit("/", 1)[0] for f in found}


def totals(spark: SparkSession, target: str, what: Sums, schema: StructType) -> DataFrame:
    """The sums over all batches so far; no row for a key that no batch has.

    ``schema`` is that of the partial sums.
    """
    bases, batches = _numbered(spark, target, "base"), _numbered(spark, target, "batch")
    last = max(bases, default=-1)
    paths = [p for n, p in bases.items() if n == last] + [p for n, p in sorted(batches.items()) if n > last]
    if not paths:
        return spark.createDataFrame([], schema)
    return what.merged(spark.read.schema(schema).parquet(*paths))


def compact(spark: SparkSession, target: str, what: Sums, schema: StructType) -> int | None:
    """Merge all batches so far into one table; returns its number.

    What only bases before the last two held is deleted: a reader that has just listed the
    folder still finds its files.
    """
    batches, bases = _numbered(spark, target, "batch"), _numbered(spark, target, "base")
    newest = max(batches, default=-1)
    if newest <= max(bases, default=-1):
        return max(bases, default=None)
    totals(spark, target, what, schema).write.mode("overwrite").parquet(f"{target}/base={newest:010d}")
    previous = max(bases, default=-1)
    for n, path in [*[(n, p) for n, p in bases.items() if n < previous], *[(n, p) for n, p in batches.items() if n <= previous]]:
        fs.delete(spark, path)
    return newest


@dataclass(frozen=True)
class Kept:
    """A table kept up to date: how a batch is summed, and what the totals say."""

    what: Sums
    prepare: Callable[[DataFrame], DataFrame]
    derive: Callable[[DataFrame], DataFrame]

    def take_in(self, spark: SparkSession, folder: str, suffix: str, sep: str, target: str, rename: Mapping[str, str],
                file_year: str | None = None, max_files: int | None = None) -> StreamingQuery:
        """Count every file of ``folder`` that was not counted yet, and stop."""
        return each_batch_of_files(
            spark, folder, suffix, sep, f"{target}/checkpoint",
            lambda rows, number: add_batch(self.what.partial(self.prepare(rows)), f"{target}/sums", number),
            rename=rename, file_year=file_year, max_files=max_files)

    def now(self, spark: SparkSession, target: str, example: DataFrame) -> DataFrame:
        """The derived table as of the last batch; ``example`` has the columns of the input."""
        schema = self.what.partial(self.prepare(example)).schema
        return self.derive(totals(spark, f"{target}/sums", self.what, schema))


def rent_means_kept(keys: Sequence[str]) -> Kept:
    """Mean rents (A-1, A-2) per ``keys`` from sums and counts."""
    sums = {f"{c}_sum": F.col(c) for c in RENT_COLUMNS} | {f"{c}_n": F.col(c).isNotNull().cast("long") for c in RENT_COLUMNS}
    mean = lambda c: F.try_divide(F.col(f"{c}_sum").cast("double"), F.col(f"{c}_n")).alias(f"avg_{c}")
    return Kept(Sums(tuple(keys), sums), parse_rents, lambda t: t.select(*keys, *[mean(c) for c in RENT_COLUMNS]))


def address_sales_kept(geo: DataFrame, region: RegionSpec, kind: str = SALE_KIND) -> Kept:
    """Sales summed per address (A-3) with a built surface; ``sales_totals`` of it gives A-4
    and A-5. A batch joins the lookup as it is then."""
    lookup = filter_labels(geo, region.labels)

    def prepare(rows: DataFrame) -> DataFrame:
        return address_sales(join_geo(sum_lines(filter_present(filter_kind(rows, kind), "surface_txt")), lookup))

    sums = {"value_sum": F.col("value_sum"), "surface_sum": F.col("surface_sum")}
    return Kept(Sums(tuple(ADDRESS_KEYS), sums), prepare, lambda t: having_positive(t, "surface_sum"))


def keep_rent_means(spark: SparkSession, folder: str, target: str, keys: Sequence[str], max_files: int | None = None) -> DataFrame:
    """Take in the new yearly rent files of ``folder``; returns the mean rents as they are now."""
    kept = rent_means_kept(keys)
    kept.take_in(spark, folder, ".csv", ";", target, RENT_RENAMES, "year", max_files)
    return kept.now(spark, target, _empty(spark, [*RENT_RENAMES.values(), "year"]))


def keep_sales_totals(spark: SparkSession, folder: str, geo: DataFrame, region: RegionSpec, target: str,
                      keys: Sequence[str], max_files: int | None = None) -> DataFrame:
    """Take in the new sale files of ``folder``; returns total surface and value by ``keys``
    and year as they are now."""
    kept = address_sales_kept(geo, region)
    kept.take_in(spark, folder, ".txt", "|", target, SALE_RENAMES, max_files=max_files)
    return sales_totals(kept.now(spark, target, _empty(spark, list(SALE_RENAMES.values()))), list(keys))


def _empty(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
