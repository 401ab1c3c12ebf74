"""The whole property-yield job as one set of Spark stages.

Inputs are folders of files in the layout of the public open-data sources; every
stage boundary that several outputs share is written once as parquet below
``out_dir`` and read back, so a lost executor restarts from those files rather than
from the raw text. A stage is reused on a re-run only when it was made from the same
input files (name, bytes, time) with the same parameters; the two ingests are reused by
groups of files, so a new yearly file is read alone. The outputs of a run are
published together (``sinks.publish``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propyield.functions import file_year_digits
from propyield.operators import (
    clean_sales,
    filter_region,
    pivot_years,
    remap_column,
    rent_by_city,
    rent_by_dept,
    with_sale_year,
    yield_by_city_long,
    yield_by_dept_long,
)
from propyield.schemas import GEO_RENAMES, RENT_RENAMES, SALE_RENAMES, RegionSpec
from propyield.sinks import PART, Run, export_csv, export_named_csv, write_jdbc
from propyield.sources import (
    file_parts,
    ingest_pipe_folder,
    ingest_yearly_folder,
    read_delimited,
    rename_columns,
)
from propyield.sources.workbooks import DEFAULT_SHEET, read_workbooks


@dataclass(frozen=True)
class Inputs:
    rent_folder: str   # yearly ';' CSV files, year in the file name
    sale_folder: str   # '|' separated .txt files
    geo_path: str      # TAB separated postal-code / commune lookup


@dataclass(frozen=True)
class JdbcTarget:
    """A database; its tables are replaced. Credentials stay with the caller."""

    url: str
    properties: Mapping[str, str]

    def write(self, df: DataFrame, table: str) -> None:
        write_jdbc(df, self.url, table, self.properties)


def remap_lookup(spark: SparkSession, geo_path: str, out_path: str,
                 mapping: Mapping[str, str]) -> DataFrame:
    """C-6: rewrite the lookup with region codes remapped (TSV folder)."""
    geo = read_delimited(spark, geo_path, "\t", rename=GEO_RENAMES)
    remapped = remap_column(geo, "region_code", mapping)
    export_csv(rename_columns(remapped, {v: k for k, v in GEO_RENAMES.items()}),
               out_path, sep="\t")
    return remapped


def workbook_to_jdbc(spark: SparkSession, folder: str, target: JdbcTarget, table: str,
                     sheet: str = DEFAULT_SHEET) -> DataFrame:
    """C-8: a sheet of every workbook of ``folder`` as one database table."""
    rows = read_workbooks(spark, folder, sheet)
    target.write(rows, table)
    return rows


def made_from(*parts: object) -> str:
    """A digest of keys and parameters."""
    return hashlib.sha1("\n\n".join(map(repr, parts)).encode()).hexdigest()[:20]


#: Groups of sale files, by a hash of their name; a new or changed file renews its group.
SALE_PARTS = 64


def folder_stage(run: Run, name: str, folder: str, suffix: str, part: Callable[[Column], Column],
                 ingest: Callable[[list[str]], DataFrame]) -> tuple[DataFrame, str]:
    """The rows of a folder's files as a stage in parts, and a digest of all files.

    Files are grouped by ``part``; only groups with new, changed or removed files are read
    (``ingest(names)``, which says each row's file name in the column ``PART``).
    """
    label = lambda file_name: F.concat(F.lit("p"), part(file_name))  # noqa: E731  never empty
    groups = file_parts(run.spark, folder, suffix, label).collect()  # a row a part, with its files' names
    if not groups:
        raise ValueError(f"no {suffix} file in folder {folder}")
    names = {r["part"]: r["names"] for r in groups}
    keys = {r["part"]: r["key"][:20] for r in groups}
    rows = run.parts(name, keys, lambda missing: ingest([n for p in missing for n in names[p]])
                     .withColumn(PART, label(F.col(PART))))
    return rows, made_from(sorted(keys.items()))


def path_key(spark: SparkSession, path: str) -> str:
    """A digest of the files at ``path`` (a file or a folder), listed by Spark."""
    files = spark.read.format("binaryFile").load(path).select(F.concat_ws(":", "path", "length", "modificationTime").alias("said"))
    return files.agg(F.sha1(F.array_join(F.sort_array(F.collect_list("said")), "\n"))).first()[0]


def run_pipeline(spark: SparkSession, inputs: Inputs, out_dir: str, region: RegionSpec,
                 code_remap: Mapping[str, str] | None = None, force: bool = False,
                 database: JdbcTarget | None = None) -> dict[str, DataFrame]:
    """Run every stage and publish the outputs together; returns the final tables.

    ``sinks.published(spark, out_dir)`` names the outputs: ``rents``, ``sales``,
    ``rent_by_dept``, ``rent_by_city``, ``address_sales``, ``yield_dept_long``,
    ``yield_city_long`` (parquet), ``rents_region``, ``address_sales_csv`` and, with
    ``code_remap``, ``geo_remapped`` (delimited folders), the named files
    ``rent_by_dept.csv`` and ``yield_by_dept.csv`` (a row a department), and the folders
    ``rent_by_city.csv`` and ``yield_by_city.csv`` of part files, as cities are many. If a
    stage fails nothing is published and the outputs of the last run stay. With
    ``database`` the two yield tables are written there after that.

    Branches that do not need each other (rents, sales, lookup; then departments, cities)
    run side by side as Spark jobs of their own.
    """
    run = Run(spark, out_dir, force)

    def stage(name: str, build, *made_of: object) -> DataFrame:
        return run.stage(name, build, made_from(*made_of))

    def lookup() -> None:
        if code_remap:
            remap_lookup(spark, inputs.geo_path, run.path("geo_remapped"), code_remap)

    def rent_tables() -> tuple:
        # a part a year: a new yearly file renews its year alone
        rents, key = folder_stage(
            run, "rents", inputs.rent_folder, ".csv", file_year_digits,
            lambda names: ingest_yearly_folder(spark, inputs.rent_folder, rename=RENT_RENAMES, names=names, file_name=PART))
        from_rents = (key, region)
        mine = filter_region(rents, region.code)
        _, by_dept, by_city = together(
            lambda: export_csv(rename_columns(mine, {v: k for k, v in RENT_RENAMES.items()}), run.path("rents_region")),
            lambda: stage("rent_by_dept", lambda: rent_by_dept(mine), *from_rents),
            lambda: stage("rent_by_city", lambda: rent_by_city(mine), *from_rents))
        return rents, by_dept, by_city, from_rents

    def sale_tables() -> tuple:
        sales, key = folder_stage(
            run, "sales", inputs.sale_folder, ".txt",
            lambda name: F.pmod(F.crc32(name.cast("binary")), F.lit(SALE_PARTS)).cast("string"),
            lambda names: ingest_pipe_folder(spark, inputs.sale_folder, rename=SALE_RENAMES, names=names, file_name=PART))
        from_sales = (key, path_key(spark, inputs.geo_path), region)
        geo = read_delimited(spark, inputs.geo_path, "\t", rename=GEO_RENAMES)
        return sales, stage("address_sales", lambda: with_sale_year(clean_sales(sales, geo, region)), *from_sales), from_sales

    _, (rents, rent_dept, rent_city, from_rents), (sales, address, from_sales) = together(lookup, rent_tables, sale_tables)

    def wide(name: str, long: DataFrame, keys: list[str]) -> DataFrame:
        """The yields by year, pivoted off the long table, which is an output of its own."""
        long = stage(name, lambda: long, *from_rents, *from_sales)
        years = sorted(r["year"] for r in long.select("year").where("year is not null").distinct().collect())
        return pivot_years(long, keys, years=years)

    def departments() -> DataFrame:
        table = wide("yield_dept_long", yield_by_dept_long(address, rent_dept), ["dep"])
        for name, df in (("rent_by_dept.csv", rent_dept), ("yield_by_dept.csv", table)):
            run.path(name)
            export_named_csv(df, run.folder, name)
        return table

    def cities() -> DataFrame:
        table = wide("yield_city_long", yield_by_city_long(address, rent_city), ["city", "insee"])
        for name, df in (("rent_by_city.csv", rent_city), ("yield_by_city.csv", table)):
            export_csv(df, run.path(name))
        return table

    ydept, ycity, _ = together(departments, cities, lambda: export_csv(address, run.path("address_sales_csv")))
    run.publish()
    if database:
        database.write(ydept, "yield_by_dept")
        database.write(ycity, "yield_by_city")
    return {"rents": rents, "sales": sales, "address_sales": address,
            "rent_by_dept": rent_dept, "rent_by_city": rent_city,
            "yield_by_dept": ydept, "yield_by_city": ycity}


def together(*branches: Callable[[], object]) -> list:
    """Run the branches in threads of their own; waits for all, then raises what any raised."""
    with ThreadPoolExecutor(max_workers=len(branches)) as pool:
        running = [pool.submit(b) for b in branches]
    return [r.result() for r in running]
