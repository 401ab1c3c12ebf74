"""Sales cleaning: kind filter, geography join, address-grain sums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from propyield.functions import decimal_comma
from propyield.operators.filters import (
    filter_kind,
    filter_labels,
    filter_present,
    having_positive,
)
from propyield.operators.joins import join_lookup
from propyield.schemas import ADDRESS_KEYS, MONEY, SALE_KIND, RegionSpec

GEO_JOIN_KEYS = ["postal", "commune"]
AMOUNTS = ("value", "surface")


def parse_amounts(df: DataFrame, dtype: DataType = MONEY) -> DataFrame:
    """Decimal-comma value and surface texts to exact decimals (null if unparsable).

    ``dtype`` sets the scale: more decimals than it holds are rounded on parse.
    """
    return df.withColumns({
        "value": decimal_comma("value_txt", dtype),
        "surface": decimal_comma("surface_txt", dtype),
    })


def repair_postal(df: DataFrame, col: str = "postal", width: int = 5) -> DataFrame:
    """Put back leading zeros that a numeric reading has cut off (``9000`` -> ``09000``).

    Only values of digits alone, shorter than ``width``, change.
    """
    c = F.col(f"`{col}`")
    return df.withColumn(col, F.when(c.rlike(r"^[0-9]+$") & (F.length(c) < width), F.lpad(c, width, "0")).otherwise(c))


def join_geo(sales: DataFrame, geo: DataFrame) -> DataFrame:
    """Attach INSEE code and department to each sale by (postal code, commune).

    Inner equi-join: case-, accent- and leading-zero-sensitive, null keys never
    match, a repeated (postal, commune) pair in the lookup fans out.
    """
    lookup = geo.select(*GEO_JOIN_KEYS, "insee", "dep")
    return join_lookup(sales, lookup, GEO_JOIN_KEYS, "inner")


@dataclass(frozen=True)
class Matched:
    """Sales with INSEE code and department, and the sales that found no lookup row."""

    rows: DataFrame       # the sale's columns, insee, dep, match: 'exact' or 'collated'
    unmatched: DataFrame  # the sale's columns, reason: 'no lookup row' or 'ambiguous'


def match_geo(sales: DataFrame, geo: DataFrame, collation: str = "UNICODE_CI_AI") -> Matched:
    """``join_geo``, then a second pass under ``collation`` for the sales that it missed.

    The second pass compares the commune by the collation (by default neither case nor
    accents count), the postal code still exactly. A key that stands for several
    places under the collation decides nothing: those sales stay unmatched as ambiguous.
    Null keys never match.
    """
    exact = join_geo(sales, geo).withColumn("match", F.lit("exact"))
    folded = F.collate("commune", collation)
    places = (geo.where("postal is not null and commune is not null").select("postal", folded.alias("folded"), "insee", "dep").distinct()
              .groupBy("postal", "folded").agg(F.count(F.lit(1)).alias("places"), F.min("insee").alias("insee"), F.min("dep").alias("dep")))
    # the collated key is the lookup's alone: the sale keeps its own spelling
    looked = places.withColumnsRenamed({"postal": "_postal", "folded": "_folded", "insee": "_insee", "dep": "_dep", "places": "_places"})
    # each key is judged once, then the sales meet their key's verdict: they are shuffled once,
    # and what the collation costs grows with the keys
    listed = geo.select(*GEO_JOIN_KEYS).distinct().withColumn("_exact", F.lit(True))
    keys = sales.select(*GEO_JOIN_KEYS).distinct().join(listed, GEO_JOIN_KEYS, "left")
    same = (F.col("postal") == F.col("_postal")) & (F.collate("commune", collation) == F.col("_folded"))
    judged = (keys.join(looked, F.col("_exact").isNull() & same, "left")
              .select(*GEO_JOIN_KEYS, "_exact", "_places", "_insee", "_dep"))
    found = sales.join(judged, GEO_JOIN_KEYS, "left").where(F.col("_exact").isNull())
    one = F.coalesce(F.col("_places") == 1, F.lit(False))
    second = found.where(one).select(*[F.col(f"`{c}`") for c in sales.columns], F.col("_insee").alias("insee"),
                                     F.col("_dep").alias("dep"), F.lit("collated").alias("match"))
    reason = F.when(F.col("_places").isNull(), "no lookup row").otherwise("ambiguous")
    return Matched(exact.unionByName(second),
                   found.where(~one).select(*[F.col(f"`{c}`") for c in sales.columns], reason.alias("reason")))


def address_sales(df: DataFrame, keys: list[str] = ADDRESS_KEYS, dtype: DataType = MONEY) -> DataFrame:
    """Sum sale value and built surface per address and sale date.

    Lines of one sale share the address, so they are added up (a value listed on
    several lines is counted on each, as in the source files). Null keys form
    their own groups; an all-null sum is null. Sums are exact decimals, so the
    map-side partial aggregation and the final merge give one answer. Rows of
    ``sum_lines`` are added up in the type of their sums.
    """
    if "value_txt" not in df.columns:
        return df.groupBy(*keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(f"{c}_sum") for c in AMOUNTS])
    return parse_amounts(df, dtype).groupBy(*keys).agg(*[F.sum(c).alias(f"{c}_sum") for c in AMOUNTS])


def sum_lines(sales: DataFrame, dtype: DataType = MONEY) -> DataFrame:
    """The lines of one address and sale date as one row, with the sums ``value`` and ``surface``.

    Taken before the lookup join: a key that the lookup lists many times repeats these rows, not
    every line. ``address_sales`` of the joined rows equals that of the joined lines.
    """
    keys = [k for k in ADDRESS_KEYS if k not in ("insee", "dep")]
    return address_sales(sales, keys, dtype).withColumnsRenamed({f"{c}_sum": c for c in AMOUNTS})


def clean_sales(sales: DataFrame, geo: DataFrame, region: RegionSpec,
                kind: str = SALE_KIND, dtype: DataType = MONEY, collation: str | None = None) -> DataFrame:
    """Sales of one kind in one region, summed per address, with built surface > 0.

    ``sales`` has the renamed sale columns, ``geo`` the renamed lookup columns.
    The kind and surface filters reach the sales scan; the region filter reaches
    the lookup scan before the join. ``dtype`` is the exact type amounts are summed in.
    ``collation`` matches communes that miss the exact join by it (``match_geo``).
    """
    s = sum_lines(filter_present(filter_kind(sales, kind), "surface_txt"), dtype)
    g = filter_labels(geo, region.labels)
    joined = match_geo(s, g, collation).rows if collation else join_geo(s, g)
    return having_positive(address_sales(joined, dtype=dtype), "surface_sum")
