"""Column names, rename maps, numeric types and the region parameter.

Input files keep the header names of the public French open-data files the engine
is built for; on ingest they are renamed to dot-free snake_case so later code never
needs back-ticks (``lwr.IPm2`` has a literal dot).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DecimalType, StringType, StructField, StructType

# --- fixed values: header names of the input files (must match the files) ---
# rent estimates, one ';' file per year
RENT_HEADER = ["INSEE_C", "LIBGEO", "REG", "DEP", "loypredm2", "lwr.IPm2", "upr.IPm2"]
# property sales, '|' text files
SALE_HEADER = ["Nature mutation", "Code postal", "Commune", "Surface reelle bati",
               "Valeur fonciere", "No voie", "Voie", "Date mutation"]
# postal code / commune lookup, TAB separated
GEO_HEADER = ["Code Postal", "Commune", "Code INSEE", "Code Département", "Région",
              "Code Région"]
# the sale kind the pipeline keeps, and the date format of the sale file
SALE_KIND = "Vente"
SALE_DATE_FORMAT = "dd/MM/yyyy"
# --- end of fixed values ---

RENT_RENAMES = {
    "INSEE_C": "insee", "LIBGEO": "city", "REG": "reg", "DEP": "dep",
    "loypredm2": "rent_txt", "lwr.IPm2": "low_txt", "upr.IPm2": "high_txt",
}
SALE_RENAMES = {
    "Nature mutation": "kind", "Code postal": "postal", "Commune": "commune",
    "Surface reelle bati": "surface_txt", "Valeur fonciere": "value_txt",
    "No voie": "street_no", "Voie": "street", "Date mutation": "date_txt",
}
GEO_RENAMES = {
    "Code Postal": "postal", "Commune": "commune", "Code INSEE": "insee",
    "Code Département": "dep", "Région": "region_label", "Code Région": "region_code",
}

RENT_COLUMNS = [RENT_RENAMES[c] for c in RENT_HEADER]
SALE_COLUMNS = [SALE_RENAMES[c] for c in SALE_HEADER]
GEO_COLUMNS = [GEO_RENAMES[c] for c in GEO_HEADER]

# Address grain of a sale: the seven keys of the address aggregation.
ADDRESS_KEYS = ["street_no", "street", "postal", "commune", "date_txt", "insee", "dep"]

# Money and surfaces are summed exactly (order-independent, the same on any
# partitioning); rents keep more decimals. Means and ratios are doubles.
MONEY = DecimalType(18, 2)
RENT = DecimalType(18, 8)


def string_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


@dataclass(frozen=True)
class RegionSpec:
    """One region, as the two inputs name it.

    Rent files carry a region *code* (``REG``); the geography lookup carries
    region *labels* (stringified lists such as ``['MIDI-PYRENEES']``), possibly
    several old regions that make up the new one.
    """

    code: str
    labels: tuple[str, ...] = field(default_factory=tuple)
