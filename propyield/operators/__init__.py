from propyield.operators.filters import (
    filter_kind,
    filter_labels,
    filter_present,
    filter_region,
    having_positive,
    remap_column,
)
from propyield.operators.joins import join_lookup
from propyield.operators.rents import parse_rents, rent_by_city, rent_by_dept, rent_means
from propyield.operators.sales import address_sales, clean_sales, join_geo, match_geo, parse_amounts, repair_postal, sum_lines
from propyield.operators.text import preview_rows, repair_column
from propyield.operators.yields import (
    gather_years,
    pivot_years,
    sales_totals,
    spread_years,
    with_sale_year,
    yield_by_city,
    yield_by_city_long,
    yield_by_dept,
    yield_by_dept_long,
    yield_long,
    years_of,
)

__all__ = [
    "address_sales", "clean_sales", "filter_kind", "filter_labels", "filter_present",
    "filter_region", "gather_years", "having_positive", "join_geo", "join_lookup", "match_geo",
    "parse_amounts", "parse_rents", "pivot_years", "preview_rows", "remap_column",
    "rent_by_city", "rent_by_dept", "rent_means", "repair_column", "repair_postal", "sales_totals",
    "sum_lines", "with_sale_year", "yield_by_city", "yield_by_city_long", "yield_by_dept",
    "yield_by_dept_long", "yield_long", "years_of",
]
