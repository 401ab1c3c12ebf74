from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from propyield.functions import decimal_comma
from propyield.operators import clean_sales, filter_region, yield_by_city_long
from propyield.operators.rents import rent_by_city
from propyield.schemas import GEO_COLUMNS, RENT_COLUMNS, SALE_COLUMNS, RegionSpec
from tests.plan_text import explain_text

REGION = RegionSpec("76", ("['OCCITANIE']",))


def _skewed_sales(n: int) -> list[tuple]:
    """A third of all rows share one address (a hot key); the rest spread out."""
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(("Vente", "31000", "TOULOUSE", "10", "1000,50", "1", "RUE HOT",
                         "01/06/2023"))
        else:
            rows.append(("Vente", "31000", "TOULOUSE", f"{i % 97 + 1}", f"{i},25", str(i),
                         "RUE", f"{i % 28 + 1:02d}/0{i % 9 + 1}/202{i % 3}"))
    return rows


def test_hot_address_matches_brute_force(spark):
    rows = _skewed_sales(3000)
    sales = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SALE_COLUMNS)) \
        .repartition(8)
    geo = spark.createDataFrame([("31000", "TOULOUSE", "31555", "31", "['OCCITANIE']", "76")],
                                ", ".join(f"{c} string" for c in GEO_COLUMNS))
    got = {(r.street_no, r.street, r.date_txt): (r.value_sum, r.surface_sum)
           for r in clean_sales(sales, geo, REGION).collect()}

    pdf = pd.DataFrame(rows, columns=SALE_COLUMNS)
    pdf["value"] = pdf["value_txt"].str.replace(",", ".").map(Decimal)
    pdf["surface"] = pdf["surface_txt"].map(lambda s: Decimal(s).quantize(Decimal("0.01")))
    want = {k: (g["value"].sum(), g["surface"].sum())
            for k, g in pdf.groupby(["street_no", "street", "date_txt"])}
    assert got == want
    assert got[("1", "RUE HOT", "01/06/2023")] == (Decimal("1000.50") * 1000, Decimal("10000.00"))


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = _skewed_sales(300)
    sales = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SALE_COLUMNS))
    geo = spark.createDataFrame([("31000", "TOULOUSE", "31555", "31", "['OCCITANIE']", "76")],
                                ", ".join(f"{c} string" for c in GEO_COLUMNS))
    plan = explain_text(clean_sales(sales, geo, REGION))
    assert "partial_sum" in plan  # map-side combine: one row per hot key per task


def test_yield_plan_shuffles(spark):
    sales = spark.createDataFrame(_skewed_sales(30), ", ".join(f"{c} string" for c in SALE_COLUMNS))
    geo = spark.createDataFrame([("31000", "TOULOUSE", "31555", "31", "['OCCITANIE']", "76")],
                                ", ".join(f"{c} string" for c in GEO_COLUMNS))
    rents = spark.createDataFrame([("31555", "Toulouse", "76", "31", "12,5", "11", "14", "2023")],
                                  ", ".join(f"{c} string" for c in RENT_COLUMNS) + ", year string")
    plan = explain_text(yield_by_city_long(clean_sales(sales, geo, REGION),
                                           rent_by_city(filter_region(rents, "76"))))
    assert plan.count("Exchange hashpartitioning") <= 3  # address, city-year, rent means
    assert "EvalPython" not in plan


money = st.decimals(min_value=Decimal("-9999999999.99"), max_value=Decimal("9999999999.99"),
                    places=2, allow_nan=False, allow_infinity=False)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(money, min_size=1, max_size=20))
def test_parse_of_render_is_identity(spark, values):
    rendered = [(str(v).replace(".", ","),) for v in values]
    df = spark.createDataFrame(rendered, "t string")
    assert [r.v for r in df.select(decimal_comma("t").alias("v")).collect()] == values


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["11", "76", "93", None]), min_size=0, max_size=30))
def test_region_filter_idempotent_and_union_adds_up(spark, regs):
    rows = [("x", "c", r, "d", "1", "1", "1", "2023") for r in regs]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RENT_COLUMNS) + ", year string")
    once = filter_region(df, "76")
    assert once.count() == filter_region(once, "76").count() == regs.count("76")
    assert df.unionByName(df).count() == 2 * len(regs)
