from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from propyield.operators import (
    address_sales,
    clean_sales,
    filter_labels,
    filter_present,
    filter_region,
    join_geo,
    join_lookup,
    match_geo,
    parse_amounts,
    pivot_years,
    preview_rows,
    rent_by_city,
    rent_by_dept,
    repair_postal,
    sales_totals,
    sum_lines,
    yield_by_city,
    yield_by_dept,
    yield_by_dept_long,
)
from propyield.schemas import GEO_COLUMNS, RENT_COLUMNS, SALE_COLUMNS, RegionSpec
from tests.plan_text import explain_text

REGION = RegionSpec("76", ("['MIDI-PYRENEES']", "['LANGUEDOC-ROUSSILLON']"))
SALE_SCHEMA = ", ".join(f"{c} string" for c in SALE_COLUMNS)
GEO_SCHEMA = ", ".join(f"{c} string" for c in GEO_COLUMNS)
RENT_SCHEMA = ", ".join(f"{c} string" for c in RENT_COLUMNS) + ", year string"

# kind, postal, commune, surface_txt, value_txt, street_no, street, date_txt
SALES = [
    ("Vente", "09000", "FOIX", "80", "120000,00", "12", "DE LA PAIX", "04/01/2023"),
    ("Vente", "09000", "FOIX", "20", "120000,00", "12", "DE LA PAIX", "04/01/2023"),  # same sale
    ("Vente", "09000", "FOIX", "", "5000,00", "1", "RUE A", "05/01/2023"),            # no surface
    ("Vente", "09000", "FOIX", None, "5000,00", "1", "RUE A", "05/01/2023"),          # no surface
    ("Echange", "09000", "FOIX", "50", "1,00", "2", "RUE B", "06/01/2023"),           # not a sale
    ("Vente", "09000", "Foix", "50", "100000,00", "3", "RUE C", "06/01/2023"),        # case miss
    ("Vente", "9000", "FOIX", "50", "100000,00", "3", "RUE C", "06/01/2023"),         # zero lost
    ("Vente", "31000", "TOULOUSE", "0", "90000,00", "4", "RUE D", "07/02/2022"),      # surface 0
    ("Vente", "31000", "TOULOUSE", "60", "NC", None, None, "07/02/2022"),              # null keys
    ("Vente", "75001", "PARIS", "30", "900000,00", "5", "RUE E", "01/03/2023"),       # other region
    ("Vente", "34000", "MONTPELLIER", "40", "160000,00", "6", "RUE F", "31/02/2023"),  # bad date
]
GEO = [
    ("09000", "FOIX", "09122", "09", "['MIDI-PYRENEES']", "73"),
    ("31000", "TOULOUSE", "31555", "31", "['MIDI-PYRENEES']", "73"),
    ("34000", "MONTPELLIER", "34172", "34", "['LANGUEDOC-ROUSSILLON']", "91"),
    ("75001", "PARIS", "75056", "75", "['ILE-DE-FRANCE']", "11"),
]


@pytest.fixture()
def sales(spark):
    return spark.createDataFrame(SALES, SALE_SCHEMA)


@pytest.fixture()
def geo(spark):
    return spark.createDataFrame(GEO, GEO_SCHEMA)


def test_clean_sales_semantics(sales, geo):
    rows = {(r.street_no, r.insee): (r.value_sum, r.surface_sum)
            for r in clean_sales(sales, geo, REGION).collect()}
    # lines of one sale add up (value counted on each line, as in the source files)
    assert rows[("12", "09122")] == (Decimal("240000.00"), Decimal("100.00"))
    # null street keys form a group; unparsable value gives a null sum
    assert rows[(None, "31555")] == (None, Decimal("60.00"))
    # surface 0 dropped by HAVING; other region, kind, case and zero misses dropped
    assert ("4", "31555") not in rows and ("5", "75056") not in rows
    assert ("2", "09122") not in rows and ("3", "09122") not in rows
    assert len(rows) == 3


def test_lookup_fan_out(spark, sales, geo):
    dup = geo.unionByName(geo.where("insee = '09122'"))
    got = clean_sales(sales, dup, REGION).where("street_no = '12'").first()
    assert got.value_sum == Decimal("480000.00")  # repeated lookup pair doubles the lines


def test_filters(spark, sales, geo):
    assert filter_labels(geo, REGION.labels).count() == 3
    assert filter_present(sales, "surface_txt").count() == len(SALES) - 2


def stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_join_lookup_by_size(spark, sales, geo, scratch):
    """A small lookup is broadcast, a large one is not, and the rows are the same."""
    sales = stored(sales, f"{scratch}/sales")
    lookup = stored(geo, f"{scratch}/geo").select("postal", "commune", "insee")
    small = join_lookup(sales, lookup, ["postal", "commune"])
    assert "BroadcastHashJoin" in explain_text(small)
    rows = sorted(map(repr, small.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        big = join_lookup(sales, lookup, ["postal", "commune"])
        assert "SortMergeJoin" in explain_text(big)
        assert sorted(map(repr, big.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


RENTS = [
    # insee, city, reg, dep, rent, low, high, year
    ("09122", "Foix", "76", "09", "10,00", "9,00", "11,00", "2023"),
    ("09122", "Foix", "76", "09", "12,00", "10,00", "14,00", "2023"),
    ("31555", "Toulouse", "76", "31", "14,00", "12,00", "16,00", "2022"),
    ("34172", "Montpellier", "76", "34", "abc", "", None, "2023"),
    ("75056", "Paris", "11", "75", "30,00", "25,00", "35,00", "2023"),
]


@pytest.fixture()
def rents(spark):
    return spark.createDataFrame(RENTS, RENT_SCHEMA)


def test_rent_means(rents):
    dept = {(r.dep, r.year): r.avg_rent_m2 for r in rent_by_dept(filter_region(rents, "76")).collect()}
    assert dept == {("09", 2023): 11.0, ("31", 2022): 14.0, ("34", 2023): None}
    city = rent_by_city(rents).where("insee = '09122'").first()
    assert (city.avg_rent_low_m2, city.avg_rent_high_m2) == (9.5, 12.5)


def test_yield_long_and_pivot(sales, geo, rents):
    address = clean_sales(sales, geo, REGION)
    rent_dept = rent_by_dept(filter_region(rents, "76"))
    long = {(r.dep, r.year): r.rental_yield for r in yield_by_dept_long(address, rent_dept).collect()}
    # 11 * 100 * 12 / 240000 * 100 = 5.5 ; Toulouse: value all null -> null yield
    assert long == {("09", 2023): 5.5, ("31", 2022): None}
    wide = yield_by_dept(address, rent_dept)
    assert wide.columns == ["dep", "2022", "2023"]
    assert {tuple(r) for r in wide.collect()} == {("09", None, 5.5), ("31", None, None)}
    discovered = yield_by_dept(address, rent_dept)  # years collected by Spark's pivot
    assert discovered.columns == ["dep", "2022", "2023"]


def test_yield_by_city(sales, geo, rents):
    address = clean_sales(sales, geo, REGION)
    wide = yield_by_city(address, rent_by_city(filter_region(rents, "76")))
    assert wide.columns == ["city", "insee", "2022", "2023"]
    # a group with no row in a year stays, with a null cell (as pivot does)
    assert {tuple(r) for r in wide.drop("2022").collect()} == {("Foix", "09122", 5.5),
                                                  ("Toulouse", "31555", None)}


def test_pivot_unpivot_roundtrip(spark):
    long = spark.createDataFrame([("a", 2020, 1.5), ("a", 2021, 2.5), ("b", 2021, 3.5)],
                                 "k string, year int, rental_yield double")
    wide = pivot_years(long, ["k"])
    back = wide.unpivot(["k"], ["2020", "2021"], "year", "rental_yield") \
        .where("rental_yield is not null").selectExpr("k", "cast(year as int) year", "rental_yield")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_sales_totals_and_address_sales(spark, sales, geo):
    joined = join_lookup(sales, geo.select("postal", "commune", "insee", "dep"), ["postal", "commune"])
    assert address_sales(joined).count() == 7  # before HAVING, every kind and region
    totals = sales_totals(clean_sales(sales, geo, REGION), ["dep"])
    assert {(r.dep, r.year) for r in totals.collect()} == {("09", 2023), ("31", 2022), ("34", None)}


def test_preview_rows_ordered(geo):
    assert [r.insee for r in preview_rows(geo, 2, ["insee"]).collect()] == ["09122", "31555"]


def test_clean_sales_plan(spark, sales, geo, scratch):
    plan = explain_text(clean_sales(stored(sales, f"{scratch}/s"), stored(geo, f"{scratch}/g"), REGION))
    assert "BroadcastHashJoin" in plan and "PushedFilters: [IsNotNull(kind)" in plan
    assert "EvalPython" not in plan
    assert plan.count("Exchange hashpartitioning") <= 1  # one shuffle: the address sums


def test_pivot_has_every_year_of_the_data(spark):
    long = spark.createDataFrame([("a", 1994, 1.0), ("a", 1995, 2.0), ("b", 2031, 3.0)],
                                 "k string, year int, rental_yield double")
    wide = pivot_years(long, ["k"])
    assert wide.columns == ["k", "1994", "1995", "2031"]
    assert sorted(map(tuple, wide.collect())) == [("a", 1.0, 2.0, None), ("b", None, None, 3.0)]


def test_pivot_computes_its_input_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "k string, year int, rental_yield double"
    long = spark.createDataFrame([("a", 1994, 1.0), ("b", 1995, None), ("c", None, 3.0)], schema).mapInArrow(watched, schema)
    wide = pivot_years(long, ["k"])
    assert wide.columns == ["k", "1994", "1995"]
    assert sorted(map(tuple, wide.collect())) == [("a", 1.0, None), ("b", None, None), ("c", None, None)]
    assert seen.value == 3
    given = pivot_years(long, ["k"], years=[1995, 1994, 2000])
    assert given.columns == ["k", "1995", "1994", "2000"] and seen.value == 3  # no job
    assert explain_text(given).count("- Exchange (") == 1


def test_cells_with_several_values_take_the_greatest(spark):
    rows = [("a", 1994, 1.0), ("a", 1994, 5.0), ("a", 1994, None), ("a", 1994, 5.0), ("a", 1995, None)]
    wide = pivot_years(spark.createDataFrame(rows, "k string, year int, rental_yield double"), ["k"])
    assert list(map(tuple, wide.collect())) == [("a", 5.0, None)]


def test_communes_that_miss_the_exact_join_match_under_a_collation(spark):
    geo = spark.createDataFrame([("09000", "FOIX", "09122", "09"), ("31000", "Cr\u00e9on", "31151", "31"), ("31000", "CREON", "31152", "31"),
                                 ("34000", "S\u00e8te", "34301", "34"), ("34000", "S\u00e8te", "34301", "34"), (None, "X", "1", "1")],
                                "postal string, commune string, insee string, dep string")
    sales = spark.createDataFrame([(1, "09000", "Foix"), (2, "09000", "FOIX"), (3, "31000", "creon"), (4, "31000", "CREON"), (5, "34000", "SETE"),
                                   (6, "34000", "Sete "), (7, None, "X"), (8, "09000", None), (9, "34001", "S\u00e8te"), (1, "09000", "Foix")],
                                  "id int, postal string, commune string")
    out = match_geo(sales, geo)
    assert sorted((r.id, r.commune, r.insee, r.match) for r in out.rows.collect()) == [
        (1, "Foix", "09122", "collated"), (1, "Foix", "09122", "collated"), (2, "FOIX", "09122", "exact"),
        (4, "CREON", "31152", "exact"), (5, "SETE", "34301", "collated")]
    assert sorted((r.id, r.reason) for r in out.unmatched.collect()) == [
        (3, "ambiguous"), (6, "no lookup row"), (7, "no lookup row"), (8, "no lookup row"), (9, "no lookup row")]
    assert set(out.rows.columns) == {"id", "postal", "commune", "insee", "dep", "match"}
    assert sorted(r.id for r in match_geo(sales, geo, "UNICODE_CI").rows.collect()) == [1, 1, 2, 3, 4]
    assert sorted(r.id for r in join_geo(sales, geo).collect()) == [2, 4]  # the default is unchanged


def test_repair_postal_and_scale(spark):
    df = spark.createDataFrame([("9000", "1,239"), ("31000", "2"), ("2A004", "x"), (None, None)], "postal string, value_txt string")
    assert [r.postal for r in repair_postal(df).collect()] == ["09000", "31000", "2A004", None]
    amounts = parse_amounts(df.withColumn("surface_txt", F.lit("1")), DecimalType(18, 3)).collect()
    assert [r.value for r in amounts] == [Decimal("1.239"), Decimal("2.000"), None, None]


def test_city_names_are_repaired_before_the_pivot(spark):
    address = spark.createDataFrame([("31555", "01/01/2023", Decimal("100.00"), Decimal("10.00"))],
                                    "insee string, date_txt string, value_sum decimal(18,2), surface_sum decimal(18,2)")
    rents = spark.createDataFrame([("Orl\u00c3\u00a9ans", "31555", 2023, 2.0)], "city string, insee string, year int, avg_rent_m2 double")
    assert [r.city for r in yield_by_city(address, rents, repair=True).collect()] == ["Orl\u00e9ans"]
    assert [r.city for r in yield_by_city(address, rents).collect()] == ["Orl\u00c3\u00a9ans"]


def test_lines_are_summed_before_the_lookup_repeats_them(spark):
    cols = "street_no string, street string, postal string, commune string, date_txt string, value_txt string, surface_txt string"
    a = ("1", "R", "1", "A", "01/01/2020")
    sales = spark.createDataFrame([(*a, "1,10", "5"), (*a, "2,20", "NC"), (*a, None, None), (None, "R", "1", "A", None, "7", None),
                                   ("2", "R", None, "A", None, "8", "8"), ("3", "R", "1", "B", None, "9", "9")], cols)
    # two places of one name, one of them listed twice, and a key that is null
    geo = spark.createDataFrame([("1", "A", "x", "d"), ("1", "A", "y", "d"), ("1", "A", "y", "d"), (None, "A", "z", "d")],
                                "postal string, commune string, insee string, dep string")
    lines, summed = address_sales(join_geo(sales, geo)), address_sales(join_geo(sum_lines(sales), geo))
    assert summed.dtypes == lines.dtypes
    assert sorted(map(repr, summed.collect())) == sorted(map(repr, lines.collect()))
    assert {(r.insee, str(r.value_sum)) for r in summed.where("street_no = '1'").collect()} == {("x", "3.30"), ("y", "6.60")}
    # the job's plan sums on both sides of the join
    region_sales = clean_sales(sales.withColumn("kind", F.lit("Vente")), geo.withColumn("region_label", F.lit("a")), RegionSpec("1", ("a",)))
    assert explain_text(region_sales, "simple").count("HashAggregate(") >= 4


def test_a_key_is_judged_once_for_all_its_sales(spark):
    sales = spark.createDataFrame([(i, "1", n) for i, n in enumerate(["A", "a", "a", "x", None, "É", "b"])], "id int, postal string, commune string")
    geo = spark.createDataFrame([("1", "A", "1", "d"), ("1", "E", "2", "d"), ("1", "B", "3", "d")],
                                "postal string, commune string, insee string, dep string")
    out = match_geo(sales, geo)
    assert sorted((r.id, r.insee, r.match) for r in out.rows.collect()) == [
        (0, "1", "exact"), (1, "1", "collated"), (2, "1", "collated"), (5, "2", "collated"), (6, "3", "collated")]
    assert sorted((r.id, r.reason) for r in out.unmatched.collect()) == [(3, "no lookup row"), (4, "no lookup row")]
    # the sales themselves meet one join, with their key's verdict
    assert "LeftAnti" not in explain_text(out.unmatched, "simple")
