from decimal import Decimal

from pyspark.sql import functions as F

from propyield.functions import (
    MOJIBAKE_RULES,
    decimal_comma,
    digits_only,
    exact_mean,
    gross_yield,
    remap,
    repair_text,
    year_of,
)
from propyield.plans.damage import CORRUPTIONS
from propyield.schemas import RENT
from tests.plan_text import explain_text


def test_decimal_comma(spark):
    df = spark.createDataFrame([("9,53",), ("123456,00",), ("abc",), ("",), (None,),
                                ("1.234,5",), ("12",)], "t string")
    got = [r.v for r in df.select(decimal_comma("t").alias("v")).collect()]
    assert got == [Decimal("9.53"), Decimal("123456.00"), None, None, None, None,
                   Decimal("12.00")]


def test_decimal_comma_rent_scale(spark):
    df = spark.createDataFrame([("11,294626",)], "t string")
    assert df.select(decimal_comma("t", RENT).alias("v")).first().v == Decimal("11.29462600")


def test_sale_year(spark):
    df = spark.createDataFrame([("04/01/2023",), ("31/02/2023",), ("2023-01-04",), (None,)],
                               "d string")
    assert [r.y for r in df.select(year_of("d").alias("y")).collect()] == [2023, None, None, None]


def test_digits_only(spark):
    df = spark.createDataFrame([("rent_2023.csv",), ("app12-2023.CSV",), ("none.csv",)], "n string")
    assert [r.y for r in df.select(digits_only("n").alias("y")).collect()] == ["2023", "122023", ""]


def test_remap_keeps_other_values_and_null(spark):
    df = spark.createDataFrame([("73",), ("91",), (None,)], "c string")
    got = [r.c for r in df.select(remap("c", {"73": "76"}).alias("c")).collect()]
    assert got == ["76", "91", None]


def test_gross_yield_worked_example(spark):
    df = spark.createDataFrame([(10.0, Decimal("80.00"), Decimal("120000.00")),
                                (10.0, Decimal("80.00"), Decimal("0.00")),
                                (10.0, Decimal("80.00"), None)],
                               "r double, s decimal(18,2), v decimal(18,2)")
    got = [row.y for row in df.select(gross_yield("r", "s", "v").alias("y")).collect()]
    assert got == [8.0, None, None]


def test_exact_mean_is_order_independent(spark):
    vals = [(Decimal("0.10"),), (Decimal("0.20"),), (Decimal("0.30"),), (None,)]
    df = spark.createDataFrame(vals, "x decimal(18,2)")
    one = df.agg(exact_mean("x").alias("m")).first().m
    many = df.repartition(4).agg(exact_mean("x").alias("m")).first().m
    assert one == many == 0.6 / 3


def test_repair_inverts_damage(spark):
    text = "Créon, Bèze, Fête, à côté, Île, naïve"
    df = spark.createDataFrame([(text,)], "t string")
    damaged = df.select(repair_text("t", CORRUPTIONS).alias("t"))
    assert damaged.first().t == "CrÃ©on, BÃ¨ze, FÃªte, Ã\u00a0 cÃ´tÃ©, Île, naïve"
    fixed = damaged.select(repair_text("t", MOJIBAKE_RULES).alias("t")).first().t
    assert fixed == text


def test_repair_lost_letter_becomes_e_acute(spark):
    df = spark.createDataFrame([("No�l",)], "t string")
    assert df.select(repair_text("t").alias("t")).first().t == "Noél"


def test_functions_stay_in_codegen(spark):
    df = spark.range(100).select(F.concat(F.col("id").cast("string"), F.lit(",5")).alias("a"),
                                 F.lit("04/01/2023").alias("d"))
    plan = explain_text(df.select(decimal_comma("a"), year_of("d"), repair_text("a"),
                                  digits_only("d")))
    assert "[codegen id" in plan
    assert "EvalPython" not in plan
