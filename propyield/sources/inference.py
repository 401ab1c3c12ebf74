"""Column types from values, by one rule over all files, without losing a code's zeros.

Every value is of one kind; a column's kinds are collected by one Spark aggregate over all
rows of all files (a bit for each kind), so one row reaches the driver whatever the data,
and files that disagree are merged by rule, not by which file comes first:

* whole numbers (``0``, ``-17``) are int, or bigint where one needs it; with decimals,
  double; true/false boolean; ISO dates date, with times among them timestamp;
* **digits with a leading zero** (``09000``), numbers with a plus sign and more digits than
  a bigint holds are codes, a kind of text: the column stays text, as do columns of
  kinds that do not go together (``09000`` or ``31000`` beside ``2A004``);
* empty and null values say nothing; a column of nothing else is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT, LONG, DOUBLE, BOOLEAN, DATE, TIMESTAMP, TEXT = (1 << i for i in range(7))


def kind_of(value: Column) -> Column:
    """The kind (one bit) of a text value; 0 for null and empty text."""
    return (F.when(value.isNull() | (value == ""), 0)
            .when(value.rlike(r"^(0|-?[1-9][0-9]{0,18})$"),
                  F.when(value.try_cast("int").isNotNull(), INT).when(value.try_cast("bigint").isNotNull(), LONG).otherwise(TEXT))
            .when(value.rlike(r"^-?(0|[1-9][0-9]*)?\.[0-9]+([eE][+-]?[0-9]+)?$|^-?[1-9][0-9]*[eE][+-]?[0-9]+$"), DOUBLE)
            .when(value.rlike("^(?i:true|false)$"), BOOLEAN)
            .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), DATE)
            .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$")
                  & value.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
            .otherwise(TEXT))


def type_of(kinds: int) -> str:
    """The type that holds values of all ``kinds`` (bits)."""
    for held, name in ((INT, "int"), (INT | LONG, "bigint"), (INT | LONG | DOUBLE, "double"), (BOOLEAN, "boolean"),
                       (DATE, "date"), (DATE | TIMESTAMP, "timestamp_ntz")):
        if kinds and not kinds & ~held:
            return name
    return "string"


def infer_schema(df: DataFrame) -> dict[str, str]:
    """Type of each text column of ``df``, by name (one pass over all rows)."""
    text = [c for c, kind in df.dtypes if kind == "string"]
    if not text:
        return {}
    found = df.agg(*[F.bit_or(kind_of(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(text)]).first()
    return {c: type_of(found[i] or 0) for i, c in enumerate(text)}


def infer_types(df: DataFrame) -> DataFrame:
    """``df`` with its text columns as the types that all their values share."""
    types = infer_schema(df)
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if types.get(c, "string") != "string" else F.col(f"`{c}`")
                       for c in df.columns])
