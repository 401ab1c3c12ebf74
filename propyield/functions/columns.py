"""Column expressions (all JVM-side built-ins, so they stay inside whole-stage codegen).

ANSI mode is on by default in Spark 4: a bad cast, a bad date or a division by zero
would raise. Input files are dirty, so every parse uses the ``try_`` form and turns
garbage into null, which is what the pipeline has always done with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from propyield.schemas import MONEY, SALE_DATE_FORMAT

# --- fixed values: repairs of French place names mis-decoded as Latin-1, in the
# order they are applied. The fifth pattern is "Ã" followed by a no-break space.
MOJIBAKE_RULES: tuple[tuple[str, str], ...] = (
    ("\ufffd", "é"),
    ("Ã©", "é"),
    ("Ã¨", "è"),
    ("Ãª", "ê"),
    ("Ã\u00a0", "à"),
    ("Ã´", "ô"),
    ("Ã®", "î"),
)
# --- end of fixed values ---


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_comma(c: str | Column, dtype: DataType = MONEY) -> Column:
    """Decimal-comma text (``"9,53"``) to a number; unparsable text gives null.

    Every comma becomes a dot, so ``"1.234,5"`` is not a number.
    """
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast(dtype)


def parse_date(c: str | Column, fmt: str = SALE_DATE_FORMAT) -> Column:
    """Text date in ``fmt``; unparsable or impossible dates give null."""
    return F.try_to_date(_col(c), fmt)


def year_of(c: str | Column, fmt: str = SALE_DATE_FORMAT) -> Column:
    """Calendar year (int) of a text date."""
    return F.year(parse_date(c, fmt))


def digits_only(c: str | Column) -> Column:
    """All digit runs of a text joined (``app12-2023.csv`` -> ``122023``)."""
    return F.regexp_replace(_col(c), r"\D+", "")


def file_year_digits(file_name: str | Column) -> Column:
    """Digits of a file name as the file source reports it (percent-encoded).

    ``rent%202023.csv`` is decoded to ``rent 2023.csv`` first; a plus sign stays one.
    """
    return digits_only(F.url_decode(F.replace(_col(file_name), F.lit("+"), F.lit("%2B"))))


def remap(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep every other value (null stays null)."""
    c = _col(c)
    out = None
    for old, new in mapping.items():
        out = (F.when(c == F.lit(old), F.lit(new)) if out is None
               else out.when(c == F.lit(old), F.lit(new)))
    return c if out is None else out.otherwise(c)


def repair_text(c: str | Column,
                rules: Iterable[tuple[str, str]] = MOJIBAKE_RULES) -> Column:
    """Apply literal replacement rules in order (one projection, no regex)."""
    return reduce(lambda acc, r: F.replace(acc, F.lit(r[0]), F.lit(r[1])), rules, _col(c))


def gross_yield(rent_m2: str | Column, surface: str | Column, value: str | Column) -> Column:
    """Gross rental yield in percent, 2 decimals: rent x surface x 12 / value x 100.

    Exact sums are brought to double only here; a zero or null value gives null.
    """
    rent = _col(rent_m2).cast("double")
    surf = _col(surface).cast("double")
    val = _col(value).cast("double")
    return F.round(F.try_divide(rent * surf * F.lit(12), val) * F.lit(100), 2)


def exact_mean(c: str | Column) -> Column:
    """Mean of an exact decimal column as a double: exact sum / count.

    Unlike ``avg`` over doubles, the result does not depend on the order partial
    sums arrive in, so it is the same on any cluster layout.
    """
    c = _col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))
