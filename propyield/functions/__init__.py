from propyield.functions.columns import (
    MOJIBAKE_RULES,
    decimal_comma,
    digits_only,
    exact_mean,
    file_year_digits,
    gross_yield,
    parse_date,
    remap,
    repair_text,
    year_of,
)

__all__ = [
    "MOJIBAKE_RULES", "decimal_comma", "digits_only", "exact_mean", "file_year_digits", "gross_yield",
    "parse_date", "remap", "repair_text", "year_of",
]
