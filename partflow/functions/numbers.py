"""Number texts, decimal checks and rounding."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def erp_number(c: Column, type_name: str = "decimal(18,3)") -> Column:
    """``1.234,500`` is 1234.5 and ``12,000-`` is -12: dot groups, comma decimal, minus last.

    The notation has no exponents: a text with one is no number.
    """
    digits = F.translate(F.translate(F.trim(c), ".", ""), ",", ".")
    negative = F.concat(F.lit("-"), F.substring(digits, F.lit(1), F.length(digits) - 1))
    signed = F.when(F.endswith(digits, F.lit("-")), negative).otherwise(digits)
    return try_cast(F.when(~F.upper(digits).contains("E"), signed), type_name)


# Number notations in order of precedence. Each entry gives the
# shape, the group separator to drop and the decimal separator to turn into a dot.
NOTATIONS = (
    (r"^-?\d+(\.\d+)?[Ee][+-]?\d+$", "", ""),
    (r"^-?\d{1,3}(\.\d{3})+,\d+$", ".", ","),
    (r"^-?\d{1,3}(\.\d{3})+$", ".", ""),
    (r"^-?\d{1,3}(,\d{3})+\.\d+$", ",", ""),
    (r"^-?\d+,\d+$", "", ","),
    (r"^-?\d+(\.\d+)?$", "", ""),
)
# Fixed value: what stands around the digits of an amount.
CURRENCY_NOISE = "[\\s\\u00A0R$]"


def locale_decimal(c: Column, type_name: str = "decimal(38,6)") -> Column:
    """Number text in any accepted notation; NULL when blank or not a number."""
    text = F.regexp_replace(F.trim(c.cast("string")), CURRENCY_NOISE, "")

    def rewritten(group: str, decimal: str) -> Column:
        value = F.translate(text, group, "") if group else text
        return F.translate(value, decimal, ".") if decimal else value

    branches = reduce(
        lambda chain, rule: chain.when(text.rlike(rule[0]), rewritten(*rule[1:])),
        NOTATIONS[1:],
        F.when(text.rlike(NOTATIONS[0][0]), rewritten(*NOTATIONS[0][1:])),
    )
    return try_cast(branches, type_name)


def fits_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return try_cast(c, f"decimal({precision},{scale})").isNotNull()


def invalid_number(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """A non-blank text that is no number, or one that does not fit the decimal."""
    return unfit_number(c, locale_decimal(c), precision, scale)


def unfit_number(text: Column, value: Column, precision: int = 18, scale: int = 2) -> Column:
    """As ``invalid_number``, for a text whose value is known."""
    filled = F.coalesce(F.trim(text.cast("string")) != "", F.lit(False))
    return filled & ~fits_decimal(value, precision, scale)


def round_half_up(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return F.round(c, scale).cast(f"decimal({precision},{scale})")


def round_half_even(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return F.bround(c.cast("decimal(38,6)"), scale).cast(f"decimal({precision},{scale})")


def trunc_int(c: Column) -> Column:
    """Integer part, towards zero."""
    return c.cast("int")


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def blank_to_zero(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*$", "0")


def total_of(columns: Iterable[Column | str], type_name: str = "decimal(18,2)") -> Column:
    """Sum in which a missing part counts as zero."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0).cast(type_name))
             for c in columns]
    return reduce(lambda a, b: a + b, parts).cast(type_name)


def share(part: Column, total: Column) -> Column:
    """part / total as a fraction; 0 when the total is not positive."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.when(total > 0, part / total * 100).otherwise(F.lit(0.0)), digits)
