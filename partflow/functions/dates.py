"""Date texts, calendar arithmetic and month labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.config import LOCAL_ZONE

ERP_DATE_SHAPE = r"^\d{2}\.\d{2}\.\d{4}$"
ERP_NO_DATE = "00.00.0000"


def erp_date(c: Column) -> Column:
    """``dd.MM.yyyy`` text to date; NULL when it is not a date."""
    return F.try_to_date(c, "dd.MM.yyyy")


def repair_date(c: Column, last_year: int = 2029) -> Column:
    """Bring month/day/two-digit-year texts into ``dd.MM.yyyy``.

    Two-digit years are read as 20xx; those past ``last_year`` belong to 19xx.
    Well-formed texts and the ERP's empty date stay as they are.
    """
    parsed = F.try_to_date(c, "M/d/yy")
    century = F.when(F.year(parsed) > last_year, -1200).otherwise(0)
    repaired = F.date_format(F.add_months(parsed, century), "dd.MM.yyyy")
    # The ERP's empty date has the well-formed shape, so one test covers both.
    return F.when(c.rlike(ERP_DATE_SHAPE), c).when(c.isNotNull(), repaired)


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy/MM")


def day_label(c: Column) -> Column:
    """``05/03/2020``."""
    return F.date_format(c, "dd/MM/yyyy")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def add_months(c: Column, n: int | Column) -> Column:
    return F.add_months(c, n)


def iso_weekday(c: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(c) + 1


def fiscal_number(c: Column) -> Column:
    """Fiscal years run from April to March; the year starting in April 2026 is 103."""
    return F.year(F.add_months(c, -3)) - 1923


def fiscal_label(c: Column) -> Column:
    return F.concat(fiscal_number(c).cast("string"), F.lit("ki"))


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday by Oudin's integer formula, in column arithmetic."""
    century = F.floor(year / 100)
    golden = year % 19
    moon = F.pmod(century - F.floor(century / 4) - F.floor((8 * century + 13) / 25)
                  + 19 * golden + 15, F.lit(30))
    full = moon - F.floor(moon / 28) * (
        1 - F.floor(29 / (moon + 1)) * F.floor((21 - golden) / 11))
    weekday = F.pmod(year + F.floor(year / 4) + full + 2 - century + F.floor(century / 4),
                     F.lit(7))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), (full - weekday).cast("int"))


def local_timestamp(c: Column | None = None, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(F.current_timestamp() if c is None else c, zone)


def to_millis(c: Column) -> Column:
    return F.unix_millis(c)


def from_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def shift_month(day: date, months: int) -> date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def last_months(anchor: date, n: int) -> list[date]:
    """First days of the ``n`` months that end with the month of ``anchor``."""
    return [shift_month(anchor, -k) for k in reversed(range(n))]


def label_of(day: date) -> str:
    return f"{day:%Y/%m}"
