"""Date casts, calendar parts and the September fiscal year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import _cast
from tradeloom.functions.text import DATE_SENTINELS, _col, clean_text

FISCAL_FIRST_MONTH = 9


def to_date_strict(c: Column | str, permissive: bool = False) -> Column:
    """ISO text to a date; malformed text fails unless ``permissive``."""
    return _cast(clean_text(c), "date", permissive)


def sentinel_date(c: Column | str, permissive: bool = False) -> Column:
    """ISO text to a date, where words such as ``nat`` mean no date."""
    text = F.trim(_col(c))
    return _cast(F.when(~F.lower(text).isin(*DATE_SENTINELS), text), "date", permissive)


def month_date(year: Column | str, month: Column | str) -> Column:
    """First day of a month."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def date_key(c: Column | str) -> Column:
    """``yyyymmdd`` as an integer."""
    day = _col(c)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(c: Column | str) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(_col(c)) + 1


def fiscal_year(c: Column | str) -> Column:
    """Fiscal year, named after the calendar year its first month (September) is in."""
    return F.year(F.add_months(_col(c), 1 - FISCAL_FIRST_MONTH))


def fiscal_quarter(c: Column | str) -> Column:
    """Quarter counted from September."""
    return F.quarter(F.add_months(_col(c), 1 - FISCAL_FIRST_MONTH))
