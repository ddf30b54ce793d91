"""Numeric casts, guarded ratios and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.text import NO_VALUE, _col, clean_text, sentinel_to_null

AMOUNT = "decimal(18,4)"  # one row's quantity, price or amount
EVERY_DIGIT = "decimal(38,18)"

PLAIN_AMOUNT = r"^ *[+-]?[0-9]+(\.[0-9]{0,4})? *$"
# Of a number with eighteen decimals, as text, with an exponent where ANSI mode is off.
FIFTH_DECIMAL = r"\.[0-9]{4}0*[1-9]|[1-9].*E"


def _cast(text: Column, kind: str, permissive: bool) -> Column:
    return text.try_cast(kind) if permissive else text.cast(kind)


def to_num(c: Column | str, permissive: bool = False) -> Column:
    """Text to an exact number of up to four decimals. Words such as ``nan`` count as missing.

    Text with more decimals than that is malformed: it is an error, or NULL when
    ``permissive``, and never rounded. Plain numbers are told by their text; only
    others, such as those with an exponent, are cast to every digit first. The
    expression is kept short: the projection of a Silver model must compile to
    methods that the JVM still optimises, which are those of up to 8,000 bytes.
    """
    cell = _col(c)
    lost = cell.try_cast(EVERY_DIGIT).cast("string").rlike(FIFTH_DECIMAL)
    problem = F.concat(F.lit("more than four decimals: "), F.trim(cell))
    checked = F.when(lost, F.lit(None) if permissive else F.raise_error(problem)).otherwise(cell)
    text = F.when(cell.rlike(PLAIN_AMOUNT), cell).when(~cell.rlike(NO_VALUE), checked)
    return _cast(text, AMOUNT, permissive)


def to_int(c: Column | str, permissive: bool = False) -> Column:
    """Text to an integer; ``5.0`` is malformed."""
    return _cast(clean_text(c), "int", permissive)


def num_to_int(c: Column | str, permissive: bool = False) -> Column:
    """Numeric text to an integer, halves rounded away from zero."""
    return F.round(_cast(sentinel_to_null(c), EVERY_DIGIT, permissive), 0).cast("int")


def safe_ratio(num: Column | str, den: Column | str, scale: int = 2, pct: bool = True) -> Column:
    """``num / den``, as a percentage by default; NULL when ``den`` is NULL or 0.

    The casts fix the quotient at twelve decimals, so rounding happens on an
    exact value and not on a quotient that lost its digits to the 38-digit limit.
    """
    top = _col(num).cast("decimal(24,4)")
    top = (top * 100).cast("decimal(26,4)") if pct else top.cast("decimal(26,4)")
    bottom = _col(den).cast("decimal(24,4)")
    return F.when(bottom != 0, F.round(top / bottom, scale))


def tier(c: Column | str, high, medium) -> Column:
    """Credit tier of a limit, by two lower bounds."""
    limit = _col(c)
    return (
        F.when(limit >= high, "High Credit")
        .when(limit >= medium, "Medium Credit")
        .when(limit.isNotNull(), "Low Credit")
        .otherwise("Unknown")
    )


def count_where(predicate: Column) -> Column:
    """Count of rows for which the predicate is true."""
    return F.count_if(predicate)
