"""Text cleaning, key validity, labels and month tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "no key" after trimming and lower-casing.
KEY_SENTINELS = ("nan", "none", "null", "")

# The same as one pattern, which compiles to a fraction of the code of trimming, lower-casing and comparing.
NO_VALUE = rf"(?i)^ *({'|'.join(w for w in KEY_SENTINELS if w)})? *\z"

# Words that mean "no date" in plan sheets.
DATE_SENTINELS = ("", "nan", "none", "null", "nat")

# Words that mark a total row in a plan sheet.
TOTAL_WORDS = ("tổng", "total")

# Cell texts a delimited source uses for a missing value.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Strip surrounding spaces; a blank cell becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def missing_to_null(c: Column | str) -> Column:
    """NULL for the texts a delimited source writes for a missing value."""
    return F.when(~_col(c).isin(*MISSING_WORDS), _col(c))


def sentinel_to_null(c: Column | str) -> Column:
    """Cleaned text, with NULL also for words such as ``nan`` and ``none``."""
    text = clean_text(c)
    return F.when(~F.lower(text).isin(*KEY_SENTINELS), text)


def is_valid_key(c: Column | str) -> Column:
    """True for a key that is present and is not one of the sentinel words."""
    return _col(c).isNotNull() & ~_col(c).rlike(NO_VALUE)


def is_missing_key(c: Column | str) -> Column:
    """True for NULL, blank or sentinel keys: the profiler's notion of a null."""
    return ~is_valid_key(_col(c).cast("string"))


def mentions_total(c: Column | str, words=TOTAL_WORDS) -> Column:
    """True when the cell contains a total word, in any case; NULL is no match."""
    return F.coalesce(F.lower(_col(c)).rlike("|".join(words)), F.lit(False))


def version_label(sheet_name: Column | str) -> Column:
    """First ``v<digits>`` of the lower-cased sheet name; an error if there is none."""
    label = F.regexp_extract(F.lower(_col(sheet_name)), r"(v\d+)", 1)
    problem = F.concat(F.lit("no version label in sheet name: "), _col(sheet_name))
    return F.when(label != "", label).otherwise(F.raise_error(problem).cast("string"))


def version_rank(label: Column | str) -> Column:
    """Number of a ``v<digits>`` label, NULL for any other text."""
    digits = F.regexp_extract(F.lower(F.trim(_col(label))), r"^v(\d+)$", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def month_token(c: Column | str) -> Column:
    """``T1`` .. ``T12`` from a cell that holds a whole month number, such as ``3`` or ``3.0``; NULL otherwise."""
    text = _col(c).cast("string")
    number = F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))
    return F.when((number >= 1) & (number <= 12) & (number == F.floor(number)), F.concat(F.lit("T"), F.floor(number).cast("string")))


def is_month_token(c: Column | str) -> Column:
    return _col(c).rlike(r"^T([1-9]|1[0-2])$")
