"""Column expressions; all built from Spark's own functions."""

from tradeloom.functions.dates import (
    date_key, fiscal_quarter, fiscal_year, iso_weekday, month_date, month_start, sentinel_date,
    to_date_strict,
)
from tradeloom.functions.numbers import count_where, num_to_int, safe_ratio, tier, to_int, to_num
from tradeloom.functions.text import (
    clean_text, is_missing_key, is_month_token, is_valid_key, mentions_total, missing_to_null,
    month_token, sentinel_to_null, version_label, version_rank,
)

__all__ = [
    "clean_text", "count_where", "date_key", "fiscal_quarter", "fiscal_year", "is_missing_key",
    "is_month_token", "is_valid_key", "iso_weekday", "mentions_total", "missing_to_null",
    "month_date", "month_start", "month_token", "num_to_int", "safe_ratio", "sentinel_date",
    "sentinel_to_null", "tier", "to_date_strict", "to_int", "to_num", "version_label",
    "version_rank",
]
