"""Column expressions (all built-in Spark SQL functions, no UDF)."""

from tillroll.functions.dates import month_key, month_label
from tillroll.functions.formats import (
    decimal2_times100,
    percent1,
    raw_percent,
)
from tillroll.functions.tokens import drop_empty, drop_trailing_empty, items_after_date, split_tokens

__all__ = [
    "month_key",
    "month_label",
    "decimal2_times100",
    "percent1",
    "raw_percent",
    "drop_empty",
    "drop_trailing_empty",
    "items_after_date",
    "split_tokens",
]
