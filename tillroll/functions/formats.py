"""Number formats of the rule renderers.

The decimal separator is always ``.`` (Spark formats with a fixed locale).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two number patterns of the rendered rule outputs.
PERCENT_ONE_DECIMAL = "#0.0%"
TWO_DECIMALS = "####0.00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent1(ratio) -> Column:
    """Ratio as a percentage with one decimal, e.g. 0.42857 -> ``42.9%``."""
    return F.call_function("format_number", _col(ratio), F.lit(PERCENT_ONE_DECIMAL))


def decimal2_times100(ratio) -> Column:
    """Ratio x 100 with two decimals and no sign, e.g. 0.42857 -> ``42.86``."""
    return F.call_function("format_number", _col(ratio) * F.lit(100.0), F.lit(TWO_DECIMALS))


def raw_percent(ratio, places: int | None = None) -> Column:
    """Ratio x 100 as text with ``%`` appended, unrounded by default."""
    value = _col(ratio) * F.lit(100.0)
    if places is not None:
        value = F.round(value, places)
    return F.concat(value.cast("string"), F.lit("%"))
