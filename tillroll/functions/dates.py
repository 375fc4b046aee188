"""Month keys and month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_MODES = ("date", "prefix", "unix")
LABEL_STYLES = ("yyyy-MM", "MM/yyyy", "MM-yyyy")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(data, mode: str = "date") -> Column:
    """Month of a receipt date as ``yyyy-MM`` text.

    ``mode='date'`` parses the value as a date (``2015-8-20`` gives
    ``2015-08``; an unparsable or short value gives NULL, never an error).
    ``mode='prefix'`` keeps the first seven characters of the text, so an
    unpadded date gives ``2015-8-``.  ``mode='unix'`` goes through
    ``unix_timestamp`` / ``from_unixtime`` with ``yyyy-MM-dd``.
    """
    c = _col(data)
    if mode == "date":
        return F.date_format(c.try_cast("date"), "yyyy-MM")
    if mode == "prefix":
        return F.substring(c.cast("string"), 1, 7)
    if mode == "unix":
        text = F.date_format(c.try_cast("date"), "yyyy-MM-dd")
        return F.from_unixtime(F.unix_timestamp(text, "yyyy-MM-dd"), "yyyy-MM")
    raise ValueError(f"month mode must be one of {MONTH_MODES}, got {mode!r}")


def month_label(month, style: str = "yyyy-MM") -> Column:
    """Re-label a ``yyyy-MM`` month as ``MM/yyyy`` or ``MM-yyyy``."""
    m = _col(month)
    if style == "yyyy-MM":
        return m
    year, mon = F.substring(m, 1, 4), F.substring(m, 6, 2)
    if style == "MM/yyyy":
        return F.concat(mon, F.lit("/"), year)
    if style == "MM-yyyy":
        return F.concat(mon, F.lit("-"), year)
    raise ValueError(f"label style must be one of {LABEL_STYLES}, got {style!r}")
