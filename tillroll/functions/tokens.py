"""Splitting receipt lines into a date token and item tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(text, sep: str = ",") -> Column:
    """``split`` on a literal separator; keeps inner and trailing empties."""
    return F.split(_col(text), _regex_literal(sep))


def drop_empty(arr) -> Column:
    """Remove empty strings (and NULLs) from an array of strings."""
    return F.filter(_col(arr), lambda x: x.isNotNull() & (x != F.lit("")))


def drop_trailing_empty(arr) -> Column:
    """Remove the empty strings at the end of an array of strings, keep those between others."""
    a = _col(arr)
    last = F.aggregate(F.sequence(F.lit(0), F.size(a)), F.lit(0),
                       lambda acc, i: F.when(F.coalesce(F.get(a, i - 1), F.lit("")) != "", i).otherwise(acc))
    return F.slice(a, F.lit(1), last)


def items_after_date(tokens) -> Column:
    """All tokens after the first; a date-only line gives ``[]``."""
    t = _col(tokens)
    return F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?{}[]\\|()")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
