"""Receipt readers for delimited text.

A receipt is one text line: a date, then the items.  Two line forms exist:

* comma form  ``2024-02-29,bread,milk``
* colon form  ``2024-02-29:bread,milk``

Lines are read with ``spark.read.text`` so blank lines stay receipts (they
count in the support denominator).  ``read.csv`` would drop them.

Every reader returns ``rid BIGINT, data STRING, products ARRAY<STRING>``
(the unsplit reader ``data DATE, products STRING``).  ``rid`` is a surrogate
receipt id from ``monotonically_increasing_id``: unique, stable for the same
file splits, not dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.tokens import drop_empty, drop_trailing_empty, items_after_date, split_tokens
from tillroll.sources.layout import rebalance_scan


EMPTY_ITEMS = ("drop", "keep", "inner")


def _finish(lines: DataFrame, data, products, empty: str, rebalance: bool | None) -> DataFrame:
    if empty == "drop":
        products = drop_empty(products)
    elif empty == "inner":
        products = drop_trailing_empty(products)
    elif empty != "keep":
        raise ValueError(f"empty must be one of {EMPTY_ITEMS}, got {empty!r}")
    # the id is fixed by the input splits, before any rebalancing
    return rebalance_scan(lines.select(
        F.monotonically_increasing_id().alias("rid"),
        data.alias("data"),
        products.alias("products"),
    ), rebalance)


def _empty_rule(keep_empty: bool, empty: str | None) -> str:
    return empty or ("keep" if keep_empty else "drop")


def parse_comma_lines(lines: DataFrame, keep_empty: bool = False, col: str = "value",
                      empty: str | None = None, rebalance: bool | None = None) -> DataFrame:
    """Parse comma-form lines (a ``value`` column) into receipts.

    ``empty`` says what becomes of empty items: ``'drop'`` (default), ``'keep'``
    (same as ``keep_empty=True``), or ``'inner'``: those between items stay,
    those at the end of the line go, as a split without a limit does it.
    """
    tokens = split_tokens(col, ",")
    return _finish(lines, F.get(tokens, 0), items_after_date(tokens), _empty_rule(keep_empty, empty), rebalance)


def parse_colon_lines(lines: DataFrame, keep_empty: bool = False, col: str = "value",
                      empty: str | None = None, rebalance: bool | None = None) -> DataFrame:
    """Parse colon-form lines: ``date:item,item``; no ``:`` means no items."""
    halves = F.split(F.col(col), ":", 2)
    products = F.coalesce(split_tokens(F.get(halves, 1), ","), F.array().cast("array<string>"))
    return _finish(lines, F.get(halves, 0), products, _empty_rule(keep_empty, empty), rebalance)


def read_receipts(spark: SparkSession, path: str, form: str = "comma", keep_empty: bool = False,
                  empty: str | None = None, rebalance: bool | None = None) -> DataFrame:
    """Read receipt text files (``form`` = ``'comma'`` or ``'colon'``).

    ``rebalance``: see :func:`tillroll.sources.layout.rebalance_scan`.
    """
    parse = {"comma": parse_comma_lines, "colon": parse_colon_lines}.get(form)
    if parse is None:
        raise ValueError(f"form must be 'comma' or 'colon', got {form!r}")
    return parse(spark.read.text(path), keep_empty, empty=empty, rebalance=rebalance)


def read_receipts_unsplit(spark: SparkSession, path: str, rebalance: bool | None = None) -> DataFrame:
    """Colon form as ``(rid, data DATE, products STRING)``; the list stays text.

    An unparsable date becomes NULL (no error).  Split later with
    :func:`tillroll.functions.split_tokens`.
    """
    halves = F.split(F.col("value"), ":", 2)
    return rebalance_scan(spark.read.text(path).select(
        F.monotonically_increasing_id().alias("rid"),
        F.get(halves, 0).try_cast("date").alias("data"),
        F.get(halves, 1).alias("products"),
    ), rebalance)


def receipt_lines(receipts: DataFrame, form: str = "comma") -> DataFrame:
    """Render receipts ``(data, products)`` back to one ``value`` text column."""
    sep = "," if form == "comma" else ":"
    items = F.array_join(F.col("products"), ",")
    if form == "comma":
        line = F.when(F.size("products") > 0, F.concat_ws(sep, F.col("data"), items)) \
                .otherwise(F.col("data"))
    else:
        line = F.concat_ws(sep, F.col("data"), items)
    return receipts.select(line.alias("value"))
