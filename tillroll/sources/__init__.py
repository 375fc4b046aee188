"""Sources (text receipts, price lists, Parquet test tables) and sinks."""

from tillroll.sources.prices import PRICE_SCHEMA, price_lines, read_prices, typed_prices
from tillroll.sources.receipts import (
    parse_colon_lines,
    parse_comma_lines,
    read_receipts,
    read_receipts_unsplit,
    receipt_lines,
)
from tillroll.sources.sinks import (
    create_table,
    drop_table,
    load_into_table,
    read_table,
    save_table,
    write_key_value,
    write_lines,
)

__all__ = [
    "PRICE_SCHEMA",
    "price_lines",
    "read_prices",
    "typed_prices",
    "parse_colon_lines",
    "parse_comma_lines",
    "read_receipts",
    "read_receipts_unsplit",
    "receipt_lines",
    "create_table",
    "drop_table",
    "load_into_table",
    "read_table",
    "save_table",
    "write_key_value",
    "write_lines",
]
