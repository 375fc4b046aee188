"""Registered query plans over the Parquet test tables, and their SQL oracles."""
