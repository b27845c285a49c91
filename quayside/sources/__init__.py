"""Readers, and a model store."""
from quayside.sources.tables import (
    fit_or_load, name_blank_header, new_path, parse_ts_permissive, read_delimited, read_table, spread, stored,
    to_features,
)

__all__ = ["fit_or_load", "name_blank_header", "new_path", "parse_ts_permissive", "read_delimited", "read_table",
           "spread", "stored", "to_features"]
