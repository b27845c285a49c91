"""Every operator run on the test tables, with the SQL that must give the same result."""
from quayside.catalog import (  # noqa: F401  (importing registers the queries)
    q_aggregates, q_charts, q_clean, q_features, q_models, q_series, q_sources, q_text, q_windows,
)
from quayside.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
