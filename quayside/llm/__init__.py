"""Operators for training data: chat formatting, quality, language models, licenses, tokens, near copies, packing,
fingerprints, shards. Nothing else in the library imports this subpackage."""

from quayside.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
