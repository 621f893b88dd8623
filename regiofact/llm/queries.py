"""All queries of this subpackage, by name, with their SQL where SQL can express them."""

from importlib import import_module

from regiofact.llm.base import ORACLES, QUERIES

MODULES = (
    "token_counts", "urls", "secrets", "language", "simhash", "embedding_dedup", "bpe", "packing", "suffix_dedup",
    "neighbours", "periodic_runs", "alignment", "quality_votes",
)

for _name in MODULES:
    import_module(f"regiofact.llm.{_name}")

__all__ = ["ORACLES", "QUERIES"]
