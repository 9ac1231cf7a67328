"""Importing this module registers the queries of this subpackage."""

from revenue_lens.llm import (  # noqa: F401
    benchmark_match,
    bit_sliced,
    interpolation,
    language,
    line_windows,
    merkle,
    minhash,
    packing,
    ranked_search,
    reply_trees,
    source_mix,
    toxicity,
    warc,
)
from revenue_lens.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
