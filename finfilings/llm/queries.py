"""Importing this module registers all queries of the subpackage."""

from finfilings.llm import centroids, convtrie, decontam, jaccard, language, linededup, packing, pii, scoring, sentences, topk, toxicity, urlfilter  # noqa: F401
from finfilings.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
