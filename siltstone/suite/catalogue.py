"""All registered queries."""

from siltstone.suite import access, decoding, dimensions, exploring, increments, ledgers, multisets, pipelines, providers, quality, storing  # noqa: F401
from siltstone.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
